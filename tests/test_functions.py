"""Scalar feature functions on hand-written rows."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rateforge.functions import scalar as fx
from rateforge.schemas import ORDINAL_ATTRIBUTES


def test_visits_skip_slot_zero(spark):
    df = spark.createDataFrame(
        [
            (1, {"Fri-0": 2, "Sat-00": 3, "Sat-13": 1, "Sun-20": 4}),
            (2, {"Fri-0": 2}),
            (4, {"Mon-01": 7, "Tue-10": 1, "Wed-100000000000000000000": 2}),
            (5, {}),
            (6, None),
        ],
        "id int, time map<string,int>",
    )
    got = dict(df.select("id", fx.visits("time").alias("v")).collect())
    assert got == {1: 5, 2: 0, 4: 10, 5: 0, 6: None}


def test_slot_without_a_number_stops_the_job(spark):
    df = spark.createDataFrame([({"Fri-1": 1, "bad": 9},)], "time map<string,int>")
    with pytest.raises(Exception, match="time slot"):
        df.select(fx.visits("time")).collect()


def test_tri_state(spark):
    df = spark.createDataFrame(
        [({"A": "True"},), ({"A": "False"},), ({"A": "true"},), ({"B": "True"},), (None,), ({"A": "None"},)],
        "attributes map<string,string>",
    )
    got = [r[0] for r in df.select(fx.tri_state(fx.attribute("attributes", "A"))).collect()]
    assert got == [1, 0, None, None, None, None]


def test_noise_ordinal(spark):
    codes = ORDINAL_ATTRIBUTES[0][2]
    df = spark.createDataFrame([("quiet",), ("average",), ("loud",), ("very_loud",), ("u'loud'",), (None,)], "v string")
    got = [r[0] for r in df.select(fx.ordinal(F.col("v"), codes)).collect()]
    assert got == [0, 1, 2, 3, None, None]


def test_price_tier(spark):
    values = ["2", "None", None, "2d", "2f", "NaN", "Infinity", " 3.5 ", "1e1", "-1", ".5", "", "0x2", "."]
    df = spark.createDataFrame([({"P": v} if v is not None else {},) for v in values], "attributes map<string,string>")
    got = [r[0] for r in df.select(fx.price_tier(fx.attribute("attributes", "P"))).collect()]
    assert got == [2.0, None, None, None, None, None, None, 3.5, 10.0, -1.0, 0.5, None, None, None]


def test_location(spark):
    df = spark.createDataFrame([(0.0, 90.0), (None, 10.0)], "lat double, lon double")
    rows = df.select(*fx.sin_cos_radians("lat"), *fx.sin_cos_radians("lon")).collect()
    s1, c1, s2, c2 = rows[0]
    assert abs(s1) < 1e-12 and abs(c1 - 1) < 1e-12 and abs(s2 - 1) < 1e-12 and abs(c2) < 1e-12
    assert rows[1][0] is None and rows[1][1] is None
    assert all(math.isclose(v * v + w * w, 1.0) for v, w in [(s1, c1), (s2, c2)])


def test_days_active(spark):
    df = spark.createDataFrame([("2020-01-01",), (None,), ("2020-02-01",), ("",), ("2020-1-1",)], "j string")
    got = [r[0] for r in df.select(fx.days_active("j", dt.date(2020, 1, 31))).collect()]
    assert got == [30, None, -1, None, 30]


@pytest.mark.parametrize("broken", ["bad", "2020-01-01 10:00:00", "2020-13-01", "01.02.2020"])
def test_a_broken_date_stops_the_job(spark, broken):
    df = spark.createDataFrame([(broken,)], "j string")
    with pytest.raises(Exception, match="not a date"):
        df.select(fx.days_active("j", dt.date(2020, 1, 31))).collect()


def test_interactions_and_totals(spark):
    df = spark.createDataFrame([(1, 2, 3, 4), (1, None, 3, 4)], "useful long, funny long, cool long, fans long")
    got = [r[0] for r in df.select(fx.interactions()).collect()]
    assert got == [10, None]


def test_error_buckets(spark):
    df = spark.createDataFrame([(e,) for e in [0.0, 0.999, 1.0, 3.999, 4.0, 7.0]], "e double")
    got = [r[0] for r in df.select(fx.error_bucket(F.col("e"))).collect()]
    assert got == [0, 0, 1, 3, 4, 4]
