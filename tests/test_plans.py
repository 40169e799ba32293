"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from rateforge.plans import catalog as C
from rateforge.plans import job as J
from rateforge.plans.catalog import QUERIES
from rateforge.sources import shared
from rateforge.sources import tables as T
from rateforge.operators import features as X
from rateforge.operators import signals as G
from rateforge.schemas import COMPLIMENT_FIELDS


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _executed(df) -> str:
    """Final adaptive plan, after running the frame's own query execution."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


MODEL_QUERIES = {"predict_ratings", "predict_coverage"}
NAMES = sorted(set(QUERIES) - MODEL_QUERIES)
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")
CAPS = ("GlobalLimit", "LocalLimit", "Sample", "Tail")


@pytest.fixture()
def whole_plans(monkeypatch):
    """Plans from the base tables on: nothing is written in between."""
    monkeypatch.setattr(shared, "materialize", lambda df, label: df)


@pytest.mark.parametrize("name", NAMES)
def test_no_python_in_any_plan(spark, whole_plans, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not [m for m in PYTHON if m in plan], name


@pytest.mark.parametrize("name", NAMES)
def test_no_row_caps_or_sampling(spark, whole_plans, name):
    """Every registered query works on whole tables: no limit, no sample."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not [m for m in CAPS if m in plan], name
    assert "ExistingRDD" not in plan  # nothing hidden behind a written frame


def test_training_rows_of_the_model_queries(spark, whole_plans):
    """What the model is fitted on: no Python, no caps, all rating rows."""
    table, n = J.training_table(T.ratings(spark, SF_SMALL), C._dimensions(spark, SF_SMALL))
    assert n == QUERIES["ratings"](spark, SF_SMALL).count()
    plan = _plan(table) + table._jdf.queryExecution().optimizedPlan().toString()
    assert not [m for m in PYTHON + CAPS if m in plan]


def test_last_wide_shuffle_is_by_item(spark, skew_conf):
    """The pair's tip joins the narrow pair; the user's columns then move once, to the item."""
    plan = _executed(QUERIES["feature_matrix"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    joins = re.findall(r"SortMergeJoin(?:\(skew=true\))? \[([^\]]*)\]", plan)
    keys = [re.sub(r"#\d+L?", "", k) for k in joins]  # outermost first
    assert keys[:3] == ["item_id", "user_id", "user_id, item_id"], keys


def test_metric_queries_join_two_narrow_sides(spark, skew_conf):
    for name in ("rmse", "error_histogram", "rmse_by_split"):
        plan = _executed(QUERIES[name](spark, SF_SMALL)).split("== Initial Plan ==")[0]
        assert "u_avg" in plan and "i_avg" in plan
        assert not re.search("pair_likes|i_visits|i_photos|lat_sin|compliments", plan), name


def test_last_wins_is_an_aggregate_not_a_window(spark):
    plan = _plan(E.queries()["latest_tip_per_pair"](spark, SF_SMALL))
    assert "Window" not in plan
    assert "Aggregate" in plan


def test_filters_and_columns_reach_the_scans(spark):
    """Where the sources are made of the test tables; the queries then scan text."""
    assert "LessThanOrEqual(p_size,40)" in _plan(T.item_lines(spark, SF_SMALL))
    assert "Not(EqualTo(c_mktsegment,MACHINERY))" in _plan(T.user_lines(spark, SF_SMALL))
    photos = _plan(T.photo_lines(spark, SF_SMALL))
    assert "EqualTo(event_type,view)" in photos
    assert "ReadSchema: struct<event_type:string,props:string>" in photos
    for name in ("item_flags", "user_profile", "tip_likes_by_user"):
        assert "ReadSchema: struct<value:string>" in _plan(E.queries()[name](spark, SF_SMALL))


def test_feature_matrix_keeps_every_rating_row(spark):
    n = E.queries()["ratings"](spark, SF_SMALL).count()
    assert E.entry(spark).count() == n


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    """No broadcasts and small skew thresholds, so small frames show the plan of a large run."""
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_pairs(spark, n, same_item: bool):
    """n pairs; a third of them belong to user 'hot' (all with item '0' if ``same_item``)."""
    item = (F.col("id") % 700).cast("string")
    if same_item:
        item = F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise(item)
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("user_id"),
        item.alias("item_id"),
        F.lit(3.0).alias("rating"),
    )


def test_hot_pair_meets_plain_shuffles_in_pair_tip_join(spark, skew_conf):
    """A pair holding a third of all rows: both join sides are plain shuffle
    stages, the precondition for AQE to split the hot partition. (Its rows
    are identical copies, which compress to a few bytes here, so at this size
    AQE rightly sees no large partition; at scale the same copies are large.)"""
    n = 150_000
    pairs = _hot_pairs(spark, n, same_item=True)
    tips = spark.range(60_000).select(
        (F.col("id") % 5000).cast("string").alias("user_id"),
        (F.col("id") % 700).cast("string").alias("item_id"),
        (F.col("id") % 7).alias("likes"),
        F.col("id").alias("_seq"),
    ).union(spark.createDataFrame([("hot", "0", 9, 10**9)], "user_id string, item_id string, likes long, _seq long"))
    last = shared.materialize(G.latest_tip_per_pair(tips), "tips")
    out = X.pair_tip_likes(pairs, last)
    plan = _executed(out)
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("ShuffleQueryStage") == 2 and final.count("ENSURE_REQUIREMENTS") == 2, final
    got = out.where("user_id = 'hot'").groupBy("tip_likes").count().collect()
    assert [tuple(r) for r in got] == [(9, n // 3)]


def test_hot_user_is_split_in_cold_start_counts(spark, skew_conf):
    n = 150_000
    pairs = _hot_pairs(spark, n, same_item=False)
    users = spark.range(5000).select(F.col("id").cast("string").alias("user_id"))
    users = shared.materialize(users.union(spark.createDataFrame([("hot",)], "user_id string")), "users")
    items = shared.materialize(spark.range(350).select(F.col("id").cast("string").alias("item_id")), "items")
    mix = X.cold_start_mix(pairs, users, items)
    assert "SortMergeJoin(skew=true)" in _executed(mix)
    assert sum(r["n"] for r in mix.collect()) == n


def test_hot_user_is_split_by_adaptive_skew_join(spark, skew_conf):
    """A user holding a third of all pairs must not end up in one task."""
    n = 150_000
    pairs = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("user_id"),
        (F.col("id") % 700).cast("string").alias("item_id"),
        F.lit(3.0).alias("rating"),
    )
    users = spark.range(5000).select(
        F.col("id").cast("string").alias("user_id"),
        F.lit(3).cast("long").alias("review_count"),
        F.lit(3.5).alias("average_stars"),
        F.lit("2015-01-01").alias("yelping_since"),
        *[F.lit(1).cast("long").alias(c) for c in ["useful", "funny", "cool", "fans", *COMPLIMENT_FIELDS]],
    ).union(
        spark.createDataFrame(
            [("hot", 9, 4.0, "2010-01-01", *([1] * 15))],
            ", ".join(
                ["user_id string", "review_count long", "average_stars double", "yelping_since string"]
                + [f"{c} long" for c in ["useful", "funny", "cool", "fans", *COMPLIMENT_FIELDS]]
            ),
        )
    )
    items = spark.range(700).select(
        F.col("id").cast("string").alias("item_id"),
        F.lit(5).cast("long").alias("review_count"),
        F.lit(4.0).alias("stars"),
        F.lit(1).alias("is_open"),
        F.lit(10.0).alias("latitude"),
        F.lit(20.0).alias("longitude"),
        F.create_map(F.lit("HasTV"), F.lit("True")).alias("attributes"),
    )
    empty_tips = spark.createDataFrame([], "user_id string, item_id string, likes long, _seq long")
    visits = spark.createDataFrame([], "item_id string, time map<string,int>")
    photos = spark.createDataFrame([], "item_id string")
    dims = X.Dimensions.build(users, items, visits, empty_tips, photos, dt.date(2020, 1, 1)).materialize()
    fm = X.features_from(pairs, dims)
    plan = _executed(fm)
    assert "SortMergeJoin(skew=true)" in plan, plan
    got = fm.where(F.col("user_id") == "hot").select(F.count(F.lit(1)), F.min("user_avg"), F.max("user_avg")).first()
    assert tuple(got) == (n // 3, 4.0, 4.0)
    assert fm.count() == n
