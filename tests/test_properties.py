"""Property tests: scalar rules on generated inputs against direct Python statements."""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateforge.functions import scalar as fx
from rateforge.schemas import ORDINAL_ATTRIBUTES

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

slot_keys = st.one_of(
    st.builds(lambda d, n: f"{d}-{n}", st.sampled_from(["Mon", "Tue", "Sun", "x"]), st.from_regex(r"[0-9]{1,25}", fullmatch=True)),
    st.text(alphabet="abc-_ 9", max_size=6).map(lambda s: s + "7"),
    st.text(alphabet="abc-_ 0", max_size=6).map(lambda s: s + "0"),
)
time_maps = st.dictionaries(slot_keys, st.integers(min_value=0, max_value=1000), max_size=8)


def visits_rule(m):
    # Counts of slots whose trailing number is non-zero.
    return sum(n for k, n in m.items() if int(re.search(r"\d+$", k).group()) != 0)


@SETTINGS
@given(st.lists(time_maps, min_size=1, max_size=40))
def test_visits_rule(spark, maps):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, time map<string,int>")
    got = dict(df.select("i", fx.visits("time")).collect())
    assert got == {i: visits_rule(m) for i, m in enumerate(maps)}


values = st.one_of(st.none(), st.sampled_from(["True", "False", "true", "FALSE", "None", "", "quiet", "loud", "very_loud", "average", "u'loud'", "2", "3.5", "x"]))


@SETTINGS
@given(st.lists(values, min_size=1, max_size=60))
def test_attribute_rules(spark, vs):
    noise = ORDINAL_ATTRIBUTES[0][2]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "i int, v string")
    rows = df.select("i", fx.tri_state(F.col("v")), fx.ordinal(F.col("v"), noise), fx.price_tier(F.col("v"))).collect()
    for i, flag, code, price in rows:
        v = vs[i]
        assert flag == (1 if v == "True" else 0 if v == "False" else None)
        assert code == noise.get(v)
        try:
            want = float(v) if v not in (None, "None") and v.strip() else None
        except ValueError:
            want = None
        assert price == want
