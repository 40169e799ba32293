"""Attribute profiling (D1, D2) and the missing-value profile (M2)."""

from __future__ import annotations

from rateforge.operators import profiling as P


def _items(spark):
    return spark.createDataFrame(
        [
            (1, {"A": "True", "B": "x", "C": None}),
            (2, {"A": "False", "B": "x"}),
            (3, {"A": "True"}),
            (4, None),
        ],
        "item_id int, attributes map<string,string>",
    )


def test_attribute_frequency_ascending(spark):
    rows = [tuple(r) for r in P.attribute_frequency(_items(spark)).collect()]
    assert rows == [("C", 1), ("B", 2), ("A", 3)]  # keys are counted even with a null value


def test_attribute_values_non_null_and_by_key(spark):
    allv = sorted(tuple(r) for r in P.attribute_values(_items(spark)).collect())
    assert allv == [("A", "False"), ("A", "True"), ("B", "x")]
    only_a = sorted(tuple(r) for r in P.attribute_values(_items(spark), ["A"]).collect())
    assert only_a == [("A", "False"), ("A", "True")]


def test_missing_profile(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, 2)], "a double, b int")
    got = dict(P.missing_profile(df, ["a", "b"]).collect())
    assert got == {"a": 1, "b": 2}
