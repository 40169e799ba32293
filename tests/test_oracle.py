"""Every SQL-expressible query against its DuckDB oracle, plus the entry contract."""

from __future__ import annotations

import math
import re
from pathlib import Path

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare
from rateforge.operators import model as M
from rateforge.operators import features as X
from rateforge.plans import catalog as C
from rateforge.plans.catalog import QUERIES as CATALOG
from rateforge.sources import files
from rateforge.sources import tables as T

SQL = {n: q for n, q in E.oracle_sql().items() if n in CATALOG}
QUERIES = {n: f for n, f in E.queries().items() if n in CATALOG}


def test_every_query_has_an_oracle_except_the_model():
    assert set(QUERIES) - set(SQL) == {"predict_ratings", "fitted_rmse_by_split"}
    assert set(SQL) <= set(QUERIES)


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    """The model queries fit 287 trees; their rows and columns do not depend on the number."""
    monkeypatch.setitem(M.TUNED_PARAMS, "maxIter", 5)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["user_id", "item_id"] and df.columns[-1] == "rating"


def test_predict_ratings_one_row_per_pair(spark):
    pairs = QUERIES["scoring_pairs"](spark, SF_SMALL).count()
    pred = QUERIES["predict_ratings"](spark, SF_SMALL)
    assert pred.columns == ["user_id", "item_id", "prediction"]
    assert pred.count() == pairs
    assert pred.where("prediction IS NULL").count() == 0


def test_fitted_rmse_by_split_against_the_predictions(spark):
    """RMSE per split from the single predictions of the same model."""
    dims, model = C._model(spark, SF_SMALL, train_split=True)
    ratings = T.ratings(spark, SF_SMALL)
    rows = M.predict(model, X.features_from(ratings, dims)).collect()
    squares = {}
    for r in rows:
        side = "train" if (r.user_id * 31 + r.item_id) % 10 < 8 else "valid"
        squares.setdefault(side, []).append((r.rating - r.prediction) ** 2)
    got = {r.split: (r.rmse, r.n) for r in QUERIES["fitted_rmse_by_split"](spark, SF_SMALL).collect()}
    assert set(got) == set(squares) == {"train", "valid"}
    for side, values in squares.items():
        assert got[side] == (pytest.approx(math.sqrt(sum(values) / len(values)), rel=1e-9), len(values))
    # The hold-out never was in the training rows, so it fits worse.
    assert got["valid"][0] > got["train"][0]


def test_prediction_file_carries_each_lines_own_prediction(spark, tmp_path):
    """Line by line, over several part files: the keys of the input file and the model's value for them."""
    dims, model = C._model(spark, SF_SMALL)
    pairs = T.pairs(spark, SF_SMALL, with_line=True)
    scored = M.predict(model, X.features_from(pairs, dims, keep=["line"]), keep=["line"])
    files.write_predictions(scored, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part-*.csv"))) > 1
    lines = [x for p in sorted((tmp_path / "out").glob("part-*.csv")) for x in p.read_text().splitlines()]
    body = [x.split(",") for x in lines if not x.startswith("user_id,")]
    source = sorted(Path(T.staged(spark, SF_SMALL, "pairs").removeprefix("file:")).glob("part-*.txt"))
    asked = [x.split(",") for p in source for x in p.read_text().splitlines()][1:]
    assert [b[:2] for b in body] == [a[:2] for a in asked]
    want = {(r.user_id, r.item_id): r.prediction for r in scored.collect()}
    assert all(float(p) == want[int(u), int(i)] for u, i, p in body)
    read = files.read_predictions(spark, str(tmp_path / "out")).orderBy("line").collect()
    assert [[r.user_id, r.item_id, r.prediction] for r in read] == [[u, i, float(p)] for u, i, p in body]
    assert [r.line for r in read] == list(range(len(body)))


def test_queries_read_only_what_they_use(spark):
    """Plans read the staged text only, and parse no field that the query does not use."""
    for name, fields, others in [
        ("item_flags", ["attributes"], ["latitude", "stars"]),
        ("item_location", ["latitude"], ["attributes", "stars"]),
        ("user_tenure", ["yelping_since"], ["compliment_hot", "average_stars"]),
        ("rmse", [], ["compliment_hot", "attributes", "latitude"]),
    ]:
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search("lineitem|events|l_partkey|event_type", plan), name
        assert all(f in plan for f in fields) and not any(f in plan for f in others), name
