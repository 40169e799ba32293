"""Query catalogue over the test tables: name -> (spark, sf_dir) -> DataFrame.

Every query reads the whole tables of ``sf_dir`` through the adapter in
``sources.tables``. Computed doubles are rounded (9 places for trigonometry,
6 otherwise) so that results compare exactly with another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import dimensions as D
from ..operators import evaluation as E
from ..operators import features as X
from ..operators import model as M
from ..operators import profiling as P
from ..operators import signals as G
from ..sources import files, shared
from ..sources import tables as T
from . import job as J

TRIG = 9
AVG = 6
TRIG_COLUMNS = ["lat_sin", "lat_cos", "lon_sin", "lon_cos"]
AVG_COLUMNS = ["user_avg", "item_avg", "tip_likes", "price_range"]


def _r(c: str, places: int) -> Column:
    return F.round(F.col(c), places).alias(c)


def _rounded(df: DataFrame) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in TRIG_COLUMNS:
            cols.append(_r(c, TRIG))
        elif c in AVG_COLUMNS:
            cols.append(_r(c, AVG))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def _dimensions(spark: SparkSession, sf_dir: str) -> X.Dimensions:
    """Dimensions of the test tables, materialized in the shared folder."""
    return X.Dimensions.build(
        T.users(spark, sf_dir),
        T.items(spark, sf_dir),
        T.visits(spark, sf_dir),
        T.tips(spark, sf_dir),
        T.photos(spark, sf_dir),
        T.AS_OF,
    ).materialize()


def _features(spark: SparkSession, sf_dir: str, pairs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return X.features_from(pairs, _dimensions(spark, sf_dir), keep=keep)


# --- sources ---------------------------------------------------------------


def q_ratings(spark, sf_dir):
    return T.ratings(spark, sf_dir)


def q_scoring_pairs(spark, sf_dir):
    return T.pairs(spark, sf_dir)


def q_split_ratings(spark, sf_dir):
    return E.with_split(T.ratings(spark, sf_dir))


# --- users -----------------------------------------------------------------


def q_user_profile(spark, sf_dir):
    return T.users(spark, sf_dir, ["review_count", "average_stars", "yelping_since"]).select(
        "user_id",
        F.coalesce(F.col("review_count"), F.lit(0)).cast("long").alias("review_count"),
        F.round("average_stars", AVG).alias("average_stars"),
        F.to_date(F.col("yelping_since"), "yyyy-M-d").alias("joined_on"),
    )


def q_user_engagement(spark, sf_dir):
    return D.user_engagement(T.users(spark, sf_dir, [*S.INTERACTION_FIELDS, *S.COMPLIMENT_FIELDS]))


def q_user_tenure(spark, sf_dir):
    return D.user_tenure(T.users(spark, sf_dir, ["yelping_since"]), T.AS_OF)


# --- items -----------------------------------------------------------------


def q_item_profile(spark, sf_dir):
    return T.items(spark, sf_dir, ["review_count", "stars", "is_open"]).select(
        "item_id",
        F.coalesce(F.col("review_count"), F.lit(0)).cast("long").alias("review_count"),
        F.round("stars", AVG).alias("stars"),
        "is_open",
    )


def q_item_location(spark, sf_dir):
    return _rounded(D.item_location(T.items(spark, sf_dir, ["latitude", "longitude"])))


def q_item_flags(spark, sf_dir):
    return D.item_flags(T.items(spark, sf_dir, ["attributes"]))


def q_item_price_tier(spark, sf_dir):
    return D.item_price_tier(T.items(spark, sf_dir, ["attributes"]))


def q_item_ordinals(spark, sf_dir):
    return D.item_ordinals(T.items(spark, sf_dir, ["attributes"]))


# --- signals ---------------------------------------------------------------


def q_item_visits(spark, sf_dir):
    return G.item_visits(T.visits(spark, sf_dir))


def q_item_photo_count(spark, sf_dir):
    return G.item_photo_count(T.photos(spark, sf_dir))


def q_tip_likes_by_user(spark, sf_dir):
    return G.tip_likes_by_user(T.tips(spark, sf_dir)).select("user_id", F.round("avg_likes", AVG).alias("avg_likes"))


def q_tip_likes_by_item(spark, sf_dir):
    return G.tip_likes_by_item(T.tips(spark, sf_dir)).select("item_id", F.round("avg_likes", AVG).alias("avg_likes"))


def q_latest_tip_per_pair(spark, sf_dir):
    return G.latest_tip_per_pair(T.tips(spark, sf_dir))


def q_pair_tip_likes(spark, sf_dir):
    last = shared.materialize(G.latest_tip_per_pair(T.tips(spark, sf_dir)), "pair-tips")
    return X.pair_tip_likes(T.ratings(spark, sf_dir), last)


# --- feature matrix --------------------------------------------------------


def q_cold_start_mix(spark, sf_dir):
    known_users = shared.materialize(T.users(spark, sf_dir, []), "known-users")
    known_items = shared.materialize(T.items(spark, sf_dir, []), "known-items")
    return X.cold_start_mix(T.ratings(spark, sf_dir), known_users, known_items)


def q_feature_matrix(spark, sf_dir):
    return _rounded(_features(spark, sf_dir, T.ratings(spark, sf_dir)))


def q_scoring_matrix(spark, sf_dir):
    return _rounded(_features(spark, sf_dir, T.pairs(spark, sf_dir), keep=[]))


def q_missing_profile(spark, sf_dir):
    return P.missing_profile(_features(spark, sf_dir, T.ratings(spark, sf_dir)))


# --- profiling -------------------------------------------------------------


def q_attribute_frequency(spark, sf_dir):
    return P.attribute_frequency(T.items(spark, sf_dir, ["attributes"], every_attribute=True))


def q_attribute_values(spark, sf_dir):
    return P.attribute_values(T.items(spark, sf_dir, ["attributes"], every_attribute=True))


# --- evaluation ------------------------------------------------------------


def _baseline(spark, sf_dir, rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of the ratings with the baseline prediction; only the two averages are joined."""
    users, items = T.users(spark, sf_dir, ["average_stars"]), T.items(spark, sf_dir, ["stars"])
    averages = X.pair_averages(rows, users, items, keep)
    return averages.select(*keep, E.baseline_prediction().alias("prediction"))


def q_rmse(spark, sf_dir):
    scored = _baseline(spark, sf_dir, T.ratings(spark, sf_dir), ["rating"])
    return E.rmse(scored).select(F.round("rmse", AVG).alias("rmse"), "n")


def q_error_histogram(spark, sf_dir):
    return E.error_histogram(_baseline(spark, sf_dir, T.ratings(spark, sf_dir), ["rating"]))


def q_rmse_by_split(spark, sf_dir):
    rows = E.with_split(T.ratings(spark, sf_dir))
    scored = _baseline(spark, sf_dir, rows, ["rating", "split"])
    return E.rmse(scored, by=["split"]).select("split", F.round("rmse", AVG).alias("rmse"), "n")


# --- model -----------------------------------------------------------------

#: The models of the last test tables used in a session: several queries apply them.
_FITTED: dict[tuple, tuple] = {}


def _model(spark, sf_dir, train_split: bool = False):
    """(dimensions, model): the tuned settings fitted on all ratings, or on the train split of them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in {k[:2] for k in _FITTED}:
        _FITTED.clear()
    if (*key, train_split) not in _FITTED:
        dims = next((d for d, _ in _FITTED.values()), None) or _dimensions(spark, sf_dir)
        rows = T.ratings(spark, sf_dir)
        if train_split:
            rows = E.with_split(rows).where(F.col("split") == F.lit(E.TRAIN)).drop("split")
        table, n = J.training_table(rows, dims)
        train = J.in_partitions(table, n)
        model = M.fit(train, n_rows=n)
        train.unpersist()
        _FITTED[*key, train_split] = (dims, model)
    return _FITTED[*key, train_split]


def q_predict_ratings(spark, sf_dir):
    """Fit the tuned settings on all ratings, predict every view pair."""
    dims, model = _model(spark, sf_dir)
    return M.predict(model, X.features_from(T.pairs(spark, sf_dir), dims))


def q_predict_coverage(spark, sf_dir):
    """Every view pair, and whether the model gave it a finite prediction."""
    p = F.col("prediction")
    finite = p.isNotNull() & ~F.isnan(p) & (F.abs(p) != F.lit(float("inf")))
    return q_predict_ratings(spark, sf_dir).select("user_id", "item_id", F.coalesce(finite, F.lit(False)).alias("has_prediction"))


def q_prediction_file(spark, sf_dir):
    """The prediction of every line of the pairs file, written, and read back in the order of its lines."""
    dims, model = _model(spark, sf_dir)
    lines = T.pairs(spark, sf_dir, with_line=True)
    scored = M.predict(model, X.features_from(lines, dims, keep=[files.NUMBER]), keep=[files.NUMBER])
    path = shared.shared_path(spark, "prediction-file")
    files.write_predictions(scored, path)
    read = files.read_predictions(spark, path)
    return read.select(files.NUMBER, F.col("user_id").cast("long"), F.col("item_id").cast("long"))


def _fitted_on_train(spark, sf_dir):
    """Every rating with its split and the prediction of the model fitted on the train split."""
    dims, model = _model(spark, sf_dir, train_split=True)
    rows = X.features_from(E.with_split(T.ratings(spark, sf_dir)), dims, keep=["rating", "split"])
    return M.predict(model, rows, keep=["rating", "split"])


def q_fitted_rmse_by_split(spark, sf_dir):
    """Train and hold-out RMSE of the model fitted on the train split."""
    return E.rmse(_fitted_on_train(spark, sf_dir), by=["split"])


def q_fitted_split_rows(spark, sf_dir):
    """Ratings per split, and how many of them the model of the train split scored."""
    scored = F.count_if(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    return _fitted_on_train(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"), scored.alias("n_scored"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings": q_ratings,
    "scoring_pairs": q_scoring_pairs,
    "split_ratings": q_split_ratings,
    "user_profile": q_user_profile,
    "user_engagement": q_user_engagement,
    "user_tenure": q_user_tenure,
    "item_profile": q_item_profile,
    "item_location": q_item_location,
    "item_flags": q_item_flags,
    "item_price_tier": q_item_price_tier,
    "item_ordinals": q_item_ordinals,
    "item_visits": q_item_visits,
    "item_photo_count": q_item_photo_count,
    "tip_likes_by_user": q_tip_likes_by_user,
    "tip_likes_by_item": q_tip_likes_by_item,
    "latest_tip_per_pair": q_latest_tip_per_pair,
    "pair_tip_likes": q_pair_tip_likes,
    "cold_start_mix": q_cold_start_mix,
    "feature_matrix": q_feature_matrix,
    "scoring_matrix": q_scoring_matrix,
    "missing_profile": q_missing_profile,
    "attribute_frequency": q_attribute_frequency,
    "attribute_values": q_attribute_values,
    "rmse": q_rmse,
    "error_histogram": q_error_histogram,
    "rmse_by_split": q_rmse_by_split,
    "predict_ratings": q_predict_ratings,
    "predict_coverage": q_predict_coverage,
    "prediction_file": q_prediction_file,
    "fitted_rmse_by_split": q_fitted_rmse_by_split,
    "fitted_split_rows": q_fitted_split_rows,
}
