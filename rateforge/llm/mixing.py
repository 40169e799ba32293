"""Mixing sources to target weights with distributed prefix sums.

Each source gets a target number of words: a budget is shared by weight, a
source stops at ``max_epochs`` times its own words, and the excess is shared
again until none is above. Within a source the documents stand in the order of
a hash of their id; a prefix sum of their words cuts the order at the source's
exact budget. A budget above the source's words takes whole epochs first.

Only (id, source, size) rows are sorted, never texts. The order does not depend
on partitions, so reruns agree.

Defined cases: a null text has size 0; documents with a null source form a
source of their own, last in order; a null ``doc_id`` sorts first; rows of equal
id, source, size and text share a place and its words evenly (at most
copies - 1 words of a source go untaken); a document of size 0 is taken 0
times; extra columns are kept by ``mix`` and ignored by ``plan``, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .prefix import prefix_sums
from .quality import SPACES, words_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2


def size_of(text: Column) -> Column:
    """Words of a text; null: 0."""
    return F.size(words_of(F.coalesce(text.cast("string"), F.lit("")))).cast("long")


def _order_key(doc_id: Column) -> Column:
    return F.coalesce(F.md5(doc_id.cast("string")), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Weights repeat over the sources in code-point order. The level at which
    words are shared rises as sources reach their stop; each step is one
    aggregate over the sources, of which the driver gets three figures.
    """
    totals = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ranked = prefix_sums(
        totals.select("source", "source_size", F.lit(0).alias("all"), F.lit(1).cast("long").alias("one")),
        "all",
        [F.col("source").asc_nulls_last()],
        "one",
        "source-order",
    )
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("before") % len(weights)).cast("int"))
    sources = materialize(
        ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("stop")),
        "source-weights",
    )
    total, free = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    budget, stopped = share * total, 0
    while True:
        level = (budget - stopped) / free if free else float("inf")
        at_stop = F.col("stop") < F.col("weight") * F.lit(level)
        now_stopped, now_free = sources.agg(
            F.coalesce(F.sum(F.when(at_stop, F.col("stop"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~at_stop, F.col("weight"))), F.lit(0)),
        ).first()
        if (now_stopped, now_free) == (stopped, free):
            break
        stopped, free = now_stopped, now_free
    shared = F.col("weight") * F.lit(float(budget - stopped)) / F.lit(float(free or 1))
    return sources.select(
        "source", "source_size", F.when(at_stop, F.col("stop").cast("double")).otherwise(shared).alias("target")
    )


def _placed(docs: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """A row per distinct (doc_id, source, size, text hash): its place, its source's budget, its taken words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size_of(F.col("text")).alias("size"),
        F.xxhash64(F.col("text").cast("string")).alias("key"),
    )
    # Copies of a row meet before the sort; partial sums keep a hot row spread.
    rows = materialize(rows.groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("copies")), "mix-sizes")
    rows = rows.withColumn("words", F.col("size") * F.col("copies"))
    budgets = materialize(
        targets(rows.select("source", F.col("words").alias("size")), weights, share, max_epochs), "mix-targets"
    ).withColumnRenamed("source", "_source")
    ordered = prefix_sums(
        rows.withColumn("order", _order_key(F.col("doc_id"))),
        "source",
        [F.col("order"), F.col("doc_id"), F.col("size"), F.col("key")],
        "words",
        "mix-order",
    )
    limit = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr("div(_limit, source_size)")).otherwise(F.lit(0).cast("long"))
    left = F.greatest(F.col("rest") - F.col("before"), F.lit(0))
    part = F.least(F.expr("div(_left, copies)"), F.col("size"))
    return (
        ordered.join(budgets, F.col("source").eqNullSafe(F.col("_source")), "inner")
        .drop("_source")
        .withColumn("_limit", limit)
        .withColumn("epochs", epochs)
        .withColumn("rest", F.col("_limit") - F.col("epochs") * F.col("source_size"))
        .withColumn("_left", left)
        .withColumn("part", part)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
        .drop("_limit", "_left")
    )


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), a row for each row of ``docs``."""
    placed = _placed(docs, weights, share, max_epochs)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return placed.select("doc_id", "source", "size", "source_size", "target", "taken", each).drop("copy")


def first_words(text: Column, n: Column) -> Column:
    """The prefix of ``text`` that ends with its n-th word, white space as it is."""
    blank = "[ \\x09-\\x0D]"
    pieces = F.split(F.rtrim(text, F.lit(SPACES)), f"(?<!{blank})(?={blank})")
    return F.array_join(F.slice(pieces, 1, n.cast("int")), "")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents of the mix: a row per epoch, the document at a source's cut with its first words only.

    Texts are not shuffled to find their place: a source's cut is one order
    key, joined by source, and each row compares its own key with it.
    ``n_chars``, if there, follows a cut text.
    """
    placed = _placed(docs, weights, share, max_epochs)
    place = F.struct("order", "doc_id", "size", "key")
    at_cut = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    cuts = materialize(
        placed.groupBy("source").agg(
            F.first("epochs").alias("_epochs"), F.min(F.when(at_cut, F.struct(place.alias("place"), "part"))).alias("_cut")
        ),
        "mix-cuts",
    ).withColumnRenamed("source", "_source")
    columns = docs.columns
    rows = docs.select(
        F.struct(*[F.col(c).alias(c) for c in columns if c != "text"]).alias("_row"),
        F.col("text").cast("string").alias("_text"),
        F.col("source").cast("string").alias("_own"),
        F.struct(
            _order_key(F.col("doc_id").cast("long")).alias("order"),
            F.col("doc_id").cast("long").alias("doc_id"),
            size_of(F.col("text")).alias("size"),
            F.xxhash64(F.col("text").cast("string")).alias("key"),
        ).alias("_place"),
    )
    joined = rows.join(cuts, F.col("_own").eqNullSafe(F.col("_source")), "inner")
    # Without a cut nothing is left over after the whole epochs.
    part = (
        F.when(F.col("_cut").isNull() | (F.col("_place") > F.col("_cut.place")), F.lit(0))
        .when(F.col("_place") == F.col("_cut.place"), F.col("_cut.part"))
        .otherwise(F.col("_place.size"))
    )
    size = F.col("_place.size")
    whole = F.when(size == 0, F.lit(0)).otherwise(F.col("_epochs") + (F.col("_part") == size).cast("long"))
    cut_too = (F.col("_part") > 0) & (F.col("_part") < size)
    takes = F.concat(
        F.array_repeat(F.lit(False), whole.cast("int")), F.when(cut_too, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    )
    taken = joined.withColumn("_part", part).select("_row", "_text", "_part", F.explode(takes).alias("_is_cut"))
    text = F.when(F.col("_is_cut"), first_words(F.col("_text"), F.col("_part"))).otherwise(F.col("_text"))
    out = {c: F.col("_row").getField(c) for c in columns if c != "text"} | {"text": text}
    if "n_chars" in columns:
        n_chars = F.when(F.col("_is_cut"), F.length(text)).otherwise(F.col("_row").getField("n_chars"))
        out["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return taken.select(*[out[c].alias(c) for c in columns])
