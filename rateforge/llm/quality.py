"""Document quality rules with cross-document line frequency, in DataFrame operations only.

Base figures come from a document's own text. The method then looks across
documents: each line is normalised (lower case, outer white space stripped,
inner white space one space) and hashed, the distinct documents of a line are
counted per host, lines above the limit are removed, and a document that is
left depleted is rejected.

Limits: a line is removed from the documents of a host if it stands in more
than ``max_docs`` of its distinct documents, however many the host has. A
document that lost lines is depleted if fewer than ``min_words`` words or less
than ``min_left`` of its words are left.

Documents of a line are made distinct per task before the shuffle and counted
per task after it, so a host or a line that holds a third of all rows stays
spread. ``clean`` joins what a document loses to its text by one sort-merge
join at every size, and sends no text that fails on its own figures.

Defined cases: a null text is an empty one (no words, rejected); documents with
a null host form a host of their own; rows of one doc_id are one document for
the limit, whatever their texts, and rows without an id count for no line,
while every row loses lines and gets its verdict by itself; a text of any
length is taken whole, its lines and windows being arrays inside its row; a
line that stands in exactly ``max_docs`` documents, or a document that is left
with exactly the least words or share, stays; equal lines of a document are one
line with the words of all; extra columns are kept by ``clean`` and ignored by
``judge``, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize

SPACES = " \t\n\x0b\f\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 10
MIN_LEFT = 0.5
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The maximal runs of characters outside space, tab, LF, VT, FF and CR."""
    stripped = F.trim(text, F.lit(SPACES))
    return F.when(F.length(stripped) > 0, F.split(stripped, "[ \\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def _tail(values: Column, start: int) -> Column:
    return F.slice(values, start, F.greatest(F.size(values) - (start - 1), F.lit(0)))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are hashed and sorted with their place; places of equal neighbours
    are the repeated windows, and each adds the words that the one before it
    did not cover.
    """

    def covered(places: Column) -> Column:
        steps = F.zip_with(places, _tail(places, 2), lambda a, b: F.least(F.lit(3), b - a))
        return F.when(F.size(places) == 0, F.lit(0).cast("long")).otherwise(
            F.lit(3).cast("long")
            + F.aggregate(F.slice(steps, 1, F.size(places) - 1), F.lit(0).cast("long"), lambda s, x: s + x)
        )

    def repeated(ordered: Column) -> Column:
        same = F.filter(F.arrays_zip(ordered.alias("a"), _tail(ordered, 2).alias("b")), lambda p: p["a"]["h"] == p["b"]["h"])
        first = F.transform(same, lambda p: p["a"]["i"])
        return F.sort_array(F.array_union(first, F.transform(same, lambda p: p["b"]["i"])))

    windows = F.slice(
        F.arrays_zip(words.alias("a"), _tail(words, 2).alias("b"), _tail(words, 3).alias("c")), 1, F.size(words) - 2
    )
    hashed = F.transform(windows, lambda w, i: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), i.cast("long").alias("i")))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        _let(F.sort_array(hashed), lambda ordered: _let(repeated(ordered), covered))
    )


def base_figures(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    return (
        docs.withColumn("_words", words_of(text))
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
                "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
                "n_repeat_words": _repeat_words(F.col("_words")),
            }
        )
        .drop("_words")
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
    )


def _normal_lines(text: Column) -> Column:
    """The lines of a text as they are compared: lower case, white space trimmed and made single.

    The whole text is made even once (most need nothing), so that a line costs
    a trim and no pattern.
    """
    low = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    even = F.when(low.rlike("  |[\\t\\x0B\\f\\r]"), F.regexp_replace(low, "[ \\t\\x0B\\f\\r]+", " ")).otherwise(low)
    return F.transform(F.split(even, "\n", -1), lambda x: F.trim(x))


def _row_key() -> Column:
    """Equal for rows of equal id, host and text only (but for hash collisions of one id)."""
    return F.xxhash64(F.col("source"), F.col("text").cast("string"))


def _measured_lines(text: Column) -> Column:
    """(line hash, words) of each line with a word; a normal line's words are its spaces and one."""
    return F.transform(
        F.filter(_normal_lines(text), lambda x: x != ""),
        lambda x: F.struct(
            F.xxhash64(x).alias("line"),
            (F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("long").alias("words"),
        ),
    )


def frequent_lines(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(source, line, n_docs): the lines that stand in more than ``max_docs`` distinct documents of a host.

    A document's equal lines are made one inside its row.
    """
    hashes = F.transform(F.filter(_normal_lines(F.col("text")), lambda x: x != ""), lambda x: F.xxhash64(x))
    lines = docs.select("doc_id", "source", F.explode(F.array_distinct(hashes)).alias("line"))
    counts = lines.groupBy("source", "line").agg(F.count_distinct("doc_id").alias("n_docs"))
    return counts.where(F.col("n_docs") > max_docs)


def removed_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, key, lines, words_removed): what each document loses to its host's frequent lines."""
    lines = docs.select("doc_id", _row_key().alias("key"), "source", F.posexplode(_measured_lines(F.col("text"))))
    f = frequent.select(F.col("source").alias("f_source"), F.col("line").alias("f_line"))
    hits = lines.join(
        f, (F.col("col.line") == F.col("f_line")) & F.col("source").eqNullSafe(F.col("f_source")), "inner"
    )
    # A set of places per document: repeated rows add nothing.
    per_doc = hits.groupBy("doc_id", "key").agg(F.collect_set(F.struct("pos", "col")).alias("hit"))
    return per_doc.select(
        "doc_id",
        "key",
        F.array_distinct("hit.col.line").alias("lines"),
        F.aggregate("hit.col.words", F.lit(0).cast("long"), lambda s, x: s + x).alias("words_removed"),
    )


def _removed(docs: DataFrame, max_docs: int) -> DataFrame:
    """(_doc, _doc_key, _lines, _words_removed) of the documents that lose lines, written."""
    frequent = materialize(frequent_lines(docs, max_docs), "frequent-lines")
    return materialize(removed_lines(docs, frequent), "removed-lines").select(
        F.col("doc_id").alias("_doc"),
        F.col("key").alias("_doc_key"),
        F.col("lines").alias("_lines"),
        F.col("words_removed").alias("_words_removed"),
    )


def _join_removed(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """``rows`` (doc_id, _key and others) with _lines and _words_removed, null where nothing goes."""
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_doc_key"))
    return rows.join(removed, same, "left").drop("_doc", "_doc_key", "_key")


def _verdict(rows: DataFrame, min_words: int, min_left: float) -> DataFrame:
    left = F.col("n_words") - F.coalesce("_words_removed", F.lit(0).cast("long"))
    depleted = F.col("_lines").isNotNull() & ((left < min_words) | (left < min_left * F.col("n_words")))
    return rows.withColumns(
        {
            "lines_removed": F.coalesce(F.size("_lines"), F.lit(0)).cast("long"),
            "words_left": left,
            "kept": ~F.col("base_failed") & ~depleted,
        }
    ).drop("_words_removed")


def judge(
    docs: DataFrame, max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT
) -> DataFrame:
    """The base figures and the verdict of each document, without its text.

    Columns: doc_id, FIGURES, lines_removed (distinct lines), words_left, kept.
    Only these narrow rows are joined.
    """
    docs = docs.select("doc_id", "text", "source")
    figures = base_figures(docs.withColumn("_key", _row_key())).select("doc_id", "_key", *FIGURES)
    return _verdict(_join_removed(figures, _removed(docs, max_docs)), min_words, min_left).drop("_lines")


def clean(
    docs: DataFrame, max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT
) -> DataFrame:
    """The documents that are kept, with ``text`` free of the lines above the limit.

    The columns are those of ``docs``; ``n_chars``, if there, follows the text
    where lines went.
    """
    columns = docs.columns
    rest = [F.col(c).alias(c) for c in columns if c != "text"]
    own = docs.select("doc_id", "text", "source", F.struct(*rest).alias("_row"))
    sound = base_figures(own.withColumn("_key", _row_key())).where(~F.col("base_failed"))
    # The written side grows with the documents: the same join whatever its size.
    removed = _removed(docs.select("doc_id", "text", "source"), max_docs).hint("merge")
    kept = _verdict(_join_removed(sound, removed), min_words, min_left).where("kept")
    text = _without(F.col("text"), F.col("_lines"))
    out = {c: F.col("_row").getField(c) for c in columns if c != "text"} | {"text": text}
    if "n_chars" in columns:
        n_chars = F.when(F.col("_lines").isNull(), F.col("_row").getField("n_chars")).otherwise(F.length(text))
        out["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return kept.select(*[out[c].alias(c) for c in columns])


def _without(text: Column, lines: Column) -> Column:
    """``text`` without the lines whose normal form's hash is in ``lines``."""
    pairs = F.arrays_zip(F.split(text, "\n", -1).alias("line"), _normal_lines(text).alias("normal"))
    kept = F.filter(pairs, lambda p: ~F.array_contains(lines, F.xxhash64(p["normal"])))
    return F.when(lines.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda p: p["line"]), "\n"))
