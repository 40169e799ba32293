"""File sources (ratings and pair CSVs, profile JSON lines) and the prediction sink.

Each source is read in two steps: lines, with their place in the files, and a
parser over lines. The parsers are strict: a line that is not JSON, a value of
the wrong type, or a required key that is absent stops the job with an error
that names the line, as the original job would stop. All parsers return the
canonical entity columns (``item_id`` instead of ``business_id``). Keyed
sources keep one row per key, the last one in file order, which is what a
driver-side dict built from the file would hold.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.dedupe import last_per_key
from ..session import shuffle_partitions
from . import shared

#: The column of a line's text, of its place in the files, and of its number among all lines.
LINE = "value"
ORDER = "_seq"
NUMBER = "line"


def file_order() -> Column:
    """An orderable marker of a row's position in the input files.

    Rows of one file split are read in order, so (file, split start,
    monotonically increasing id) sorts rows as they appear in the files. The
    value is recomputed identically when a task is retried.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, _seq): the lines of the files under ``path`` with their place."""
    return spark.read.text(path).select(LINE, file_order().alias(ORDER))


def numbered(lines: DataFrame) -> DataFrame:
    """(value, line): the lines with their number, from 0, in file order.

    The lines are written once, so that their places and the counts of earlier
    splits come from the same read however the files were split. A line's
    number is its rank in its own split (at most one split is in a task) plus
    the lines of the splits before it (one row per split meets in one task).
    """
    place = [F.col(ORDER)[c].alias(f"_{c}") for c in ("file", "block", "row")]
    kept = shared.materialize(lines.select(LINE, *place), "lines")
    split = ["_file", "_block"]
    sizes = kept.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*split, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*split).orderBy("_row"))
    ranked = kept.withColumn("_rank", rank)
    return ranked.join(before, split).select(LINE, (F.col("_before") + F.col("_rank") - 1).alias(NUMBER))


def _stop(reason: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{reason}: "), F.coalesce(F.substring(LINE, 1, 200), F.lit("null"))))


# --- CSV ---------------------------------------------------------------------


def csv_fields(lines: DataFrame, header: str | None) -> DataFrame:
    """Lines other than the header, split on ',' (``f``), beside the line itself.

    Every line equal to the header goes. No quoting rules apply: a comma
    always separates fields. Surrounding white space of a line is stripped.
    """
    if header is not None:
        lines = lines.where(F.col(LINE) != F.lit(header))
    stripped = F.regexp_replace(F.col(LINE), r"^\s+|\s+$", "")
    kept = [NUMBER] if NUMBER in lines.columns else []
    return lines.select(LINE, F.split(stripped, ",").alias("f"), *kept)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of the first file, by path, that has one."""
    for file in sorted(spark.read.text(path).inputFiles()):
        row = spark.read.text(file).first()
        if row is not None:
            return row[LINE]
    return None


def _field(number: int) -> Column:
    value = F.get("f", F.lit(number))
    return F.when(value.isNull(), _stop("too few fields")).otherwise(value)


def _rating() -> Column:
    number = F.trim(_field(2)).try_cast("double")
    return F.when(number.isNull(), _stop("not a rating")).otherwise(number)


def parse_ratings(lines: DataFrame, header: str | None = None) -> DataFrame:
    """(user_id, item_id, rating)."""
    return csv_fields(lines, header).select(
        _field(0).alias("user_id"), _field(1).alias("item_id"), _rating().alias("rating")
    )


def parse_pairs(lines: DataFrame, header: str | None = None, with_rating: bool = False) -> DataFrame:
    """(user_id, item_id) of every scoring line, duplicates kept; further
    columns are ignored unless ``with_rating`` keeps the third as a label.
    The lines' numbers are kept if they have them."""
    columns = [_field(0).alias("user_id"), _field(1).alias("item_id")]
    if with_rating:
        columns.append(_rating().alias("rating"))
    if NUMBER in lines.columns:
        columns.append(F.col(NUMBER))
    return csv_fields(lines, header).select(*columns)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return parse_ratings(read_lines(spark, path), first_line(spark, path))


def read_pairs(spark: SparkSession, path: str, with_rating: bool = False, with_line: bool = False) -> DataFrame:
    """S2 from files; ``with_line`` adds the number of the line, from 0, among those that are not the header."""
    header, lines = first_line(spark, path), read_lines(spark, path)
    if with_line:
        lines = numbered(lines if header is None else lines.where(F.col(LINE) != F.lit(header)))
    return parse_pairs(lines, header, with_rating)


# --- JSON lines --------------------------------------------------------------


def parse_json(
    lines: DataFrame,
    schema: T.StructType,
    required: list[str],
    present: list[str] | None = None,
    fields: Collection[str] | None = None,
) -> DataFrame:
    """The fields of ``schema`` from JSON lines, and ``_seq`` if the lines have it.

    ``required`` fields must hold a value; ``present`` ones must be in the
    line but may be null there. Anything else may be absent. Given ``fields``,
    only these and the ids are parsed and checked.
    """
    if fields is not None:
        schema = T.StructType([f for f in schema.fields if f.name in fields or f.name in ("user_id", "business_id")])
    rows = lines.withColumn("_json", F.from_json(LINE, schema, {"mode": "FAILFAST"}))
    columns = []
    for field in schema.fieldNames():
        value = F.col("_json").getField(field)
        if field in required:
            # also null when the line holds no object at all
            value = F.when(value.isNull(), _stop(f"no {field}")).otherwise(value)
        elif field in (present or []):
            absent = ~F.coalesce(F.array_contains(F.json_object_keys(LINE), field), F.lit(False))
            value = F.when(value.isNull() & absent, _stop(f"no {field}")).otherwise(value)
        columns.append(value.alias(field))
    order = [ORDER] if ORDER in lines.columns else []
    return rows.select(*columns, *order)


def parse_users(lines: DataFrame, fields: Collection[str] | None = None) -> DataFrame:
    """S3: user profiles, a row per line."""
    return parse_json(lines, S.USERS_JSON, ["user_id", *S.INTERACTION_FIELDS, *S.COMPLIMENT_FIELDS], fields=fields)


def parse_items(lines: DataFrame, fields: Collection[str] | None = None) -> DataFrame:
    """Item profiles with the attribute map, a row per line."""
    rows = parse_json(lines, S.ITEMS_JSON, ["business_id"], ["is_open"], fields)
    return rows.withColumnRenamed("business_id", "item_id")


def parse_visits(lines: DataFrame) -> DataFrame:
    """(item_id, time map of slot -> count), a row per line."""
    return parse_json(lines, S.VISITS_JSON, ["business_id", "time"]).withColumnRenamed("business_id", "item_id")


def parse_tips(lines: DataFrame) -> DataFrame:
    """Every tip (user_id, item_id, likes) with its place ``_seq``."""
    return parse_json(lines, S.TIPS_JSON, ["user_id", "business_id", "likes"]).withColumnRenamed("business_id", "item_id")


def parse_photos(lines: DataFrame) -> DataFrame:
    """(item_id), one row per photo."""
    rows = parse_json(lines, S.PHOTOS_JSON, ["business_id"]).withColumnRenamed("business_id", "item_id")
    return rows.select("item_id")


def latest_items(rows: DataFrame, attribute_keys: Collection[str] | None = S.ATTRIBUTE_KEYS) -> DataFrame:
    """One row per item: the last one, but the location of the last one that has both coordinates.

    Attributes other than ``attribute_keys`` (by default those that a feature
    reads; None for all) are left out before the rows are shuffled. Fields that
    ``rows`` lack stay out.
    """
    rest = [c for c in ("review_count", "stars", "is_open", "attributes") if c in rows.columns]
    place = [c for c in ("latitude", "longitude") if c in rows.columns]
    if "attributes" in rest and attribute_keys is not None:
        used = [F.lit(k) for k in attribute_keys]
        rows = rows.withColumn("attributes", F.map_filter("attributes", lambda k, _: k.isin(used)))
    aggs = []
    if rest:
        aggs.append(F.max_by(F.struct(*rest), ORDER).alias("_last"))
    if place:
        both = F.lit(True)
        for c in place:
            both = both & F.col(c).isNotNull()
        aggs.append(F.max_by(F.struct(*place), F.when(both, F.col(ORDER))).alias("_place"))
    if not aggs:
        return rows.select("item_id").distinct()
    columns = {c: F.col("_last").getField(c) for c in rest} | {c: F.col("_place").getField(c) for c in place}
    names = [f for f in S.ITEMS_JSON.fieldNames() if f in columns]
    return rows.groupBy("item_id").agg(*aggs).select("item_id", *[columns[c].alias(c) for c in names])


def read_users(spark: SparkSession, path: str, fields: Collection[str] | None = None) -> DataFrame:
    """S3: one row per user_id (last wins); only ``fields``, if given."""
    return last_per_key(parse_users(read_lines(spark, path), fields), ["user_id"], ORDER)


def read_items(
    spark: SparkSession,
    path: str,
    fields: Collection[str] | None = None,
    attribute_keys: Collection[str] | None = S.ATTRIBUTE_KEYS,
) -> DataFrame:
    """One row per item_id (see ``latest_items``); only ``fields``, if given."""
    return latest_items(parse_items(read_lines(spark, path), fields), attribute_keys)


def read_visits(spark: SparkSession, path: str) -> DataFrame:
    """One row per item_id (last wins)."""
    return last_per_key(parse_visits(read_lines(spark, path)), ["item_id"], ORDER)


def read_tips(spark: SparkSession, path: str) -> DataFrame:
    return parse_tips(read_lines(spark, path))


def read_photos(spark: SparkSession, path: str) -> DataFrame:
    return parse_photos(read_lines(spark, path))


# --- sink --------------------------------------------------------------------


def write_predictions(predictions: DataFrame, path: str, item_header: str = "business_id") -> None:
    """CSV with header user_id,<item_header>,prediction.

    Written as a directory of part files by the executors. Rows that have the
    number of their input line are range-sorted by it, so that the part files,
    one after the other, follow the order of the input; duplicates are kept.
    Values are not clipped.
    """
    if NUMBER in predictions.columns:
        n = shuffle_partitions(predictions.sparkSession)
        predictions = predictions.repartitionByRange(n, NUMBER).sortWithinPartitions(NUMBER)
    (
        predictions.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("item_id").cast("string").alias(item_header),
            F.col("prediction").cast("double").alias("prediction"),
        )
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(line, user_id, item_id, prediction) of a written prediction table, lines from 0 in file order."""
    header, lines = first_line(spark, path), read_lines(spark, path)
    rows = numbered(lines if header is None else lines.where(F.col(LINE) != F.lit(header)))
    return csv_fields(rows, header).select(
        NUMBER, _field(0).alias("user_id"), _field(1).alias("item_id"), _rating().alias("prediction")
    )
