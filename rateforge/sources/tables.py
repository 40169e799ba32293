"""Rating-domain inputs derived from the TPC-H-style test tables.

The test data holds no ratings or profiles, so each entity is defined as a
Spark job over the given tables (every definition scales with them). The job
writes the files that an input folder would hold, CSV or JSON lines in the
shared folder, once per session and source; the readers of ``sources.files``
then read them, header lines, file order and all.

ratings   lineitem joined to orders: user = o_custkey, item = l_partkey,
          rating = floor((l_quantity - 1) / 10) + 1, i.e. 1..5; a header in
          every file
users     customers outside segment MACHINERY with at least one order;
          review_count = orders, average_stars = avg(o_orderkey % 5 + 1),
          yelping_since = first order date; useful / funny / cool / fans =
          click / purchase / view / signup events of the user;
          compliment j (j = 1..11) = (c_custkey * j) % 7
items     parts with p_size <= 40; review_count / stars = count / average
          rating of the part's lineitems (its published profile; read from
          lineitem alone, no join); is_open = p_partkey % 4 <> 0;
          latitude = p_retailprice - 945 (null when p_partkey % 10 = 0),
          longitude = p_size * 7 - 180; attributes: see ``attribute_entries``
visits    events per item k = props.k, keyed by slot "<weekday>-<hour>"
tips      click events: (user_id, item k, likes = floor(value)), in files
          ordered by (ts, event_id)
photos    view events, one photo per event, of item k
pairs     view events: (user_id, item k, value) of every view in the order of
          event_id, duplicates kept - the pairs a user looked at, to be
          scored; one header, at the top of the first file
as_of     2002-01-01

Keyed rows (users, items, visits) have older copies with other values, for two
ids of three: one far before the row, mostly in another file, and one right
before it. An item whose id leaves 1 when divided by 3 has its coordinates in
the row before the last, which has none.

``load`` gives the inputs of one run: either the whole ratings for training
and the view pairs for scoring, or (``evaluate=True``) the train split of the
ratings for training and the hold-out split, with its ratings, for scoring.
"""

from __future__ import annotations

import datetime as _dt
import math
import os
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.evaluation import HOLDOUT, TRAIN, with_split
from ..session import ensure_checkpoint_dir, input_bytes
from . import files, shared
from .bundle import Inputs

AS_OF = _dt.date(2002, 1, 1)

# Test-table mapping constants (definitions of this adapter, not of the job).
EXCLUDED_SEGMENT = "MACHINERY"
MAX_KNOWN_SIZE = 40
EVENT_COUNTERS = [("useful", "click"), ("funny", "purchase"), ("cool", "view"), ("fans", "signup")]
NOISE_BY_TYPE = {"ECONOMY": "quiet", "SMALL": "average", "MEDIUM": "loud", "LARGE": "very_loud", "PROMO": "unknown"}


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``; one resolved reader per session,
    so a plan that uses a table in several branches lists and parses it once."""
    key = (spark.sparkContext.applicationId, id(spark._jsparkSession), sf_dir, name)
    df = _TABLES.get(key)
    if df is None:
        df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        _TABLES[key] = df
    return df


#: Bytes of the test tables for each file of a source, and the files it has at least.
FILE_BYTES = 128 * 1024 * 1024
MIN_FILES = 4

_STAGED: dict[tuple, str] = {}


def staged(spark: SparkSession, sf_dir: str, source: str) -> str:
    """The folder with the files of ``source``, written on first use in a session."""
    key = (spark.sparkContext.applicationId, ensure_checkpoint_dir(spark), sf_dir, source)
    if key not in _STAGED:
        path = shared.shared_path(spark, f"source-{source}")
        n = max(MIN_FILES, math.ceil(input_bytes(spark, [sf_dir]) / FILE_BYTES))
        make, *order = SOURCES[source]
        rows = make(spark, sf_dir)
        if order:
            # Text files that follow each other in the order of the given columns.
            rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(files.LINE).write.text(path)
        elif files.LINE in rows.columns:
            rows.repartition(n).write.text(path)
        else:
            rows.repartition(n).write.option("header", True).csv(path)
        _STAGED[key] = path
    return _STAGED[key]


def _json(**fields: Column) -> Column:
    """A JSON line; null fields are left out."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()])).alias(files.LINE)


LAST, BEFORE, OLD = 0, 1, 2


def _versions(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with their older copies: ``_version`` LAST, BEFORE or OLD, and ``_place`` in the files."""
    k = F.col(key)
    place = F.shiftrightunsigned(F.xxhash64(k), 2) + F.lit(4)
    version = lambda number, at: F.struct(F.lit(number).alias("v"), at.cast("long").alias("at"))
    some = F.array(
        version(LAST, place),
        F.when(k % 3 == 1, version(BEFORE, place - 1)),
        F.when(k % 3 != 2, version(OLD, F.shiftright(place, 1))),
        F.when(k % 3 == 0, version(OLD, place - 1)),
    )
    return rows.withColumn("_v", F.explode(F.filter(some, lambda v: v.isNotNull()))).select(
        *rows.columns, F.col("_v.v").alias("_version"), F.col("_v.at").alias("_place")
    )


def _stale(true: Column, other: Column) -> Column:
    """The value of a field in the last version of a row, and in the older ones."""
    return F.when(F.col("_version") == LAST, true).otherwise(other)


def _with_ids(rows: DataFrame) -> DataFrame:
    """The parsers' text ids as the tables' integer ids."""
    ids = {c: F.col(c).cast("long") for c in ("user_id", "item_id") if c in rows.columns}
    return rows.withColumns(ids)


def event_item(props: str | Column = "props") -> Column:
    """Item key of an event: the integer ``k`` of its JSON properties."""
    c = F.col(props) if isinstance(props, str) else props
    return F.get_json_object(c, "$.k").cast("long")


def rating_of_quantity(quantity: str = "l_quantity") -> Column:
    """Rating 1..5 of a lineitem: floor((quantity - 1) / 10) + 1."""
    return (F.floor((F.col(quantity) - F.lit(1)) / F.lit(10)) + F.lit(1)).cast("double")


def rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return joined.select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("business_id"), rating_of_quantity().alias("stars")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ids(files.read_ratings(spark, staged(spark, sf_dir, "ratings")))


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") != F.lit(EXCLUDED_SEGMENT))
        .select(F.col("c_custkey").alias("user_id"))
    )
    per_user = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.avg(((F.col("o_orderkey") % 5) + 1).cast("double")).alias("average_stars"),
            F.min("o_orderdate").alias("_first"),
        )
    )
    events = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(*[F.count_if(F.col("event_type") == F.lit(t)).alias(name) for name, t in EVENT_COUNTERS])
    )
    rows = _versions(cust.join(per_user, "user_id", "inner").join(events, "user_id", "left"), "user_id")
    version = F.col("_version").cast("long")
    counters = {name: F.coalesce(F.col(name), F.lit(0)).cast("long") + version for name, _ in EVENT_COUNTERS}
    compliments = {
        c: ((F.col("user_id") * F.lit(j)) % 7).cast("long") + version for j, c in enumerate(S.COMPLIMENT_FIELDS, 1)
    }
    line = _json(
        user_id=F.col("user_id"),
        review_count=F.col("review_count") + version * 1000,
        average_stars=_stale(F.col("average_stars"), F.lit(0.5)),
        yelping_since=_stale(F.date_format("_first", "yyyy-MM-dd"), F.lit("1990-01-01")),
        **counters,
        **compliments,
    )
    return rows.select(line, "_place")


def users(spark: SparkSession, sf_dir: str, fields: Collection[str] | None = None) -> DataFrame:
    """The users; given ``fields``, only these and the id."""
    return _with_ids(files.read_users(spark, staged(spark, sf_dir, "users"), fields))


def attribute_entries() -> list[Column]:
    """(key, value) structs of a part's attribute map; a null value means absent.

    Flag j (1-based position in the flag list): (p_partkey * j + p_size) % 3 is
    0 -> "True", 1 -> "False", 2 -> absent. NoiseLevel from p_type (STANDARD
    absent, PROMO an unknown word). Price tier p_size % 7: 1..4 as text,
    0 -> "None", else absent. Ordinal m (1-based, WiFi .. Smoking):
    (p_partkey + m * p_size) % 4 picks the m-th value of the code table in
    code order, 3 -> absent.
    """
    pk, size = F.col("p_partkey"), F.col("p_size")
    out = []
    for j, (_, key) in enumerate(S.FLAG_ATTRIBUTES, 1):
        r = (pk * F.lit(j) + size) % 3
        out.append(F.struct(F.lit(key).alias("k"), F.when(r == 0, F.lit(S.FLAG_TRUE)).when(r == 1, F.lit(S.FLAG_FALSE)).alias("v")))
    noise = F.create_map(*[x for t, w in NOISE_BY_TYPE.items() for x in (F.lit(t), F.lit(w))])[F.col("p_type")]
    out.append(F.struct(F.lit(S.ORDINAL_ATTRIBUTES[0][1]).alias("k"), noise.alias("v")))
    tier = size % 7
    out.append(
        F.struct(
            F.lit(S.PRICE_ATTRIBUTE).alias("k"),
            F.when(tier == 0, F.lit("None")).when(tier <= 4, tier.cast("string")).alias("v"),
        )
    )
    for m, (_, key, codes) in enumerate(S.ORDINAL_ATTRIBUTES[1:], 1):
        level = (pk + F.lit(m) * size) % 4
        words = sorted(codes, key=codes.get)
        value = F.when(level == 0, F.lit(words[0])).when(level == 1, F.lit(words[1])).when(level == 2, F.lit(words[2]))
        out.append(F.struct(F.lit(key).alias("k"), value.alias("v")))
    return out


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("part"))
        .agg(F.count(F.lit(1)).alias("_n"), F.avg(rating_of_quantity()).alias("stars"))
    )
    parts = table(spark, sf_dir, "part").where(F.col("p_size") <= F.lit(MAX_KNOWN_SIZE))
    rows = _versions(parts.join(stats, parts.p_partkey == stats.part, "left"), "p_partkey")
    version = F.col("_version").cast("long")
    entries = F.filter(F.array(*attribute_entries()), lambda e: e["v"].isNotNull())
    old = F.create_map(F.lit(S.PRICE_ATTRIBUTE), F.lit("9"), F.lit(S.FLAG_ATTRIBUTES[0][1]), F.lit(S.FLAG_TRUE), F.lit("Gone"), F.lit("yes"))
    moved = F.col("p_partkey") % 3 == 1
    latitude = F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice") - F.lit(945.0))
    line = _json(
        business_id=F.col("p_partkey"),
        review_count=F.coalesce(F.col("_n"), F.lit(0)).cast("long") + version * 1000,
        stars=_stale(F.col("stars"), F.lit(0.5)),
        is_open=((F.col("p_partkey") % 4 != 0).cast("int") + F.col("_version")).cast("int"),
        # Where the last row has no coordinates, the one before it has the true ones.
        latitude=F.when(version == BEFORE, latitude).when(version == LAST, F.when(~moved, latitude)).otherwise(latitude + 1.0),
        longitude=(F.col("p_size") * 7 - 180 + F.when(version == OLD, 1).otherwise(0)).cast("double"),
        attributes=_stale(F.map_from_entries(entries), old),
    )
    return rows.select(line, "_place")


def items(spark: SparkSession, sf_dir: str, fields: Collection[str] | None = None, every_attribute: bool = False) -> DataFrame:
    """The items; given ``fields``, only these and the id. ``every_attribute`` keeps those that no feature reads."""
    keys = None if every_attribute else S.ATTRIBUTE_KEYS
    return _with_ids(files.read_items(spark, staged(spark, sf_dir, "items"), fields, keys))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def visit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item with a slot -> count map (at most 7 * 24 entries)."""
    slot = F.concat_ws("-", F.date_format("ts", "E"), F.hour("ts").cast("string"))
    per_slot = (
        _events(spark, sf_dir)
        .select(event_item().alias("item"), slot.alias("slot"))
        .groupBy("item", "slot")
        .agg(F.count(F.lit(1)).cast("int").alias("n"))
    )
    time = F.map_from_entries(F.collect_list(F.struct("slot", "n")))
    rows = _versions(per_slot.groupBy("item").agg(time.alias("time")), "item")
    old = F.create_map(F.lit("Mon-1"), F.lit(1_000_000), F.lit("Tue-0"), F.lit(1))
    line = _json(business_id=F.col("item"), time=_stale(F.col("time"), old))
    return rows.select(line, "_place")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ids(files.read_visits(spark, staged(spark, sf_dir, "visits")))


def tip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = _events(spark, sf_dir).where(F.col("event_type") == F.lit("click"))
    line = _json(user_id=F.col("user_id"), business_id=event_item(), likes=F.floor("value").cast("long"))
    return clicks.select(line, "ts", "event_id")


def tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ids(files.read_tips(spark, staged(spark, sf_dir, "tips")))


def photo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = _events(spark, sf_dir).where(F.col("event_type") == F.lit("view"))
    return views.select(_json(business_id=event_item()))


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ids(files.read_photos(spark, staged(spark, sf_dir, "photos")))


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = _events(spark, sf_dir).where(F.col("event_type") == F.lit("view"))
    line = F.concat_ws(",", F.col("user_id"), event_item(), F.col("value")).alias(files.LINE)
    # The header has no place and is sorted before every place.
    header = spark.range(1).select(F.lit("user_id,business_id,stars").alias(files.LINE), F.lit(None).cast("long").alias("event_id"))
    return views.select(line, "event_id").unionByName(header)


def pairs(spark: SparkSession, sf_dir: str, with_line: bool = False) -> DataFrame:
    """Pairs to score: (user, item) of every view event, duplicates kept; with its line number, if asked."""
    return _with_ids(files.read_pairs(spark, staged(spark, sf_dir, "pairs"), with_line=with_line))


#: What the files of a source are made of, and the columns that order them.
SOURCES = {
    "ratings": (rating_rows,),
    "users": (user_lines, "_place"),
    "items": (item_lines, "_place"),
    "visits": (visit_lines, "_place"),
    "tips": (tip_lines, "ts", "event_id"),
    "photos": (photo_lines,),
    "pairs": (pair_lines, "event_id"),
}


def load(spark: SparkSession, sf_dir: str, evaluate: bool = False) -> Inputs:
    """All inputs of one run over the test tables of ``sf_dir``.

    Default: train on all ratings, score the view pairs. ``evaluate``: train on
    the train split, score the hold-out split with its ratings kept, so that
    the run can report its error; the ratings join is then written once to
    the shared folder and both splits read it. Item averages cover
    all lineitems of a part in both cases, as a published profile would.
    """
    r = ratings(spark, sf_dir)
    if evaluate:
        split = with_split(shared.materialize(r, "ratings"))
        train = split.where(F.col("split") == F.lit(TRAIN)).drop("split")
        to_score = split.where(F.col("split") == F.lit(HOLDOUT)).drop("split")
    else:
        train, to_score = r, pairs(spark, sf_dir, with_line=True)
    return Inputs(
        ratings=train,
        pairs=to_score,
        users=users(spark, sf_dir),
        items=items(spark, sf_dir),
        visits=visits(spark, sf_dir),
        tips=tips(spark, sf_dir),
        photos=photos(spark, sf_dir),
        as_of=AS_OF,
    )
