"""Exact top-k search over binary codes by incremental multi-index hashing.

A code (the signs of an embedding) is cut into segments. Two codes at Hamming
distance below ``segments * (r + 1)`` are within r bits in some segment, so
once all segments have been probed at radii 0 .. r, every code nearer than
that has been seen. The radii grow one by one, first for one half of the segments, then
for the other; a query leaves the loop when the k-th distance verified for it
is covered, or when it has seen every code.

Equal codes are one index entry with their k smallest ids (a partial top-k
before the shuffle), and equal query codes are searched once, so groups of
copies neither meet in one task nor multiply. A candidate is verified where the
index is joined: it goes on only from the first of its segments that are
nearest to the query's, hence once in all rounds, and only if it is no farther
than the query's k-th code so far. What goes on is cut to k per query in a
window with a per-task limit. There are two rounds a radius, of at most the bits
of a segment; the driver gets a count per round. The number of segments is the
one with the fewest probes and candidates for so many random codes, so their
length grows with the logarithm of the number of codes; it decides the work
alone, never the result.

Ties: the k results are the first by (distance, id). Defined cases: a null
embedding, or a null id, is neither indexed nor a query; a null or NaN element,
and one that is missing in a short embedding, is a 0 bit; elements beyond
``bits`` are ignored; repeated rows are results of their own; extra columns are
ignored; an empty table gives no rows; fewer than k codes give fewer results.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize

K = 10
BITS = 64
#: Bits of a segment at most, which bounds the probes of the farthest query by 2^22 a segment.
WORD = 22


def code_of(embedding: Column, bits: int = BITS) -> Column:
    """The signs of the first ``bits`` (64 at most) elements as a long; above 0 is 1, the first element the lowest bit."""
    if bits > 64:
        raise ValueError("codes have at most 64 bits")
    signs = [
        F.when((F.get(embedding, F.lit(i)) > 0) & ~F.isnan(F.get(embedding, F.lit(i))), F.lit(1 << i if i < 63 else -(1 << 63)))
        .otherwise(F.lit(0))
        .cast("long")
        for i in range(bits)
    ]
    code = signs[0]
    for s in signs[1:]:
        code = code.bitwiseOR(s)
    return code


def _bounds(n: int, bits: int) -> list[int]:
    return [bits * i // n for i in range(n + 1)]


def _rounds(n: int, length: int) -> list[tuple[int, range]]:
    """The radii, each for one half of the segments and then for the other."""
    half = -(-n // 2)
    return [(r, part) for r in range(length + 1) for part in (range(half), range(half, n)) if part]


def _covered(n: int, radius: int, chosen: range) -> int:
    """The distance up to which all codes are seen: all segments probed to radius - 1, the first ones to radius."""
    return n * radius + chosen.stop - 1


def expected_work(n: int, codes: int, k: int = K, bits: int = BITS) -> float:
    """Probes and candidates of a query among random codes, with n segments."""
    near, within = 0, 1
    while near < bits and codes * within < k << bits:
        near += 1
        within += comb(bits, near)
    bounds, work = _bounds(n, bits), 0.0
    for radius, chosen in _rounds(n, max(b - a for a, b in zip(bounds, bounds[1:]))):
        for i in chosen:
            length = bounds[i + 1] - bounds[i]
            work += comb(length, radius) * (1 + codes / 2**length)
        if _covered(n, radius, chosen) >= near:
            break
    return work


def segment_count(codes: int, k: int = K, bits: int = BITS) -> int:
    """Segments of at most WORD bits, and of 4 where there are as many, with the least expected work."""
    return min(range(-(-bits // WORD), max(1, bits // 4) + 1), key=lambda n: expected_work(n, codes, k, bits))


def _part(code: Column, start: int, stop: int) -> Column:
    return F.shiftrightunsigned(code, start).bitwiseAND(F.lit((1 << (stop - start)) - 1).cast("long"))


def _segments(code: Column, bits: int, n: int, chosen: range) -> Column:
    """An array of (segment, length, value) of a code, for the chosen segments."""
    bounds = _bounds(n, bits)
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("segment"),
                F.lit(bounds[i + 1] - bounds[i]).alias("length"),
                _part(code, bounds[i], bounds[i + 1]).cast("int").alias("value"),
            )
            for i in chosen
        ]
    )


def _probes(waiting: DataFrame, bits: int, n: int, chosen: range, radius: int) -> DataFrame:
    """(query, kth, segment, value): every value at ``radius`` from the query's in the chosen segments.

    Bits are flipped from the lowest up, one after the other, so that no table of
    all masks is held anywhere.
    """
    flipped = waiting.select("query", "kth", F.inline(_segments(F.col("query"), bits, n, chosen)))
    flipped = flipped.where(F.col("length") >= radius).withColumn("next", F.lit(0))
    for left in range(radius, 0, -1):
        bit = F.explode(F.sequence(F.col("next"), F.col("length") - left)).alias("bit")
        value = F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1), F.col("bit"))).alias("value")
        flipped = flipped.select("query", "kth", "segment", "length", "value", bit)
        flipped = flipped.select("query", "kth", "segment", "length", value, (F.col("bit") + 1).alias("next"))
    return flipped.select("query", "kth", "segment", "value")


def _first_of_nearest(bits: int, n: int, radius: int) -> Column:
    """Whether ``segment`` is the first of those in which query and code are nearest, at ``radius``."""
    bounds, differ = _bounds(n, bits), F.col("query").bitwiseXOR(F.col("code"))
    nearest = F.lit(True)
    for i in range(n):
        least = F.when(F.col("segment") > i, radius + 1).otherwise(radius)
        nearest = nearest & (F.bit_count(_part(differ, bounds[i], bounds[i + 1])) >= least)
    return nearest


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest codes of each query, equal distances by the code's smallest id; with their number and the farthest of them."""
    query = Window.partitionBy("query")
    cut = found.withColumn("_n", F.row_number().over(query.orderBy("distance", "first_id"))).where(F.col("_n") <= k)
    return cut.select(
        "query", "code", "first_id", "distance", F.count(F.lit(1)).over(query).alias("n"), F.max("distance").over(query).alias("kth")
    )


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """(query_id, rank, id, distance): the k rows nearest to each query, over all rows.

    ``rows`` and ``queries`` are (id, embedding).
    """
    spark = rows.sparkSession

    def coded(df: DataFrame) -> DataFrame:
        df = df.where(F.col("id").isNotNull() & F.col("embedding").isNotNull())
        return df.select(F.col("id").cast("long").alias("id"), code_of(F.col("embedding"), bits).alias("code"))

    by_code = Window.partitionBy("code").orderBy("id")
    members = materialize(
        coded(rows).withColumn("_n", F.row_number().over(by_code)).where(F.col("_n") <= k).drop("_n"), "code-members"
    )
    codes = materialize(members.groupBy("code").agg(F.min("id").alias("first_id")), "codes")
    asked = materialize(coded(queries), "query-codes")
    # As long as a query has fewer than k codes, any distance is near enough.
    waiting = materialize(asked.select(F.col("code").alias("query"), F.lit(bits).alias("kth")).distinct(), "open-queries")
    n_codes = codes.count()
    n = segment_count(n_codes, k, bits)
    length = -(-bits // n)
    index = materialize(
        codes.select("code", "first_id", F.inline(_segments(F.col("code"), bits, n, range(n)))).drop("length"), "segment-index"
    )
    found = spark.createDataFrame([], "query long, code long, first_id long, distance int")
    done = []
    for radius, chosen in _rounds(n, length):
        distance = F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).cast("int")
        new = (
            # The planner cannot see how many rows the flipped bits make: never a broadcast.
            _probes(waiting, bits, n, chosen, radius)
            .hint("merge")
            .join(index.hint("merge"), ["segment", "value"])
            .where(_first_of_nearest(bits, n, radius) & (distance <= F.col("kth")))
            .select("query", "code", "first_id", distance.alias("distance"))
        )
        nearest = materialize(_nearest(new.unionByName(found), k), "nearest-codes")
        last = radius == length and chosen.stop == n
        full = (F.col("n") >= min(k, n_codes)) & (F.col("kth") <= _covered(n, radius, chosen)) | F.lit(last)
        done.append(nearest.where(full).select(found.columns))
        found = nearest.where(~full).select(found.columns)
        state = nearest.groupBy("query").agg(F.max("n").alias("n"), F.max("kth").alias("kth"))
        known = waiting.select("query").join(state, "query", "left")
        kth = F.when(F.col("n") >= k, F.col("kth")).otherwise(bits).alias("kth")
        waiting = materialize(known.where(F.col("n").isNull() | ~full).select("query", kth), "open-queries")
        if waiting.isEmpty():
            break
    nearest = done[0]
    for d in done[1:]:
        nearest = nearest.unionByName(d)
    nearest = materialize(nearest, "nearest-codes")
    results = nearest.join(members, "code").select("query", "distance", "id")
    ranked = results.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id")))
    ranked = materialize(ranked.where(F.col("rank") <= k), "ranked-codes")
    return (
        asked.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
        .join(ranked, "query")
        .select("query_id", "rank", "id", "distance")
    )
