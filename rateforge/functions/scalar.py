"""Column expressions for the scalar features (all JVM-side, no Python UDF)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ERROR_BUCKETS, FLAG_FALSE, FLAG_TRUE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(*cols: str | Column) -> Column:
    """Sum of several count columns; null if any term is null."""
    return reduce(add, [_col(c) for c in cols])


def interactions(useful="useful", funny="funny", cool="cool", fans="fans") -> Column:
    """useful + funny + cool + fans."""
    return total(useful, funny, cool, fans)


def sin_cos_radians(c: str | Column) -> tuple[Column, Column]:
    """(sin, cos) of an angle given in degrees; null stays null."""
    rad = F.radians(_col(c))
    return F.sin(rad), F.cos(rad)


def attribute(attributes: str | Column, key: str) -> Column:
    """Value of one key of a string map; null for a missing key or a null map."""
    return _col(attributes).getItem(key)


def tri_state(value: Column) -> Column:
    """Exactly "True" -> 1, exactly "False" -> 0, anything else -> null."""
    return F.when(value == F.lit(FLAG_TRUE), F.lit(1)).when(value == F.lit(FLAG_FALSE), F.lit(0))


# What the original's number parser accepts of digits, points and exponents.
DECIMAL = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def price_tier(value: Column) -> Column:
    """A decimal string as double; anything else -> null ("2d" and "NaN" included)."""
    return F.when(value.rlike(DECIMAL), F.trim(value).try_cast("double"))


def ordinal(value: Column, codes: dict[str, int]) -> Column:
    """Exact-match lookup of a category in a fixed code table; unknown -> null."""
    lookup = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
    return F.when(value.isNotNull(), lookup[value])


def days_active(joined: str | Column, as_of: str | _dt.date) -> Column:
    """Whole days from a year-month-day date string to ``as_of``.

    Null or empty input gives null; any other text that is not such a date
    (one with a time part, for instance) stops the job.
    """
    as_of_date = F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)))
    joined_col = F.nullif(_col(joined), F.lit(""))
    # 'yyyy-M-d' reads one- or two-digit months and days, like the original's
    # '%Y-%m-%d' parser ("2015-3-4" is a date there too).
    parsed = F.try_to_date(joined_col, "yyyy-M-d")
    broken = F.raise_error(F.concat(F.lit("not a date: "), joined_col))
    return F.datediff(as_of_date, F.when(joined_col.isNotNull() & parsed.isNull(), broken).otherwise(parsed))


def nonzero_slot(key: Column) -> Column:
    """F8: True when the trailing digits of a time-slot key hold a non-zero number.

    Exact for digit runs of any length (no integer overflow). A key without
    trailing digits stops the job.
    """
    broken = F.raise_error(F.concat(F.lit("a time slot without a number: "), key))
    return F.when(key.rlike(r"[0-9]$"), key.rlike(r"[1-9][0-9]*$")).otherwise(broken)


def visits(time_map: str | Column) -> Column:
    """Sum of the counts of a slot -> count map, skipping slots numbered 0.

    An empty map sums to 0; a null map stays null.
    """
    kept = F.map_filter(_col(time_map), lambda k, v: nonzero_slot(k))
    return F.aggregate(F.map_values(kept), F.lit(0).cast("long"), lambda acc, v: acc + F.coalesce(v.cast("long"), F.lit(0)))


def abs_error(label: str | Column, prediction: str | Column) -> Column:
    return F.abs(_col(label) - _col(prediction))


def squared_error(label: str | Column, prediction: str | Column) -> Column:
    return F.pow(_col(label) - _col(prediction), F.lit(2))


def error_bucket(err: Column) -> Column:
    """Lower bound of the absolute-error bucket: [0,1) [1,2) [2,3) [3,4) [4,inf)."""
    top = ERROR_BUCKETS[-1][0]
    return F.least(F.floor(err), F.lit(top)).cast("int")


def error_bucket_label(bucket: Column) -> Column:
    """Label of a bucket lower bound (fixed labels of the histogram)."""
    lookup = F.create_map(*[x for b, label in ERROR_BUCKETS for x in (F.lit(b), F.lit(label))])
    return lookup[bucket]
