"""The set of input frames one run works on."""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import INPUT_FILES
from . import files


@dataclass
class Inputs:
    """Canonical input frames.

    ratings  user_id, item_id, rating
    pairs    user_id, item_id [, rating] [, line]   rows to score (rating only for
             evaluation; line: the input line, whose order the output keeps)
    users    user_id, review_count, average_stars, yelping_since, useful, funny,
             cool, fans, compliment_* (one row per user)
    items    item_id, review_count, stars, is_open, latitude, longitude,
             attributes (one row per item)
    visits   item_id, time (slot -> count map; one row per item)
    tips     user_id, item_id, likes, _seq (orderable position; many rows per pair)
    photos   item_id (one row per photo)
    as_of    reference date of the tenure feature
    """

    ratings: DataFrame
    pairs: DataFrame
    users: DataFrame
    items: DataFrame
    visits: DataFrame
    tips: DataFrame
    photos: DataFrame
    as_of: _dt.date


def from_files(
    spark: SparkSession,
    folder: str,
    pairs_path: str,
    as_of: _dt.date,
    pairs_with_rating: bool = False,
) -> Inputs:
    """Inputs from the original file layout of a data folder plus a pairs CSV."""
    p = lambda role: os.path.join(folder, INPUT_FILES[role])
    return Inputs(
        ratings=files.read_ratings(spark, p("ratings")),
        pairs=files.read_pairs(spark, pairs_path, with_rating=pairs_with_rating, with_line=True),
        users=files.read_users(spark, p("users")),
        items=files.read_items(spark, p("items")),
        visits=files.read_visits(spark, p("visits")),
        tips=files.read_tips(spark, p("tips")),
        photos=files.read_photos(spark, p("photos")),
        as_of=as_of,
    )
