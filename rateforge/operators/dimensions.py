"""User and item dimensions: one row per known user / item with all its features.

Everything a pair needs from one side is folded into that side's dimension
(profile fields, derived features, averages of tip likes, visits, photos), so
the fact table meets each side in exactly one equi-join on a unique key.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.scalar import (
    attribute,
    days_active,
    interactions,
    ordinal,
    price_tier,
    sin_cos_radians,
    total,
    tri_state,
)
from . import signals

USER_KNOWN = "_user_known"
ITEM_KNOWN = "_item_known"


def user_engagement(users: DataFrame) -> DataFrame:
    """interactions and compliments per user."""
    return users.select(
        "user_id",
        interactions().alias("interactions"),
        total(*S.COMPLIMENT_FIELDS).alias("compliments"),
    )


def user_tenure(users: DataFrame, as_of: _dt.date) -> DataFrame:
    """whole days from joining to ``as_of``."""
    return users.select("user_id", days_active("yelping_since", as_of).alias("days_active"))


def user_dimension(users: DataFrame, tips: DataFrame, as_of: _dt.date) -> DataFrame:
    """Known users with profile averages, tenure, engagement and average tip likes."""
    base = users.select(
        "user_id",
        F.lit(True).alias(USER_KNOWN),
        F.col("average_stars").alias("u_avg"),
        F.coalesce(F.col("review_count"), F.lit(0)).cast("long").alias("u_count"),
        days_active("yelping_since", as_of).alias("u_days"),
        interactions().alias("interactions"),
        total(*S.COMPLIMENT_FIELDS).alias("compliments"),
    )
    likes = signals.tip_likes_by_user(tips).withColumnRenamed("avg_likes", "u_tip_avg")
    return base.join(likes, "user_id", "left")


def item_flags(items: DataFrame) -> DataFrame:
    """the 17 tri-state flags."""
    return items.select("item_id", *[tri_state(attribute("attributes", k)).alias(c) for c, k in S.FLAG_ATTRIBUTES])


def item_price_tier(items: DataFrame) -> DataFrame:
    """price tier as a number."""
    return items.select("item_id", price_tier(attribute("attributes", S.PRICE_ATTRIBUTE)).alias("price_range"))


def item_ordinals(items: DataFrame) -> DataFrame:
    """ordinal codes of the five categorical attributes."""
    return items.select(
        "item_id", *[ordinal(attribute("attributes", k), codes).alias(c) for c, k, codes in S.ORDINAL_ATTRIBUTES]
    )


def location_columns() -> list:
    """F3 with P4: sin / cos of latitude and longitude, all null unless both are present."""
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    lat_sin, lat_cos = sin_cos_radians("latitude")
    lon_sin, lon_cos = sin_cos_radians("longitude")
    return [
        F.when(both, lat_sin).alias("lat_sin"),
        F.when(both, lat_cos).alias("lat_cos"),
        F.when(both, lon_sin).alias("lon_sin"),
        F.when(both, lon_cos).alias("lon_cos"),
    ]


def item_location(items: DataFrame) -> DataFrame:
    """P4 + F3: items that have both coordinates, with their sin / cos."""
    return items.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "item_id", *location_columns()
    )


def item_dimension(items: DataFrame, visits: DataFrame, photos: DataFrame, tips: DataFrame) -> DataFrame:
    """Known items with profile fields, attribute features, location, visits,
    photos and average tip likes. Visits and photos of a known item default to 0."""
    noise_col, noise_key, noise_codes = S.ORDINAL_ATTRIBUTES[0]
    base = items.select(
        "item_id",
        F.lit(True).alias(ITEM_KNOWN),
        F.col("stars").alias("i_avg"),
        F.coalesce(F.col("review_count"), F.lit(0)).cast("long").alias("i_count"),
        F.col("is_open"),
        *location_columns(),
        *[tri_state(attribute("attributes", k)).alias(c) for c, k in S.FLAG_ATTRIBUTES],
        price_tier(attribute("attributes", S.PRICE_ATTRIBUTE)).alias("price_range"),
        ordinal(attribute("attributes", noise_key), noise_codes).alias(noise_col),
    )
    v = signals.item_visits(visits).withColumnRenamed("visits", "i_visits")
    p = signals.item_photo_count(photos).withColumnRenamed("photo_count", "i_photos")
    likes = signals.tip_likes_by_item(tips).withColumnRenamed("avg_likes", "i_tip_avg")
    return (
        base.join(v, "item_id", "left")
        .join(p, "item_id", "left")
        .join(likes, "item_id", "left")
        .withColumn("i_visits", F.coalesce(F.col("i_visits"), F.lit(0)).cast("long"))
        .withColumn("i_photos", F.coalesce(F.col("i_photos"), F.lit(0)).cast("long"))
    )
