"""Explicit input schemas and the fixed vocabularies of the feature set.

Every source is read with one of the schemas below; nothing is inferred.
The lists further down are fixed values: attribute keys, category codes and
the feature order must equal those of the original job for the model input to
mean the same thing. They are stated once here and used everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Input schemas (file sources)
# ---------------------------------------------------------------------------

# File names of an input folder (role -> file).
INPUT_FILES = {
    "ratings": "yelp_train.csv",
    "users": "user.json",
    "items": "business.json",
    "visits": "checkin.json",
    "tips": "tip.json",
    "photos": "photo.json",
}

# The ratings and pair CSVs are positional: user, item[, rating]; see
# sources.files. The JSON sources:

# The compliment counters of a user, names of the input file.
COMPLIMENT_FIELDS = [
    "compliment_hot",
    "compliment_more",
    "compliment_profile",
    "compliment_cute",
    "compliment_list",
    "compliment_note",
    "compliment_plain",
    "compliment_cool",
    "compliment_funny",
    "compliment_writer",
    "compliment_photos",
]

# The interaction counters of a user, names of the input file.
INTERACTION_FIELDS = ["useful", "funny", "cool", "fans"]

USERS_JSON = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("average_stars", T.DoubleType()),
        T.StructField("yelping_since", T.StringType()),
    ]
    + [T.StructField(c, T.LongType()) for c in INTERACTION_FIELDS]
    + [T.StructField(c, T.LongType()) for c in COMPLIMENT_FIELDS]
)

ITEMS_JSON = T.StructType(
    [
        T.StructField("business_id", T.StringType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("is_open", T.IntegerType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

VISITS_JSON = T.StructType(
    [
        T.StructField("business_id", T.StringType()),
        T.StructField("time", T.MapType(T.StringType(), T.IntegerType())),
    ]
)

TIPS_JSON = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("likes", T.LongType()),
    ]
)

PHOTOS_JSON = T.StructType([T.StructField("business_id", T.StringType())])

# ---------------------------------------------------------------------------
# Attribute flags, in feature order (feature column, attribute key)
# ---------------------------------------------------------------------------

FLAG_ATTRIBUTES = [
    ("credit_card", "BusinessAcceptsCreditCards"),
    ("bike_parking", "BikeParking"),
    ("kids_friendly", "GoodForKids"),
    ("takeout", "RestaurantsTakeOut"),
    ("caters", "Caters"),
    ("table_service", "RestaurantsTableService"),
    ("by_appointment_only", "ByAppointmentOnly"),
    ("has_tv", "HasTV"),
    ("reservations", "RestaurantsReservations"),
    ("delivery", "RestaurantsDelivery"),
    ("wheelchair_accessible", "WheelchairAccessible"),
    ("good_for_groups", "RestaurantsGoodForGroups"),
    ("outdoor_seating", "OutdoorSeating"),
    ("dogs_allowed", "DogsAllowed"),
    ("happy_hour", "HappyHour"),
    ("good_for_dancing", "GoodForDancing"),
    ("drive_thru", "DriveThru"),
]
FLAG_COLUMNS = [c for c, _ in FLAG_ATTRIBUTES]

# The only strings a flag attribute maps from.
FLAG_TRUE = "True"
FLAG_FALSE = "False"

# Fixed value: attribute holding the price tier as a numeric string.
PRICE_ATTRIBUTE = "RestaurantsPriceRange2"

# Ordinal attributes (feature column, attribute key, value -> code).
ORDINAL_ATTRIBUTES = [
    ("noise_level", "NoiseLevel", {"quiet": 0, "average": 1, "loud": 2, "very_loud": 3}),
    ("wifi", "WiFi", {"no": 0, "free": 1, "paid": 2}),
    ("attire", "RestaurantsAttire", {"casual": 0, "dressy": 1, "formal": 2}),
    ("alcohol", "Alcohol", {"none": 0, "full_bar": 1, "beer_and_wine": 2}),
    ("smoking", "Smoking", {"no": 0, "outdoor": 1, "yes": 2}),
]
ORDINAL_COLUMNS = [c for c, _, _ in ORDINAL_ATTRIBUTES]

# Every attribute that a feature reads.
ATTRIBUTE_KEYS = [k for _, k in FLAG_ATTRIBUTES] + [PRICE_ATTRIBUTE] + [k for _, k, _ in ORDINAL_ATTRIBUTES]

# Fixed value: default average for the unknown side of a half-known pair.
COLD_START_AVERAGE = 3.0

# The 34 model features, in model order.
FEATURES = (
    [
        "user_avg",
        "user_count",
        "item_avg",
        "item_count",
        "item_visits",
        "tip_likes",
        "photo_count",
        "credit_card",
        "price_range",
    ]
    + FLAG_COLUMNS[1:]
    + [
        "interactions",
        "compliments",
        "noise_level",
        "is_open",
        "lat_sin",
        "lat_cos",
        "lon_sin",
        "lon_cos",
        "days_active",
    ]
)

# Absolute-error buckets of the evaluation histogram, lower bound
# and label; the last bucket is open-ended.
ERROR_BUCKETS = [
    (0, ">=0 and <1"),
    (1, ">=1 and <2"),
    (2, ">=2 and <3"),
    (3, ">=3 and <4"),
    (4, ">=4"),
]

# Cold-start branches, in the order the rule tests them.
BRANCHES = ["both", "user_only", "item_only", "neither"]
