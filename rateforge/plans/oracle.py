"""Reference SQL (DuckDB dialect) for every SQL-expressible query of the catalogue.

Each statement recomputes its result from the base tables with the
definitions of ``sources.tables`` written out directly (arithmetic CASE
expressions instead of attribute maps), so it checks the Spark jobs rather
than repeating them. Column names and types match the catalogue.
"""

from __future__ import annotations

from .. import schemas as S
from ..sources import tables as T

AS_OF = T.AS_OF.isoformat()

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

RATINGS = """
ratings AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(floor((l.l_quantity - 1) / 10) + 1 AS DOUBLE) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

SPLIT = "CASE WHEN (user_id * 31 + item_id) % 10 < 8 THEN 'train' ELSE 'valid' END"

_EVENT_COUNTS = ",\n         ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS {name}" for name, t in T.EVENT_COUNTERS
)
_COMPLIMENTS = " + ".join(f"(c.c_custkey * {j}) % 7" for j in range(1, len(S.COMPLIMENT_FIELDS) + 1))

USERS = f"""
users AS (
  SELECT c.c_custkey AS user_id, o.review_count, o.average_stars,
         CAST(o.first_order AS DATE) AS joined_on,
         CAST(coalesce(e.useful, 0) + coalesce(e.funny, 0) + coalesce(e.cool, 0) + coalesce(e.fans, 0) AS BIGINT) AS interactions,
         CAST({_COMPLIMENTS} AS BIGINT) AS compliments,
         CAST(date_diff('day', CAST(o.first_order AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_active
  FROM customer c
  JOIN (SELECT o_custkey, count(*) AS review_count,
               avg(CAST(o_orderkey % 5 + 1 AS DOUBLE)) AS average_stars,
               min(o_orderdate) AS first_order
        FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT user_id,
         {_EVENT_COUNTS}
        FROM events GROUP BY user_id) e ON e.user_id = c.c_custkey
  WHERE c.c_mktsegment <> '{T.EXCLUDED_SEGMENT}'
)"""

_FLAGS = ",\n         ".join(
    f"CASE (p.p_partkey * {j} + p.p_size) % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS {col}"
    for j, (col, _) in enumerate(S.FLAG_ATTRIBUTES, 1)
)
_NOISE_CODES = S.ORDINAL_ATTRIBUTES[0][2]
_NOISE = "CASE p.p_type " + " ".join(
    f"WHEN '{t}' THEN {_NOISE_CODES[w]}" for t, w in T.NOISE_BY_TYPE.items() if w in _NOISE_CODES
) + " END"
_ORDINALS = ",\n         ".join(
    f"CASE WHEN (p.p_partkey + {m} * p.p_size) % 4 < 3 THEN CAST((p.p_partkey + {m} * p.p_size) % 4 AS INTEGER) END AS {col}"
    for m, (col, _, _) in enumerate(S.ORDINAL_ATTRIBUTES[1:], 1)
)

ITEMS = f"""
items AS (
  SELECT p.p_partkey AS item_id,
         CAST(coalesce(s.n, 0) AS BIGINT) AS review_count, s.stars,
         CAST(p.p_partkey % 4 <> 0 AS INTEGER) AS is_open,
         CASE WHEN p.p_partkey % 10 <> 0 THEN p.p_retailprice - 945 END AS latitude,
         CAST(p.p_size * 7 - 180 AS DOUBLE) AS longitude,
         {_FLAGS},
         CASE WHEN p.p_size % 7 BETWEEN 1 AND 4 THEN CAST(p.p_size % 7 AS DOUBLE) END AS price_range,
         {_NOISE} AS noise_level,
         {_ORDINALS}
  FROM part p
  LEFT JOIN (SELECT l_partkey AS item_id, count(*) AS n,
                    avg(CAST(floor((l_quantity - 1) / 10) + 1 AS DOUBLE)) AS stars
             FROM lineitem GROUP BY l_partkey) s
    ON s.item_id = p.p_partkey
  WHERE p.p_size <= {T.MAX_KNOWN_SIZE}
)"""


def _attr_long() -> str:
    parts = []
    for j, (_, key) in enumerate(S.FLAG_ATTRIBUTES, 1):
        parts.append(
            f"SELECT p_partkey AS item_id, '{key}' AS attribute, "
            f"CASE (p_partkey * {j} + p_size) % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END AS value FROM part WHERE p_size <= {T.MAX_KNOWN_SIZE}"
        )
    noise_words = " ".join(f"WHEN '{t}' THEN '{w}'" for t, w in T.NOISE_BY_TYPE.items())
    parts.append(
        f"SELECT p_partkey, '{S.ORDINAL_ATTRIBUTES[0][1]}', CASE p_type {noise_words} END FROM part WHERE p_size <= {T.MAX_KNOWN_SIZE}"
    )
    parts.append(
        f"SELECT p_partkey, '{S.PRICE_ATTRIBUTE}', CASE WHEN p_size % 7 = 0 THEN 'None' "
        f"WHEN p_size % 7 <= 4 THEN CAST(p_size % 7 AS VARCHAR) END FROM part WHERE p_size <= {T.MAX_KNOWN_SIZE}"
    )
    for m, (_, key, codes) in enumerate(S.ORDINAL_ATTRIBUTES[1:], 1):
        words = sorted(codes, key=codes.get)
        whens = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words))
        parts.append(
            f"SELECT p_partkey, '{key}', CASE (p_partkey + {m} * p_size) % 4 {whens} END FROM part WHERE p_size <= {T.MAX_KNOWN_SIZE}"
        )
    body = "\n  UNION ALL ".join(parts)
    return f"""
attr_long AS (
  SELECT * FROM (
  {body}
  ) WHERE value IS NOT NULL
)"""


TIPS = f"""
tips AS (
  SELECT user_id, {K} AS item_id, CAST(floor(value) AS BIGINT) AS likes, ts, event_id
  FROM events WHERE event_type = 'click'
)"""

LAST_TIP = """
last_tip AS (
  SELECT user_id, item_id, likes FROM (
    SELECT user_id, item_id, likes,
           row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM tips) WHERE rn = 1
)"""

VISITS = f"""
visits AS (
  SELECT {K} AS item_id, CAST(count(*) FILTER (WHERE hour(ts) <> 0) AS BIGINT) AS visits
  FROM events GROUP BY 1
)"""

PHOTOS = f"""
photos AS (
  SELECT {K} AS item_id, count(*) AS photo_count FROM events WHERE event_type = 'view' GROUP BY 1
)"""

_DEFAULT = f"CAST({S.COLD_START_AVERAGE} AS DOUBLE)"

_FEATURE_EXPR = {
    "user_avg": f"CASE WHEN uk THEN u_avg WHEN ik THEN {_DEFAULT} END",
    "user_count": "CASE WHEN uk THEN u_count END",
    "item_avg": f"CASE WHEN ik THEN i_avg WHEN uk THEN {_DEFAULT} END",
    "item_count": "CASE WHEN ik THEN i_count END",
    "item_visits": "CASE WHEN ik THEN coalesce(v_visits, 0) END",
    "tip_likes": "CASE WHEN uk AND ik THEN CAST(pair_likes AS DOUBLE) WHEN uk THEN u_tip WHEN ik THEN i_tip END",
    "photo_count": "CASE WHEN ik THEN coalesce(ph_count, 0) END",
    "days_active": "CASE WHEN uk THEN u_days END",
}


def _features_cte(pairs_sql: str, keep: list[str]) -> str:
    """CTE ``fm``: unrounded features of the rows of ``pairs_sql``."""
    extra = "".join(f", x.{c}" for c in keep)
    cols = []
    for name in S.FEATURES:
        cols.append(f"{_FEATURE_EXPR.get(name, name)} AS {name}")
    feature_list = ",\n    ".join(cols)
    keep_list = "".join(f", {c}" for c in keep)
    return f"""
{RATINGS},
{USERS},
{ITEMS},
{TIPS},
{LAST_TIP},
{VISITS},
{PHOTOS},
ulikes AS (SELECT user_id, avg(likes) AS a FROM tips GROUP BY user_id),
ilikes AS (SELECT item_id, avg(likes) AS a FROM tips GROUP BY item_id),
pairs AS ({pairs_sql}),
joined AS (
  SELECT x.user_id, x.item_id{extra},
         u.user_id IS NOT NULL AS uk, i.item_id IS NOT NULL AS ik,
         u.average_stars AS u_avg, u.review_count AS u_count, u.days_active AS u_days,
         u.interactions, u.compliments,
         i.stars AS i_avg, i.review_count AS i_count, i.is_open,
         CASE WHEN i.latitude IS NOT NULL AND i.longitude IS NOT NULL THEN sin(radians(i.latitude)) END AS lat_sin,
         CASE WHEN i.latitude IS NOT NULL AND i.longitude IS NOT NULL THEN cos(radians(i.latitude)) END AS lat_cos,
         CASE WHEN i.latitude IS NOT NULL AND i.longitude IS NOT NULL THEN sin(radians(i.longitude)) END AS lon_sin,
         CASE WHEN i.latitude IS NOT NULL AND i.longitude IS NOT NULL THEN cos(radians(i.longitude)) END AS lon_cos,
         {", ".join("i." + c for c in S.FLAG_COLUMNS)},
         i.price_range, i.noise_level,
         v.visits AS v_visits, ph.photo_count AS ph_count,
         lt.likes AS pair_likes, ul.a AS u_tip, il.a AS i_tip
  FROM pairs x
  LEFT JOIN users u ON u.user_id = x.user_id
  LEFT JOIN items i ON i.item_id = x.item_id
  LEFT JOIN visits v ON v.item_id = x.item_id
  LEFT JOIN photos ph ON ph.item_id = x.item_id
  LEFT JOIN last_tip lt ON lt.user_id = x.user_id AND lt.item_id = x.item_id
  LEFT JOIN ulikes ul ON ul.user_id = x.user_id
  LEFT JOIN ilikes il ON il.item_id = x.item_id
),
fm AS (
  SELECT user_id, item_id,
    {feature_list}{keep_list}
  FROM joined
)"""


def _rounded_select(columns: list[str]) -> str:
    out = []
    for c in columns:
        if c in ("lat_sin", "lat_cos", "lon_sin", "lon_cos"):
            out.append(f"round({c}, 9) AS {c}")
        elif c in ("user_avg", "item_avg", "tip_likes", "price_range"):
            out.append(f"round({c}, 6) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


ALL_RATINGS = "SELECT user_id, item_id, rating FROM ratings"
VIEW_PAIRS = f"SELECT user_id, {K} AS item_id FROM events WHERE event_type = 'view'"
WITH_SPLIT = f"SELECT user_id, item_id, rating, {SPLIT} AS split FROM ratings"
BASELINE = f"coalesce((user_avg + item_avg) / 2, user_avg, item_avg, {_DEFAULT})"


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings"] = f"WITH {RATINGS} SELECT user_id, item_id, rating FROM ratings"
    q["scoring_pairs"] = VIEW_PAIRS
    q["split_ratings"] = f"WITH {RATINGS} {WITH_SPLIT}"
    q["user_profile"] = (
        f"WITH {USERS} SELECT user_id, review_count, round(average_stars, 6) AS average_stars, joined_on FROM users"
    )
    q["user_engagement"] = f"WITH {USERS} SELECT user_id, interactions, compliments FROM users"
    q["user_tenure"] = f"WITH {USERS} SELECT user_id, days_active FROM users"
    q["item_profile"] = (
        f"WITH {ITEMS} SELECT item_id, review_count, round(stars, 6) AS stars, is_open FROM items"
    )
    q["item_location"] = (
        f"WITH {ITEMS} SELECT item_id, "
        "round(sin(radians(latitude)), 9) AS lat_sin, round(cos(radians(latitude)), 9) AS lat_cos, "
        "round(sin(radians(longitude)), 9) AS lon_sin, round(cos(radians(longitude)), 9) AS lon_cos "
        "FROM items WHERE latitude IS NOT NULL AND longitude IS NOT NULL"
    )
    q["item_flags"] = f"WITH {ITEMS} SELECT item_id, {', '.join(S.FLAG_COLUMNS)} FROM items"
    q["item_price_tier"] = f"WITH {ITEMS} SELECT item_id, price_range FROM items"
    q["item_ordinals"] = f"WITH {ITEMS} SELECT item_id, {', '.join(S.ORDINAL_COLUMNS)} FROM items"
    q["item_visits"] = f"WITH {VISITS} SELECT item_id, visits FROM visits"
    q["item_photo_count"] = f"WITH {PHOTOS} SELECT item_id, photo_count FROM photos"
    q["tip_likes_by_user"] = f"WITH {TIPS} SELECT user_id, round(avg(likes), 6) AS avg_likes FROM tips GROUP BY user_id"
    q["tip_likes_by_item"] = f"WITH {TIPS} SELECT item_id, round(avg(likes), 6) AS avg_likes FROM tips GROUP BY item_id"
    q["latest_tip_per_pair"] = f"WITH {TIPS}, {LAST_TIP} SELECT user_id, item_id, likes FROM last_tip"
    q["pair_tip_likes"] = (
        f"WITH {RATINGS}, {TIPS}, {LAST_TIP} SELECT r.user_id, r.item_id, lt.likes AS tip_likes "
        "FROM ratings r LEFT JOIN last_tip lt ON lt.user_id = r.user_id AND lt.item_id = r.item_id"
    )
    b = S.BRANCHES
    q["cold_start_mix"] = (
        f"WITH {RATINGS}, {USERS}, {ITEMS} "
        f"SELECT CASE WHEN u.user_id IS NOT NULL AND i.item_id IS NOT NULL THEN '{b[0]}' "
        f"WHEN u.user_id IS NOT NULL THEN '{b[1]}' WHEN i.item_id IS NOT NULL THEN '{b[2]}' ELSE '{b[3]}' END AS branch, "
        "count(*) AS n FROM ratings r LEFT JOIN users u ON u.user_id = r.user_id "
        "LEFT JOIN items i ON i.item_id = r.item_id GROUP BY 1"
    )
    fm_cols = ["user_id", "item_id", *S.FEATURES]
    q["feature_matrix"] = f"WITH {_features_cte(ALL_RATINGS, ['rating'])} SELECT {_rounded_select(fm_cols + ['rating'])} FROM fm"
    q["scoring_matrix"] = f"WITH {_features_cte(VIEW_PAIRS, [])} SELECT {_rounded_select(fm_cols)} FROM fm"
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in S.FEATURES)
    q["missing_profile"] = (
        f"WITH {_features_cte(ALL_RATINGS, ['rating'])}, counts AS (SELECT {nulls} FROM fm) "
        "SELECT feature, n_missing FROM (UNPIVOT counts ON COLUMNS(*) INTO NAME feature VALUE n_missing)"
    )
    q["attribute_frequency"] = f"WITH {_attr_long()} SELECT attribute, count(*) AS n FROM attr_long GROUP BY attribute"
    q["attribute_values"] = f"WITH {_attr_long()} SELECT DISTINCT attribute, value FROM attr_long"
    q["rmse"] = (
        f"WITH {_features_cte(ALL_RATINGS, ['rating'])} "
        f"SELECT round(sqrt(avg(power(rating - {BASELINE}, 2))), 6) AS rmse, count(*) AS n FROM fm"
    )
    buckets = ", ".join(f"({lo}, '{label}')" for lo, label in S.ERROR_BUCKETS)
    top = S.ERROR_BUCKETS[-1][0]
    q["error_histogram"] = (
        f"WITH {_features_cte(ALL_RATINGS, ['rating'])}, "
        f"c AS (SELECT CAST(least(floor(abs(rating - {BASELINE})), {top}) AS INTEGER) AS b, count(*) AS n FROM fm GROUP BY 1) "
        f"SELECT k.bucket_floor, k.bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS n "
        f"FROM (VALUES {buckets}) k(bucket_floor, bucket) LEFT JOIN c ON c.b = k.bucket_floor"
    )
    q["rmse_by_split"] = (
        f"WITH {_features_cte(WITH_SPLIT, ['rating', 'split'])} "
        f"SELECT split, round(sqrt(avg(power(rating - {BASELINE}, 2))), 6) AS rmse, count(*) AS n FROM fm GROUP BY split"
    )
    q["predict_coverage"] = f"SELECT user_id, {K} AS item_id, true AS has_prediction FROM events WHERE event_type = 'view'"
    q["fitted_split_rows"] = (
        f"WITH {RATINGS}, s AS ({WITH_SPLIT}) SELECT split, count(*) AS n, count(rating) AS n_scored FROM s GROUP BY split"
    )
    q["prediction_file"] = (
        f"SELECT row_number() OVER (ORDER BY event_id) - 1 AS line, user_id, {K} AS item_id FROM events WHERE event_type = 'view'"
    )
    return q


ORACLE_SQL: dict[str, str] = _sql()
