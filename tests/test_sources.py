"""File readers and the prediction sink, on files the tests write themselves."""

from __future__ import annotations

import glob
import json
import os

import pytest

from rateforge.schemas import COMPLIMENT_FIELDS
from rateforge.sources import files

COUNTERS = {c: 0 for c in ["useful", "funny", "cool", "fans", *COMPLIMENT_FIELDS]}


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_ratings_drop_every_header_line(spark, workdir):
    p = _write(
        os.path.join(workdir, "train.csv"),
        ["user_id,business_id,stars", "u1,b1,4.0", "user_id,business_id,stars", " u2,b2,3 "],
    )
    rows = sorted(tuple(r) for r in files.read_ratings(spark, p).collect())
    assert rows == [("u1", "b1", 4.0), ("u2", "b2", 3.0)]


def test_pairs_keep_duplicates_and_ignore_extra_columns(spark, workdir):
    p = _write(os.path.join(workdir, "test.csv"), ["user_id,business_id,stars", "u1,b1,5", "u1,b1,2", "u3,b9,1"])
    rows = sorted(tuple(r) for r in files.read_pairs(spark, p).collect())
    assert rows == [("u1", "b1"), ("u1", "b1"), ("u3", "b9")]
    with_rating = sorted(tuple(r) for r in files.read_pairs(spark, p, with_rating=True).collect())
    assert with_rating == [("u1", "b1", 2.0), ("u1", "b1", 5.0), ("u3", "b9", 1.0)]


def test_users_last_row_per_key_wins(spark, workdir):
    recs = [
        {"user_id": "u1", "review_count": 3, "average_stars": 4.5, "yelping_since": "2015-01-01", **COUNTERS},
        {"user_id": "u2", "average_stars": None, **COUNTERS},
        {"user_id": "u1", "review_count": 7, "average_stars": 2.5, "yelping_since": "2016-01-01", **COUNTERS},
    ]
    p = _write(os.path.join(workdir, "user.json"), [json.dumps(r) for r in recs])
    df = files.read_users(spark, p)
    got = {r["user_id"]: (r["review_count"], r["average_stars"]) for r in df.collect()}
    assert got == {"u1": (7, 2.5), "u2": (None, None)}


def test_items_attributes_as_map(spark, workdir):
    recs = [
        {"business_id": "b1", "stars": 4.0, "review_count": 10, "is_open": 1, "latitude": 1.0, "longitude": 2.0,
         "attributes": {"BikeParking": "True", "NoiseLevel": "u'loud'", "Ambience": {"romantic": False}}},
        {"business_id": "b2", "stars": 3.0, "is_open": 0, "attributes": None},
    ]
    p = _write(os.path.join(workdir, "business.json"), [json.dumps(r) for r in recs])
    df = files.read_items(spark, p)
    got = {r["item_id"]: r["attributes"] for r in df.collect()}
    assert got == {"b1": {"BikeParking": "True", "NoiseLevel": "u'loud'"}, "b2": None}  # only what a feature reads
    rows = files.parse_items(files.read_lines(spark, p)).collect()
    every = {r["item_id"]: r["attributes"] for r in rows}
    assert json.loads(every["b1"]["Ambience"]) == {"romantic": False}


def test_visits_tips_photos(spark, workdir):
    pv = _write(os.path.join(workdir, "checkin.json"), [json.dumps({"business_id": "b1", "time": {"Fri-0": 2, "Sat-13": 1}})])
    pt = _write(
        os.path.join(workdir, "tip.json"),
        [json.dumps({"user_id": "u", "business_id": "b1", "likes": k}) for k in (2, 4)],
    )
    pp = _write(os.path.join(workdir, "photo.json"), [json.dumps({"business_id": "b1"})] * 3)
    assert files.read_visits(spark, pv).collect()[0]["time"] == {"Fri-0": 2, "Sat-13": 1}
    tips = files.read_tips(spark, pt).orderBy("_seq").collect()
    assert [r["likes"] for r in tips] == [2, 4]
    assert files.read_photos(spark, pp).count() == 3


def test_prediction_sink(spark, workdir):
    df = spark.createDataFrame([("u1", "b1", 3.5), ("u1", "b1", 6.2)], "user_id string, item_id string, prediction double")
    out = os.path.join(workdir, "pred")
    files.write_predictions(df, out)
    lines = []
    for part in sorted(glob.glob(os.path.join(out, "part-*.csv"))):
        with open(part) as f:
            lines += f.read().splitlines()
    assert lines.count("user_id,business_id,prediction") >= 1
    body = sorted(x for x in lines if not x.startswith("user_id"))
    assert body == ["u1,b1,3.5", "u1,b1,6.2"]


def test_last_wins_across_splits_and_files(spark, workdir):
    """File position orders rows even when one file is read by many tasks."""
    folder = os.path.join(workdir, "users")
    os.makedirs(folder)
    lines_a = [json.dumps({"user_id": f"u{i % 50}", "review_count": i, **COUNTERS}) for i in range(2000)]
    lines_b = [json.dumps({"user_id": f"u{i % 7}", "review_count": 100000 + i, **COUNTERS}) for i in range(30)]
    _write(os.path.join(folder, "part-a.json"), lines_a)
    _write(os.path.join(folder, "part-b.json"), lines_b)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_users(spark, folder)
        assert spark.read.text(folder).rdd.getNumPartitions() > 5  # the files are split
        got = {r["user_id"]: r["review_count"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {}
    for line in lines_a + lines_b:  # part-a.json before part-b.json, lines in order
        rec = json.loads(line)
        want[rec["user_id"]] = rec["review_count"]
    assert got == want


def test_csv_with_windows_line_endings(spark, workdir):
    p = os.path.join(workdir, "crlf.csv")
    with open(p, "w", newline="") as f:
        f.write("user_id,business_id,stars\r\nu1,b1,4.0\r\nu2,b2,1.0\r\n")
    rows = sorted(tuple(r) for r in files.read_ratings(spark, p).collect())
    assert rows == [("u1", "b1", 4.0), ("u2", "b2", 1.0)]


def _item(**fields):
    return {"business_id": "b1", "is_open": 1, **fields}


def test_location_is_the_last_one_with_both_coordinates(spark, workdir):
    recs = [_item(latitude=1.5, longitude=2.5, stars=1.0), _item(latitude=None, longitude=9.0, stars=4.0), _item(longitude=3.0, is_open=None)]
    p = _write(os.path.join(workdir, "business.json"), [json.dumps(r) for r in recs])
    (row,) = files.read_items(spark, p).collect()
    assert (row.latitude, row.longitude, row.stars, row.is_open) == (1.5, 2.5, None, None)


USER = {"user_id": "u", **COUNTERS}
BROKEN = [
    (files.read_users, "not json at all"),
    (files.read_users, ""),
    (files.read_users, "null"),
    (files.read_users, json.dumps({**USER, "review_count": "x"})),
    (files.read_users, json.dumps({**USER, "average_stars": "high"})),
    (files.read_users, json.dumps({k: v for k, v in USER.items() if k != "useful"})),
    (files.read_users, json.dumps({k: v for k, v in USER.items() if k != "compliment_note"})),
    (files.read_users, json.dumps({**USER, "fans": None})),
    (files.read_users, json.dumps({k: v for k, v in USER.items() if k != "user_id"})),
    (files.read_items, json.dumps({"business_id": "b", "stars": 3.0})),
    (files.read_items, json.dumps({"is_open": 1})),
    (files.read_items, json.dumps({"business_id": "b", "is_open": "yes"})),
    (files.read_items, '{"business_id": "b", "is_open": 1'),
    (files.read_visits, json.dumps({"business_id": "b"})),
    (files.read_visits, json.dumps({"business_id": "b", "time": {"Fri-1": "many"}})),
    (files.read_tips, json.dumps({"user_id": "u", "business_id": "b"})),
    (files.read_tips, json.dumps({"user_id": "u", "business_id": "b", "likes": "3"})),
    (files.read_photos, json.dumps({"photo_id": "p"})),
    (files.read_photos, "[broken"),
    (files.read_ratings, "u1,b1"),
    (files.read_ratings, "u1,b1,good"),
    (files.read_ratings, ""),
    (files.read_pairs, "u1"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(("reader", "line"), BROKEN)
def test_broken_input_stops_the_job(spark, workdir, reader, line, ansi):
    good = {
        files.read_users: json.dumps(USER),
        files.read_items: json.dumps({"business_id": "a", "is_open": 0}),
        files.read_visits: json.dumps({"business_id": "a", "time": {}}),
        files.read_tips: json.dumps({"user_id": "u", "business_id": "a", "likes": 1}),
        files.read_photos: json.dumps({"business_id": "a"}),
        files.read_ratings: "u,a,3",
        files.read_pairs: "u,a",
    }[reader]
    p = os.path.join(workdir, "in.txt")
    header = ["h,h,h"] if reader in (files.read_ratings, files.read_pairs) else []
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        _write(p, [*header, good])
        assert reader(spark, p).count() == 1
        _write(p, [*header, good, line, good])
        with pytest.raises(Exception, match="(?i)malformed|no |too few fields|not a rating"):
            reader(spark, p).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_null_where_the_original_allows_it(spark, workdir):
    p = _write(os.path.join(workdir, "u.json"), [json.dumps({**USER, "review_count": None, "yelping_since": None})])
    (row,) = files.read_users(spark, p).collect()
    assert row.review_count is None and row.average_stars is None


@pytest.fixture()
def small_splits(spark):
    """Files are cut into many splits."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_are_numbered_in_file_order(spark, workdir, small_splits):
    """Over files and splits of them, repeated header lines out; equal lines have numbers of their own."""
    folder = os.path.join(workdir, "pairs")
    os.makedirs(folder)
    lines = [f"u{i % 97},b{i % 13}" for i in range(4000)]
    _write(os.path.join(folder, "a.csv"), ["h,h", *lines[:100], "h,h", *lines[100:2500]])
    _write(os.path.join(folder, "b.csv"), ["h,h", *lines[2500:2510]])
    _write(os.path.join(folder, "c.csv"), lines[2510:])
    got = files.read_pairs(spark, folder, with_line=True)
    assert files.read_lines(spark, folder).rdd.getNumPartitions() > 5
    rows = sorted((r.line, f"{r.user_id},{r.item_id}") for r in got.collect())
    assert rows == list(enumerate(lines))


def test_predictions_follow_the_lines(spark, workdir, small_splits):
    """Shuffled rows come out in the order of their lines, and are read back so."""
    from pyspark.sql import functions as F

    rows = spark.range(3000).select(
        F.col("id").alias("line"), (F.col("id") % 7).cast("string").alias("user_id"), F.lit("b").alias("item_id"),
        (F.col("id") * 0.5).alias("prediction"),
    )
    out = os.path.join(workdir, "pred")
    files.write_predictions(rows.orderBy(F.rand(3)), out)
    assert len(glob.glob(os.path.join(out, "part-*.csv"))) > 1
    got = files.read_predictions(spark, out).collect()
    assert sorted((r.line, r.user_id, r.prediction) for r in got) == [(i, str(i % 7), i * 0.5) for i in range(3000)]


def test_first_line_is_that_of_the_first_file(spark, workdir):
    """An empty first file is passed over; a larger later file does not come first."""
    folder = os.path.join(workdir, "ratings")
    os.makedirs(folder)
    open(os.path.join(folder, "part-0"), "w").close()
    _write(os.path.join(folder, "part-1"), ["u,b,s", "x,y,1"])
    _write(os.path.join(folder, "part-2"), [f"u{i},b{i},2" for i in range(500)])
    assert files.first_line(spark, folder) == "u,b,s"
    assert files.read_ratings(spark, folder).count() == 501
    empty = os.path.join(workdir, "none")
    os.makedirs(empty)
    open(os.path.join(empty, "part-0"), "w").close()
    assert files.first_line(spark, empty) is None and files.read_ratings(spark, empty).count() == 0
    assert files.read_pairs(spark, empty, with_line=True).count() == 0


def test_only_the_asked_fields_are_parsed(spark, workdir):
    """The ids always; a field that is not asked for is not checked either."""
    p = _write(os.path.join(workdir, "u.json"), [json.dumps({**USER, "review_count": 4}), json.dumps({"user_id": "v", "review_count": 5})])
    got = files.read_users(spark, p, ["review_count"])
    assert got.columns == ["user_id", "review_count"]
    assert sorted(tuple(r) for r in got.collect()) == [("u", 4), ("v", 5)]
    assert sorted(r.user_id for r in files.read_users(spark, p, []).collect()) == ["u", "v"]
    q = _write(os.path.join(workdir, "i.json"), [json.dumps(_item(latitude=1.0, longitude=2.0, stars=1.0)), json.dumps(_item(latitude=5.0, stars=3.0))])
    place = files.read_items(spark, q, ["latitude", "longitude"])
    assert [tuple(r) for r in place.collect()] == [("b1", 1.0, 2.0)]
    assert [tuple(r) for r in files.read_items(spark, q, ["stars"]).collect()] == [("b1", 3.0)]
    assert [tuple(r) for r in files.read_items(spark, q, []).collect()] == [("b1",)]


def test_staged_files_hold_older_copies(spark):
    """The readers have something to decide: several files, several rows of a key in different files."""
    from rateforge.sources import tables as T

    sf = "/root/testdata/sf0.001"
    for source, key in (("users", "user_id"), ("items", "business_id"), ("visits", "business_id")):
        parts = sorted(glob.glob(os.path.join(T.staged(spark, sf, source).removeprefix("file:"), "part-*.txt")))
        seen = {}
        for n, part in enumerate(parts):
            with open(part) as f:
                for line in f:
                    seen.setdefault(json.loads(line)[key], set()).add(n)
        assert len(parts) >= T.MIN_FILES and sum(len(x) > 1 for x in seen.values()) > len(seen) / 10
    headers = 0
    for part in glob.glob(os.path.join(T.staged(spark, sf, "ratings").removeprefix("file:"), "part-*.csv")):
        with open(part) as f:
            headers += f.read().splitlines().count("user_id,business_id,stars")
    assert headers >= T.MIN_FILES
    assert T.staged(spark, sf, "users") == T.staged(spark, sf, "users")
