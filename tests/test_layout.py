"""Stored layouts: buckets without a shuffle, skipped row groups, versions that replace at once, digests, bitmaps."""

import glob
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from casona.operators import preferences as prefs
from casona.operators import prep, search
from casona.operators.search import ListingQuery
from casona.sources import layout

UNITS = "listing_id long, unit_seq int, type string, bedrooms int, bathrooms double, price double, size double, available int"


@pytest.fixture(scope="module")
def units(spark):
    rng = random.Random(2)
    rows = [(k % 700, k, rng.choice(["Studio", "1BR", "2BR", "3BR", "Land", None]), rng.randrange(4), 1.0, rng.choice([None, float(rng.randrange(1, 500_000))]), 9.0, 1) for k in range(20_000)]
    return spark.createDataFrame(rows, UNITS).cache()


@pytest.fixture(scope="module")
def listings(spark):
    return spark.range(800).select(F.col("id").alias("listing_id"), F.col("id").alias("position"), F.lit("Casa").alias("project"), F.lit("Lima").alias("city"), F.lit("Villa").alias("property_type")).cache()


def key(df):
    return sorted(tuple(r) for r in df.collect())


def test_buckets_need_no_shuffle(spark, listings, units, tmp_path):
    names = layout.write_bucketed(listings, units, str(tmp_path / "b"), buckets=8)
    q = ListingQuery(unit_type="2BR", max_price=90_000)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = search.matched_summary(*(spark.table(n) for n in names), q)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        ordered = search.search(*(spark.table(n) for n in names), q)._jdf.queryExecution().executedPlan().toString()
        assert ordered.count("Exchange") == 1 and "rangepartitioning" in ordered
        assert key(found) == key(search.matched_summary(listings, units, q))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        for n in names:
            spark.sql(f"drop table {n}")


def row_groups(folder, unit_type, low, high):
    """How many row groups there are, and how many their statistics don't rule out."""
    every = hit = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        names = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            kind, price = (meta.row_group(g).column(names[c]).statistics for c in ("type", "price"))
            every += 1
            hit += bool(kind.has_min_max and price.has_min_max and kind.min <= unit_type <= kind.max and price.min <= high and price.max >= low)
    return every, hit


def test_the_curve_lets_row_groups_be_skipped(spark, units, tmp_path):
    units.repartition(32).write.parquet(str(tmp_path / "plain"))
    layout.write_clustered(units, str(tmp_path / "curve"), parts=32)
    before, after = (row_groups(tmp_path / n, "2BR", 50_000, 60_000) for n in ("plain", "curve"))
    assert before[1] == before[0] and after[1] <= after[0] / 4
    fits = search.unit_predicate(ListingQuery(unit_type="2BR", min_price=50_000, max_price=60_000))
    assert key(spark.read.parquet(str(tmp_path / "curve")).where(fits)) == key(units.where(fits))


def test_a_broken_write_leaves_the_old_version(spark, tmp_path):
    folder = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        layout.read_version(spark, folder)
    assert layout.write_version(spark.range(3), folder) == 0
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        layout.write_version(broken, folder)
    assert layout.read_version(spark, folder).count() == 3 and layout.versions(spark, folder) == [0]
    for n in (4, 5):
        layout.write_version(spark.range(n), folder)
    assert layout.versions(spark, folder) == [1, 2] and layout.read_version(spark, folder).count() == 5 and layout.read_version(spark, folder, 1).count() == 4


def test_saved_favorites_have_versions(spark, tmp_path):
    toggles = "event_id long, ts long, user_id long, listing_id long"
    prefs.save_favorites(spark.createDataFrame([(1, 1, 7, 10)], toggles), str(tmp_path / "f"))
    prefs.save_favorites(spark.createDataFrame([(1, 1, 7, 11)], toggles), str(tmp_path / "f"))
    assert key(prefs.load_favorites(layout.read_version(spark, str(tmp_path / "f")))) == [(7, 11)]


def test_digests_find_all_changes_and_read_few_rows(spark, tmp_path):
    rows = [(k % 300, f"u{k}", None if k % 50 == 0 else float(k)) for k in range(6000)]
    schema = "listing_id long, unit_label string, price double"
    before = spark.createDataFrame([*rows, (None, None, 1.0), (1, None, None)], schema)
    changed = [*rows[:100], (rows[100][0], "u100", 5.5), (rows[101][0], "u101", None), *rows[103:], (9, "new", 1.0), (None, None, 2.0), (1, None, None)]
    after = spark.createDataFrame(changed, schema).repartition(5)
    folders = [str(tmp_path / n) for n in ("a", "b")]
    for rows_of, folder in zip((before, after), folders, strict=True):
        layout.write_digested(rows_of, folder, ranges=512, groups=32)
    a, b = layout.changed_rows(spark, *folders)
    pick = ["listing_id", "unit_label", "change", "old_price", "new_price"]
    got = sorted(map(repr, prep.snapshot_diff(a, b).select(pick).collect()))
    assert got == sorted(map(repr, prep.snapshot_diff(before, after).select(pick).collect())) and len(got) == 5
    scans = re.findall(r"PartitionFilters: \[([^\]]*)", a._jdf.queryExecution().optimizedPlan().toString() + a._jdf.queryExecution().executedPlan().toString())
    assert a.count() < 6000 / 20 and any("group" in s for s in scans)
    same = layout.changed_rows(spark, folders[0], folders[0])
    assert same[0].count() == same[1].count() == 0


def test_bitmaps_equal_the_join(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(20), rng.choice([rng.randrange(100), rng.randrange(10**6), -5])) for _ in range(500)] + [(50, None)]
    favorites = spark.createDataFrame(pairs + pairs[:9], "user_id long, listing_id long")
    found = spark.createDataFrame([(k,) for k in [*range(0, 100, 3), -5, None, *range(0, 10**6, 7)]], "listing_id long")
    own = {r for (r,) in found.collect()} - {None}
    users = {}
    for user, listing in set(pairs):
        if listing is not None:
            users[user] = users.get(user, 0) + (listing in own)
    assert dict(key(prefs.favorites_found(found, prefs.favorite_bitmaps(favorites)))) == users


def test_a_users_bits_of_a_range_are_one_number(spark):
    """Users whose favorites lie in one range take a number each, not a bitmap of 4 KB."""
    favorites = spark.createDataFrame([(1, 0), (1, 63), (1, 64), (2, -1), (2, 5_000_000_000), (3, None)], "user_id long, listing_id long")
    bitmaps = prefs.favorite_bitmaps(favorites)
    assert dict(bitmaps.dtypes)["bits"] == "bigint" and bitmaps.count() == 4
    found = spark.createDataFrame([(63,), (64,), (64,), (-1,), (5_000_000_001,)], "listing_id long")
    assert sorted(map(tuple, prefs.favorites_found(found, bitmaps).collect())) == [(1, 2), (2, 1)]
