"""Stored tables laid out for what is asked of them: buckets, a space-filling curve, versions, digests of ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casona.functions.labels import UNIT_TYPES
from casona.functions.storage import removed

# Buckets: listings and units that belong together lie together.


def write_bucketed(listings: DataFrame, units: DataFrame, folder: str, buckets: int = 64) -> tuple[str, str]:
    """Both tables in as many buckets by listing, sorted within, as tables of the session's catalog whose names come back.

    Each bucket is one file, so that a join or a grouping by listing needs
    neither a shuffle nor a sort.
    """
    names = []
    for kind, rows in (("listings", listings), ("units", units)):
        names.append(f"{kind}_{uuid.uuid4().hex}")
        dealt = rows.repartition(buckets, "listing_id")
        dealt.write.bucketBy(buckets, "listing_id").sortBy("listing_id").option("path", f"{folder}/{kind}").saveAsTable(names[-1])
    return names[0], names[1]


# A space-filling curve: units of like type and price lie together.

#: Bits of a type's and of a price's place on the curve.
TYPE_BITS, PRICE_BITS = 3, 13


def price_step(price: Column) -> Column:
    """A whole number that ascends with the price, about one for each percent."""
    step = F.floor(F.log1p(F.greatest(price, F.lit(0.0))) * 100)
    return F.coalesce(F.least(step, F.lit((1 << PRICE_BITS) - 1)), F.lit(0)).cast("long")


def on_curve(unit_type: Column, price: Column) -> Column:
    """A place on the curve: bits of type and price in turn, the highest of each first."""
    code = F.lit(len(UNIT_TYPES))
    for n, (name, _) in enumerate(UNIT_TYPES):
        code = F.when(unit_type == name, n).otherwise(code)
    code, step, place = code.cast("long"), price_step(price), F.lit(0).cast("long")
    bits = [(step, b) for b in reversed(range(PRICE_BITS))]
    # the type's bits stand after the first ones of the price, one each
    for n in range(TYPE_BITS):
        bits.insert(2 * n + 1, (code, TYPE_BITS - 1 - n))
    for value, bit in bits:
        place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(value, bit).bitwiseAND(F.lit(1).cast("long")))
    return place


def write_clustered(units: DataFrame, folder: str, parts: int | None = None, group_bytes: int = 1 << 24) -> None:
    """Units along the curve, in row groups of about so many bytes, whose least and greatest values tell what a search may skip."""
    parts = parts or int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = on_curve(F.col("type"), F.col("price"))
    ordered = units.repartitionByRange(parts, place, F.col("listing_id")).sortWithinPartitions(place, F.col("listing_id"))
    ordered.write.option("parquet.block.size", group_bytes).mode("errorifexists").parquet(folder)


# Versions: a table is replaced at once or not at all.


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The versions that were written to their end, oldest first."""
    system, marks = file_system(spark, f"{folder}/current")
    if not system.exists(marks):
        return []
    return sorted(int(s.getPath().getName()) for s in system.listStatus(marks))


def write_version(rows: DataFrame, folder: str, keep: int = 2) -> int:
    """``rows`` as the next version of the table in ``folder``; readers have the one before until it is whole.

    The rows are written beside the others, and a mark with the version's number
    is created last, which one writer can do once.  A write that breaks leaves no
    mark.  Of marked versions the last ``keep`` stay.
    """
    spark = rows.sparkSession
    known = versions(spark, folder)
    number = known[-1] + 1 if known else 0
    path = f"{folder}/rows/{number}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    system, mark = file_system(spark, f"{folder}/current/{number}")
    out = system.create(mark, False)  # an error if another writer was first
    out.write(bytearray(path.rsplit("/", 1)[1].encode()))
    out.close()
    for old in known[: max(0, len(known) + 1 - keep)]:
        name = version_path(spark, folder, old)
        removed(spark, f"{folder}/current/{old}")
        removed(spark, name)
    return number


def version_path(spark: SparkSession, folder: str, number: int) -> str:
    name = spark.read.text(f"{folder}/current/{number}").first()[0]
    return f"{folder}/rows/{name}"


def read_version(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """A version of the table in ``folder``, the last one if none is named."""
    known = versions(spark, folder)
    if not known or number is not None and number not in known:
        raise ValueError(f"no version {'' if number is None else number} in {folder}")
    return spark.read.parquet(version_path(spark, folder, known[-1] if number is None else number))


# Digests: two price lists are compared where they differ.

DIGEST_KEY = ["listing_id", "unit_label"]


def row_hash(rows: DataFrame) -> Column:
    return F.xxhash64(*DIGEST_KEY, "price", F.col("price").isNull())


def write_digested(prices: DataFrame, folder: str, ranges: int = 4_096, groups: int = 64) -> None:
    """A price list ``(listing_id, unit_label, price)`` in ranges of the hashed key, a folder for each group of ranges, with digests of both.

    A digest is made of sums of hashes and the number of rows, so that the order
    of rows doesn't matter.
    """
    spark = prices.sparkSession
    at = F.pmod(F.xxhash64(*DIGEST_KEY), F.lit(ranges)).cast("int")
    rows = prices.select(*DIGEST_KEY, "price").withColumn("range", at).withColumn("group", F.pmod(F.col("range"), F.lit(groups)))
    rows.repartition(groups, "group").write.partitionBy("group").parquet(f"{folder}/rows")
    stored = digested_rows(spark, folder)
    one, two = row_hash(stored), F.xxhash64(row_hash(stored), F.lit("second"))
    leaves = stored.groupBy("group", "range").agg(F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("one"), F.sum(two.cast("decimal(38,0)")).alias("two"))
    leaves.coalesce(1).write.parquet(f"{folder}/digests")  # a row for each range


def digested_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{spark.read.parquet(f'{folder}/rows').drop('group').schema.simpleString()[7:-1].replace(':', ' ')}, group int").parquet(f"{folder}/rows")


def differing_ranges(spark: SparkSession, before: str, after: str) -> DataFrame:
    """``(group, range)`` whose digests differ, from the digests alone."""
    a, b = (spark.read.parquet(f"{f}/digests") for f in (before, after))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("group", "range", "n", "one", "two")]
    only = lambda x, y: x.alias("a").join(y.alias("b"), same, "left_anti").select("group", "range")
    return only(a, b).union(only(b, a)).distinct()


def changed_rows(spark: SparkSession, before: str, after: str) -> tuple[DataFrame, DataFrame]:
    """Of two price lists the rows of ranges that differ: only their groups' folders are read, and what is equal there is skipped by range."""
    ranges = differing_ranges(spark, before, after)
    groups = sorted(r["group"] for r in ranges.select("group").distinct().collect())  # as many as there are groups at most
    pick = lambda f: digested_rows(spark, f).where(F.col("group").isin(groups) if groups else F.lit(False)).join(F.broadcast(ranges.select("range")), "range", "left_semi")
    return pick(before), pick(after)
