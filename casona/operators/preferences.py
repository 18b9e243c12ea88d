"""Favorites and currency choices of users, from logs and from saved texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.sources.layout import write_version


def favorites_from_toggles(toggles: DataFrame) -> DataFrame:
    """``(user_id, listing_id)`` that were toggled an odd number of times; an event that repeats counts once."""
    once = toggles.dropDuplicates(["event_id"])
    return once.groupBy("user_id", "listing_id").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select("user_id", "listing_id")


def saved_texts(toggles: DataFrame) -> DataFrame:
    """``(user_id, body)``: each user's favorites as a JSON array, by the time of the last toggle."""
    once = toggles.dropDuplicates(["event_id"])
    kept = once.groupBy("user_id", "listing_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("ts", "event_id")).alias("at")).where("n % 2 = 1")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("at", "listing_id"))), lambda x: x["listing_id"])
    return kept.groupBy("user_id").agg(F.to_json(ids).alias("body"))


def save_favorites(toggles: DataFrame, path: str) -> None:
    """Writes the texts of all users as the next version of the table in ``path``; what was there stays until it is whole."""
    write_version(saved_texts(toggles), path)


def load_favorites(saved: DataFrame) -> DataFrame:
    """``(user_id, listing_id)`` of saved texts; a missing or malformed one is empty, an element that is no id is skipped."""
    parsed = F.from_json("body", "array<string>")
    ids = F.array_distinct(F.transform(F.coalesce(parsed, F.array().cast("array<string>")), lambda x: x.try_cast("bigint")))
    return saved.select("user_id", F.explode(ids).alias("listing_id")).where("listing_id is not null")


def current_currency(choices: DataFrame) -> DataFrame:
    """``(user_id, currency)``: the last choice; all but MXN is USD."""
    last = choices.groupBy("user_id").agg(F.max_by("currency", F.struct("ts", "event_id")).alias("last"))
    return last.select("user_id", F.when(F.col("last") == "MXN", "MXN").otherwise("USD").alias("currency"))


def currency_changes(choices: DataFrame, bucket: str = "day") -> DataFrame:
    """Choices that change what holds, USD at first; a choice that repeats it is not saved.

    A user's choices are compared within time buckets, and the last one of each
    bucket is carried on, so that a user with very many is spread over tasks.
    """
    chosen = F.when(F.col("currency") == "MXN", "MXN").otherwise("USD")
    x = choices.withColumn("currency", chosen).withColumn("bucket", F.date_trunc(bucket, F.col("ts").cast("timestamp")))
    last = x.groupBy("user_id", "bucket").agg(F.max_by("currency", F.struct("ts", "event_id")).alias("last"))
    carried = last.select("user_id", "bucket", F.lag("last").over(W.partitionBy("user_id").orderBy("bucket")).alias("carried"))
    within = x.withColumn("near", F.lag("currency").over(W.partitionBy("user_id", "bucket").orderBy("ts", "event_id")))
    before = F.coalesce("near", "carried", F.lit("USD"))
    return within.join(carried, ["user_id", "bucket"]).where(F.col("currency") != before).select(*choices.columns)


#: Listings with ids in a row whose bits one number holds.
BITS = 64


def bits_of(rows: DataFrame, *keys: str) -> DataFrame:
    """``(bucket, *keys, bits)``: the listings of each of ``keys`` as bitmaps, one for each range of ``BITS`` in which there are any."""
    at = rows.where("listing_id is not null").select(*keys, F.expr(f"shiftright(cast(listing_id as long), {BITS.bit_length() - 1})").alias("bucket"), F.expr(f"shiftleft(1L, cast(pmod(cast(listing_id as long), {BITS}) as int))").alias("bit"))
    return at.groupBy("bucket", *keys).agg(F.bit_or("bit").alias("bits"))


def favorite_bitmaps(favorites: DataFrame) -> DataFrame:
    """``(bucket, user_id, bits)``: each user's favorites as bitmaps, no more than there are favorites."""
    return bits_of(favorites, "user_id")


def favorites_found(found: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(user_id, n_found)`` for every user with favorites: how many of the listings found they have.

    The listings found become a bitmap for each range too, and a user's meet
    these in one join; what is held of a user and a range is one number.
    """
    own = bits_of(found).withColumnRenamed("bits", "found")
    common = F.coalesce(F.bit_count(F.col("bits").bitwiseAND(F.col("found"))), F.lit(0))
    return bitmaps.join(own, "bucket", "left").groupBy("user_id").agg(F.sum(common).cast("long").alias("n_found"))
