"""Catalogues: the nested form that is exchanged, and the flat tables that queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.functions import ranks
from casona.functions.storage import stored

CATALOGUE = """
  id bigint, project string, developer string, city string, lat double, lng double, deliveryDate string, propertyType string,
  description string, amenities array<string>, pointsOfInterest array<struct<label: string, name: string, distanceKm: double>>,
  photos array<string>, units array<struct<unitLabel: string, type: string, bedrooms: int, bathrooms: double, price: double, size: double, available: int>>
"""


def read_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A catalogue as JSON lines, or as one array (``multiline``), with ``position``: its order, from 1.

    The order is that of the file names, of the blocks in a file, and of the rows
    in a block, which are read by one task from first to last.
    """
    rows = spark.read.schema(CATALOGUE).option("multiLine", multiline).json(path)
    at = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__row")]
    keys = ["__file", "__block", "__row"]
    return ranks.numbered(stored(rows.select("*", *at)), [F.col(k) for k in keys], "position").drop(*keys)


def listings_of(catalogue: DataFrame) -> DataFrame:
    """Flat listings of a nested catalogue; it must have ``position``, as the order can't be told from anything else."""
    if "position" not in catalogue.columns:
        raise ValueError("a catalogue needs a column position")
    position = F.col("position")
    return catalogue.select(
        F.col("id").alias("listing_id"), position.cast("long").alias("position"), "project", "developer", "city", "lat", "lng", F.col("deliveryDate").alias("delivery_date"), F.col("propertyType").alias("property_type"), "description", "amenities", "photos"
    )


def units_of(catalogue: DataFrame) -> DataFrame:
    u = catalogue.select(F.col("id").alias("listing_id"), F.posexplode("units").alias("unit_seq", "u"))
    return u.select("listing_id", "unit_seq", F.col("u.unitLabel").alias("unit_label"), "u.type", "u.bedrooms", "u.bathrooms", "u.price", "u.size", "u.available")


def poi_of(catalogue: DataFrame) -> DataFrame:
    p = catalogue.select(F.col("id").alias("listing_id"), F.posexplode("pointsOfInterest").alias("seq", "p"))
    return p.select("listing_id", "seq", "p.label", "p.name", F.col("p.distanceKm").alias("distance_km"))


def write_flat(catalogue: DataFrame, folder: str, buckets: int | None = None) -> None:
    """Listings, units and points of interest as Parquet, each once."""
    for name, rows in (("listings", listings_of(catalogue)), ("units", units_of(catalogue)), ("listing_poi", poi_of(catalogue))):
        (rows if buckets is None else rows.repartition(buckets, "listing_id")).write.mode("overwrite").parquet(f"{folder}/{name}")


def nested(listings: DataFrame, units: DataFrame) -> DataFrame:
    """Listings with their units as an array, in order; an empty one where there are none."""
    unit = F.struct("unit_seq", "unit_label", "type", "bedrooms", "bathrooms", "price", "size", "available")
    grouped = units.groupBy("listing_id").agg(F.sort_array(F.collect_list(unit)).alias("units"))
    return listings.join(grouped, "listing_id", "left").withColumn("units", F.coalesce("units", F.array().cast(grouped.schema["units"].dataType)))


# The star-schema tables seen as a catalogue: an order is a listing, its line items are units.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n, r = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    joined = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    key = F.col("o_orderkey")
    photos = F.when(key % 5 > 0, F.transform(F.sequence(F.lit(1), (key % 5).cast("int")), lambda k: F.concat(F.lit("photo-"), key.cast("string"), F.lit("-"), k.cast("string"))))
    return joined.select(
        key.alias("listing_id"),
        key.alias("position"),
        F.concat("c_name", F.lit(" "), "c_mktsegment").alias("project"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("developer"),
        F.concat("n_name", F.lit(", "), "r_name").alias("city"),
        (18 + (key * 37 % 3500).cast("double") / 1000).alias("lat"),
        (-90 + (key * 53 % 3500).cast("double") / 1000).alias("lng"),
        F.when(F.col("o_orderstatus") == "F", "Ready to move in").otherwise(F.date_format("o_orderdate", "MMM yyyy")).alias("delivery_date"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Land").when(F.col("c_mktsegment") == "HOUSEHOLD", "Villa").otherwise("Condo").alias("property_type"),
        F.concat(F.lit("Offer "), key.cast("string"), F.lit(" of "), "c_name").alias("description"),
        photos.alias("photos"),
    )


def raw_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with what a price list says of them: ``status`` and ``currency``."""
    line = F.col("l_linenumber")
    unit_type = F.get(F.array(*[F.lit(t) for t in ("Studio", "1BR", "2BR", "3BR", "Land", "2BR", "4BR")]), line - 1)
    bedrooms = F.get(F.array(*[F.lit(n) for n in (0, 1, 2, 3, 0, 2, 4)]), line - 1)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("listing_id"),
        line.alias("line"),
        F.col("l_partkey").alias("part"),
        F.when(line == 7, "").otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string"))).alias("unit_label"),
        unit_type.alias("type"),
        bedrooms.alias("bedrooms"),
        F.when(line == 5, 0.0).otherwise(0.5 * bedrooms + 1).alias("bathrooms"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("available"),
        F.when(F.col("l_linestatus") == "O", "AVAILABLE").otherwise("SOLD").alias("status"),
        F.when(F.col("l_returnflag") == "R", "MXN").otherwise("USD").alias("currency"),
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = W.partitionBy("listing_id").orderBy("line", "part", "price")
    return raw_units(spark, sf_dir).withColumn("unit_seq", F.row_number().over(order)).drop("status", "currency")


def unit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of units, some again: all as they are, dearer ones of some listings, second units gone and some of these back."""
    key, second = F.col("listing_id") % 3 == 0, F.col("unit_seq") == 2
    as_is = F.struct(F.lit(1).alias("version"), F.lit(False).alias("removed"), F.col("price"), F.col("available"))
    dearer = F.struct(F.lit(2).alias("version"), F.lit(False).alias("removed"), (F.col("price") + 1000).alias("price"), F.lit(2).alias("available"))
    gone = F.struct(F.lit(3).alias("version"), F.lit(True).alias("removed"), F.col("price"), F.col("available"))
    back = F.struct(F.lit(4).alias("version"), F.lit(False).alias("removed"), (F.col("price") + 7).alias("price"), F.col("available"))
    each = F.array(as_is, F.when(F.col("listing_id") % 7 == 0, as_is), F.when(key & ~second, dearer), F.when(second, gone), F.when(second & (F.col("listing_id") % 5 == 0), back))
    rows = units(spark, sf_dir).select("listing_id", "unit_seq", "type", "bedrooms", "bathrooms", "size", F.explode(each).alias("c")).where("c is not null")
    return rows.select("listing_id", "unit_seq", F.col("c.version").cast("long").alias("version"), "c.removed", "type", "bedrooms", "bathrooms", "c.price", "size", "c.available")


def amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(listing_id, amenities)``: the brands of a listing's parts, each once, in order."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    brands = line.join(part, line["l_partkey"] == part["p_partkey"]).select(F.col("l_orderkey").alias("listing_id"), "p_brand").distinct()
    return brands.groupBy("listing_id").agg(F.sort_array(F.collect_list("p_brand")).alias("amenities"))


def landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("r_name").alias("category"), F.col("n_name").alias("name"), (18 + (key * 7 % 35).cast("double") / 10).alias("lat"), (-90 + (key * 11 % 35).cast("double") / 10).alias("lng")
    )


def numbered(events: DataFrame) -> DataFrame:
    """Events with their number ``k``."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def event_rows(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return numbered(table(spark, sf_dir, "events").where(F.col("event_type") == kind))


def toggles_of(clicks: DataFrame) -> DataFrame:
    return clicks.select("event_id", "ts", "user_id", F.col("k").cast("long").alias("listing_id"))


def toggles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toggles_of(event_rows(spark, sf_dir, "click"))


def choices_of(views: DataFrame) -> DataFrame:
    currency = F.when(F.col("k") % 3 == 0, "MXN").when(F.col("k") % 3 == 1, "USD").otherwise("EUR")
    return views.select("event_id", "ts", "user_id", currency.alias("currency"))


def currency_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return choices_of(event_rows(spark, sf_dir, "view"))


def payloads_of(purchases: DataFrame) -> DataFrame:
    """Landed answers of a rate service, as text."""
    rate = F.format_string("%.2f", 16 + F.col("k").cast("double") / 25)
    result = F.when(F.col("k") % 5 == 0, "error").otherwise("success")
    body = F.concat(F.lit('{"result":"'), result, F.lit('","rates":{"MXN":'), rate, F.lit('},"time_last_update_utc":"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit('"}'))
    return purchases.select("event_id", "ts", (F.col("k") % 7 != 0).alias("http_ok"), F.when(F.col("k") % 11 == 0, F.substring(body, 1, 20)).otherwise(body).alias("body"))


def fx_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads_of(event_rows(spark, sf_dir, "purchase"))


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of listing pages; some without an id, some with one that is no number."""
    key = F.col("page_id")
    query = F.when(key % 7 == 0, "").when(key % 7 == 1, F.concat(F.lit("?id=abc"), key.cast("string"))).when(key % 7 == 2, "?id=").when(key % 7 == 3, F.concat(F.lit("?x=1&id="), key.cast("string"), F.lit("&id=1"))).otherwise(F.concat(F.lit("?id="), (key * 1000).cast("string")))
    return table(spark, sf_dir, "pages").select(key.alias("request_id"), F.concat(F.lit("https://example.org/detail.html"), query).alias("url"))
