"""Roll-ups of units by listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casona.functions.labels import UNIT_TYPES, listed


def type_dim(spark: SparkSession) -> DataFrame:
    """Five rows: unit types in their order."""
    return spark.createDataFrame([(t, k, label) for k, (t, label) in enumerate(UNIT_TYPES)], "type string, ord int, label string")


def unit_summary(units: DataFrame, *more: Column) -> DataFrame:
    """A row for each listing that has units, with ``more`` aggregates at the end."""
    return units.groupBy("listing_id").agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.min("bedrooms").alias("min_bedrooms"),
        F.max("bedrooms").alias("max_bedrooms"),
        F.min("size").alias("min_size"),
        F.sum("available").cast("long").alias("available"),
        *more,
    )


def listing_summary(listings: DataFrame, units: DataFrame) -> DataFrame:
    """A row for each listing; without units the total is 0 and the rest null."""
    joined = listings.join(unit_summary(units), "listing_id", "left")
    return joined.withColumn("available", F.coalesce("available", F.lit(0).cast("long")))


def unit_type_counts(units: DataFrame) -> DataFrame:
    """Available units by listing and type; a type of which none is available counts 0."""
    return units.groupBy("listing_id", "type").agg(F.sum("available").cast("long").alias("available"))


def distinct_cities(listings: DataFrame) -> DataFrame:
    return listings.select("city").distinct().orderBy("city")


def unit_tabs(units: DataFrame) -> DataFrame:
    """``(listing_id, ord, label, available)``: a tab for all units, then one for each known type that is present."""
    levels = units.groupingSets([["listing_id"], ["listing_id", "type"]], "listing_id", "type").agg(F.sum("available").cast("long").alias("available"), F.grouping("type").alias("is_all"))
    dim = F.broadcast(type_dim(units.sparkSession))
    every = levels.where("is_all = 1").select("listing_id", F.lit(-1).alias("ord"), F.lit("All").alias("label"), "available")
    typed = levels.where("is_all = 0").join(dim, "type").select("listing_id", "ord", "label", "available")
    return every.union(typed)


def bed_summary(units: DataFrame) -> DataFrame:
    """``(listing_id, bed_summary)``: labels of the known types that are present, as ``a, b & c``."""
    present = units.select("listing_id", "type").distinct().join(F.broadcast(type_dim(units.sparkSession)), "type")
    labels = F.transform(F.sort_array(F.collect_list(F.struct("ord", "label"))), lambda x: x["label"])
    return present.groupBy("listing_id").agg(listed(labels).alias("bed_summary"))
