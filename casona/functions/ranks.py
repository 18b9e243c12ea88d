"""Numbering rows in an order, without a task that has them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.functions.storage import stored


def numbered(rows: DataFrame, keys: list[Column], name: str, groups: int | None = None) -> DataFrame:
    """``rows`` with their place in the order of ``keys`` as ``name``, from 1.

    Rows are sorted over ranges; the counts of the ranges before, of which there
    are as many as shuffle partitions, are added to the place within a range.
    """
    groups = groups or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(rows.repartitionByRange(groups, *keys).withColumn("__part", F.spark_partition_id()))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = parts.withColumn("__at", F.row_number().over(W.partitionBy("__part").orderBy(*keys)))
    return within.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")
