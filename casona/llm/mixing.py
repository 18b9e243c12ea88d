"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

A source is a flow: its documents wait in shuffled order, once for each pass.
An entry's virtual finish time is the source's words up to and with it, divided
by the source's target.  All entries are sorted by finish time over ranges, and
the mix is cut where the words served reach the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.llm.shared import checkpointed, free_names, stored, with_row_numbers

#: What the sources weigh, by rank of their name, over and over.
WEIGHTS = (3, 1, 2)
#: Words to take for each word there is, and times that a source may be repeated.
SHARE, PASSES = 1.5, 2
#: Rows up to which the table of sources is broadcast; beyond, it is joined by a shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    """Words of a text, split by ASCII white space; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_sum(rows: DataFrame, keys: list[str], run: str, order: list[Column | str], value: str) -> DataFrame:
    """``rows`` with ``sum_to``: the sum of ``value`` up to each row, by ``keys``, then ``run``, then ``order``.

    The rows of a run are summed in one task; the sums of the runs, far fewer,
    give the offset of each.
    """
    sums = rows.groupBy(*keys, run).agg(F.sum(value).alias("__sum"))
    before = W.partitionBy(*keys).orderBy(run).rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*keys, run, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    within = W.partitionBy(*keys, run).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.join(offsets, [*keys, run]).withColumn("sum_to", F.col("__before") + F.sum(value).over(within)).drop("__before")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target, total, rank)`` of rows ``(source, size)``.

    The targets share ``SHARE`` of all words by weight.  None is above ``PASSES``
    times its source's size; what that leaves is shared again by weight.  With
    the sources in order of cap over weight, those up to some place are capped
    and the level of the others follows from what is left there.  Both orders
    are sorted over ranges, so there may be any number of sources.
    """
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = [F.asc_nulls_last("source")]
    named = checkpointed(src.repartitionByRange(parts, *by_name).select("*", F.spark_partition_id().alias("run"), F.lit(0).alias("all"), F.lit(1).alias("one")))
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = running_sum(named, ["all"], "run", by_name, "one").select("source", "source_size", "all", F.col("sum_to").alias("rank"))
    ranked = ranked.withColumn("weight", F.get(cycle, ((F.col("rank") - 1) % len(WEIGHTS)).cast("int"))).withColumn("cap", F.col("source_size") * PASSES)
    ranked = ranked.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    by_ratio = checkpointed(ranked.repartitionByRange(parts, "ratio", "rank").withColumn("run", F.spark_partition_id()))
    x = running_sum(by_ratio, ["all"], "run", ["ratio", "rank"], "cap").withColumnRenamed("sum_to", "caps")
    x = running_sum(x, ["all"], "run", ["ratio", "rank"], "weight").withColumnRenamed("sum_to", "weights")
    totals = by_ratio.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("heavy"))  # one row
    level = (F.lit(SHARE) * F.col("total") - (F.col("caps") - F.col("cap"))) / (F.col("heavy") - (F.col("weights") - F.col("weight")))
    x = checkpointed(x.crossJoin(F.broadcast(totals)).withColumn("level", level))
    free = x.agg(F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).alias("free"))  # one row
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("free"), F.col("cap").cast("double")))
    return x.crossJoin(F.broadcast(free)).select("source", "source_size", target.alias("target"), "total", "rank")


def mix_entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """``(rid, doc_id, size, source_size, target, pass, finish, sum_to, served)``: each row of ``docs`` once for each pass.

    ``served`` says whether the entry is in the mix, ``sum_to`` how many words
    the mix has with it if so.  A shuffled order is that of the md5 of the id,
    then of the id, size and text, so reruns agree; rows that repeat are entries
    of their own.  ``rid`` is ``row_col``, a unique long, or a number of its own.
    A null text has no words, a null source is a source, ranked last, and a null
    id is shuffled like an empty one.  Both orders are sorted over ranges, which
    also part the rows of one id.
    """
    base = docs.select(
        (F.monotonically_increasing_id() if row_col is None else F.col(row_col)).alias("rid"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("turn"),
        F.xxhash64(text_col).alias("tie"),
    )
    base = stored(base)
    sources = checkpointed(source_targets(base))
    named = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shuffled = ["turn", "doc_id", "size", "tie", "rid"]
    x = base.join(named, base["source"].eqNullSafe(sources["source"])).drop("source")
    x = stored(x.repartitionByRange(parts, "rank", *shuffled).withColumn("run", F.spark_partition_id()))
    x = running_sum(x, ["rank"], "run", shuffled, "size").withColumnRenamed("sum_to", "upto").drop("run")
    entries = x.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1)))).withColumn(
        "finish", F.when(F.col("target") > 0, (F.col("upto") + F.col("pass") * F.col("source_size")).cast("double") / F.col("target")).otherwise(F.lit(0.0))
    )
    order = ["finish", "rank", "pass", *shuffled]
    ranged = stored(entries.repartitionByRange(parts, *order).withColumn("run", F.spark_partition_id()))
    summed = running_sum(ranged.withColumn("all", F.lit(0)), ["all"], "run", order, "size")
    return summed.withColumn("served", F.col("sum_to") <= F.floor(F.lit(SHARE) * F.col("total"))).select("rid", "doc_id", "size", "source_size", "target", "pass", "finish", "sum_to", "served")


def allotments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, a row for each row of ``docs``: the words of it that the mix takes.

    Documents are taken whole, up to ``PASSES`` times.  An empty table gives no
    rows; if no text has words, nothing is taken.
    """
    entries = mix_entries(docs, id_col, text_col, source_col)
    return (
        entries.groupBy("rid")
        .agg(*[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum(F.when(F.col("served"), F.col("size")).otherwise(0)).alias("taken"))
        .drop("rid")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, with their columns, a row as often as it is taken.

    Each row is taken by itself, whatever its id.  Rows without words add no
    word and stay once.
    """
    row, often, copy = free_names(docs, "__row", "__times", "__copy")
    rows = with_row_numbers(docs, row)
    entries = mix_entries(rows, id_col, text_col, source_col, row)
    times = F.when(F.first("size") == 0, 1).otherwise(F.sum(F.col("served").cast("int"))).cast("int")
    taken = entries.groupBy(F.col("rid").alias(row)).agg(times.alias(often)).where(F.col(often) > 0)
    return rows.join(taken, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(often)))).select(*docs.columns)


#: The same rows in SQL; the shuffled order, the finish times and the cut are those above.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk
  FROM d GROUP BY source),
w AS (SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
         (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
          - CAST(coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w),
t AS (
  SELECT source, source_size, rnk, total,
         least(CAST(cap AS DOUBLE), coalesce(weight * max(CASE WHEN CAST(cap AS DOUBLE) / weight > level THEN level END) OVER (), CAST(cap AS DOUBLE))) AS target
  FROM l),
u AS (
  SELECT d.doc_id, d.size, d.turn, t.source_size, t.rnk, t.total, t.target,
         CAST(sum(d.size) OVER (PARTITION BY t.rnk ORDER BY d.turn, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT u.*, p.pass, CASE WHEN target > 0 THEN CAST(upto + p.pass * source_size AS DOUBLE) / target ELSE 0.0 END AS finish
  FROM u CROSS JOIN (SELECT 0 AS pass UNION ALL SELECT 1) p),
c AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rnk, pass, turn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto_all FROM e)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN upto_all <= floor(1.5 * total) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM c GROUP BY doc_id, size, source_size, target
"""
