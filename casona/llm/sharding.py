"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns the arcs that end at its virtual nodes; a row belongs to the arc
that its key's hash falls into.  A shard takes rows up to its bound, its own
first; what overflows goes on clockwise to the next shards with room.  With
bounds that add up to all rows, counts are at most one apart.  How many rows of
an arc go where follows from the counts of the arcs alone, of which there are as
many as virtual nodes, whatever the number of rows.

Rows are put in ring order by ranges of position and row, so that neither an arc
nor a key with very many rows is in one task, and only keys are moved for that.
"""

from __future__ import annotations

import bisect
from itertools import accumulate

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.llm.shared import free_names, stored, with_row_numbers

SEED = 42
VIRTUAL_NODES = 512


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[list[int], list[int]]:
    """Positions of the virtual nodes, ascending, as signed longs, and the shard of each."""
    nodes = sorted((xxhash.xxh64_intdigest(f"shard {s} node {k}", SEED) - 2**63, s) for s in range(shards) for k in range(virtual_nodes))
    return [p for p, _ in nodes], [s for _, s in nodes]


def dealt(loads: list[int], owner: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """``(arc, first, last, shard)``: which rows of each arc, by rank from 1, go to which shard.

    Every shard's bound is its even part of all rows.  An arc's rows go to its
    owner while the owner has room; then, once all owners are served, the rest
    go clockwise from the arc's end to the first shards that have room.
    """
    total = sum(loads)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out, over = [], []
    for arc, load in enumerate(loads):
        kept = min(load, room[owner[arc]])
        room[owner[arc]] -= kept
        if kept:
            out.append((arc, 1, kept, owner[arc]))
        if load > kept:
            over.append((arc, kept, load - kept))
    for arc, done, left in over:
        step = arc
        while left:
            step = (step + 1) % len(owner)
            take = min(left, room[owner[step]])
            if take:
                room[owner[step]] -= take
                out.append((arc, done + 1, done + take, owner[step]))
                done, left = done + take, left - take
    return out


def with_arc(rows: DataFrame, at: list[int]) -> DataFrame:
    """``rows`` with ``__arc``: how many of the positions ``at`` lie before ``__at``.

    Positions are looked up by their first bits, for which there is a row for
    each of about as many cells as there are positions.
    """
    bits = max(1, len(at).bit_length())
    cells = range(-(1 << bits - 1), 1 << bits - 1)
    starts = [bisect.bisect_left(at, c << 64 - bits) for c in cells] + [len(at)]
    table = [(c, starts[k], at[starts[k] : starts[k + 1]]) for k, c in enumerate(cells)]
    lookup = rows.sparkSession.createDataFrame(table, "__cell long, __before int, __nodes array<long>")
    found = rows.withColumn("__cell", F.shiftright("__at", 64 - bits)).join(F.broadcast(lookup), "__cell")
    return found.withColumn("__arc", F.col("__before") + F.size(F.filter("__nodes", lambda p: p < F.col("__at")))).drop("__cell", "__before", "__nodes")


def placed(keys: DataFrame, shards: int, id_col: str, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``keys`` with ``shard`` and ``slot``; all its columns are moved, so they should be few and short."""
    spark: SparkSession = keys.sparkSession
    at, owner = ring(shards, virtual_nodes)
    owner = [*owner, owner[0]]  # beyond the last node the ring begins again
    columns = keys.columns
    marked = stored(keys.select("*", F.xxhash64(F.col(id_col)).alias("__at"), F.xxhash64(*columns).alias("__tie"), F.monotonically_increasing_id().alias("__nth")))
    order = ["__at", "__tie", "__nth"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(with_arc(marked.repartitionByRange(parts, *order).withColumn("__run", F.spark_partition_id()), at))
    counts = ranged.groupBy("__run", "__arc").count()
    loads, sizes = [0] * len(owner), {}
    for row in counts.orderBy("__run").collect():  # a row for each virtual node and range at most
        loads[row["__arc"]] += row["count"]
        sizes[row["__run"]] = sizes.get(row["__run"], 0) + row["count"]
    first_of = [0, *accumulate(loads)]
    parts_of, filled = [], [0] * shards
    for arc, first, last, shard in sorted(dealt(loads, owner, shards)):
        parts_of.append((arc, first_of[arc] + first, first_of[arc] + last, shard, filled[shard] - first_of[arc] - first))
        filled[shard] += last - first + 1
    starts = spark.createDataFrame(list(zip(sizes, accumulate([0, *sizes.values()]), strict=False)), "__run int, __start long")
    goes = spark.createDataFrame(parts_of, "__arc int, __first long, __last long, shard int, __base long")
    place = F.col("__start") + F.row_number().over(W.partitionBy("__run").orderBy(*order))
    ranked = ranged.join(F.broadcast(starts), "__run").withColumn("__place", place)
    found = ranked.join(F.broadcast(goes), "__arc").where("__place between __first and __last")
    return found.select(*columns, "shard", (F.col("__place") + F.col("__base")).alias("slot"))


def sharded(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 in each shard, without gaps) after its own columns.

    Rows with a null id lie where the hash of null does; rows with one id lie
    together and are told apart by their order only; any that repeat get slots
    of their own.  An empty table gives no rows.  Columns of ``docs`` with the
    names ``shard`` and ``slot`` are replaced.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    [row] = free_names(docs, "__row")
    rows = with_row_numbers(docs, row)
    places = placed(rows.select(F.col(id_col).alias("__id"), F.col(row).alias("__number")), shards, "__id", virtual_nodes)
    places = places.select(F.col("__number").alias(row), "shard", "slot")
    return rows.select(*columns, row).join(places, row).select(*columns, "shard", "slot")


def digest(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``: counts of the shards are at most one apart.

    ``size`` is a text's UTF-8 bytes and 1; a null text counts as an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = placed(rows, shards, "doc_id")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
