"""What several operators share: materialising, reading tables, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casona.functions.storage import checkpoint_folder, checkpointed, stored

__all__ = ["checkpoint_folder", "checkpointed", "connected_components", "free_names", "stored", "table", "text_pieces", "with_row_numbers"]

#: Edges of a task when components are sought, and tasks at least: few edges in many tasks leave many small files.
TASK_EDGES, LEAST_TASKS = 50_000, 8
#: Bytes of texts that Python code takes out of an Arrow batch at once, about.
PIECE_BYTES = 1 << 22


def text_pieces(batch: pa.RecordBatch, at: int, binary: bool = True) -> Iterator[tuple[pa.RecordBatch, list]]:
    """A batch in pieces of about ``PIECE_BYTES``, each with the texts of its column ``at`` as bytes (or as they are).

    How large a batch is the session says (``spark.sql.execution.arrow.maxBytesPerBatch``);
    as Python objects only a piece of it is held.
    """
    rows = max(1, min(batch.num_rows, batch.num_rows * PIECE_BYTES // max(1, batch.column(at).nbytes)))
    for first in range(0, batch.num_rows, rows):
        piece = batch.slice(first, rows)
        texts = piece.column(at)
        yield piece, (texts.cast(pa.binary()) if binary else texts).to_pylist()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores at its end as it takes to be no column of ``docs``."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def reads_rows_once(docs: DataFrame) -> bool:
    """Whether the plan from the files up has projections and filters alone, so that a row of a file is there once at most."""
    node = docs._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.getClass().getSimpleName() == "LogicalRelation"


def with_row_numbers(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long ``name`` that tells rows apart, and is the same whenever they are read again.

    Rows that are read from Parquet files and no more are known by file and
    place; all others (joined, exploded, in a union, from elsewhere) are written,
    with a number each.
    """
    if not reads_rows_once(docs):
        return checkpointed(docs.withColumn(name, F.monotonically_increasing_id()))
    path, index, first = free_names(docs, "__path", "__index", "__first")
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(index))
        paths = docs.select(F.col("_metadata.file_path").alias(path)).distinct()
    except AnalysisException:  # no rows of files, or a format without places
        return checkpointed(docs.withColumn(name, F.monotonically_increasing_id()))
    files = sorted(r[path] for r in paths.collect())  # the driver lists them anyway
    firsts = docs.sparkSession.createDataFrame([(p, k << 40) for k, p in enumerate(files)], f"{path} string, {first} long")
    return placed.join(F.broadcast(firsts), path).withColumn(name, F.col(first) + F.col(index)).drop(path, index, first)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node that each node of ``edges`` reaches, as ``(node, root)``.

    Alternates large stars and small stars until the edges are one star for each
    component.  The smallest neighbour comes from an aggregation with a partial
    step on the map side, so a hub with many edges costs one row for each task.
    Loops and repeated edges are allowed; nodes without an edge don't come back.
    """
    e, seen = checkpointed(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()), None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen, tasks = state, max(LEAST_TASKS, state[0] // TASK_EDGES)
        few = lambda df, tasks=tasks: df.coalesce(tasks)
        # an aggregate in fewer tasks is dealt out anew for the join, as is its other side, so that a hub with very many edges can be split over tasks
        both = few(e).union(few(e).select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = few(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = few(few(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")).distinct())
        low = few(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u <> v")
        )
        e = checkpointed(few(few(small).distinct()))
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
