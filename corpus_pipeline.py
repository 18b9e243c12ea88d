"""Corpus pipeline: language, near-duplicates, contamination, mixture, shards.

Each stage takes all that the one before it kept, as a table with the columns of
``documents``, and is written and read again in between.  The last one adds
where each row goes.  Stages tell rows apart by a number of their own; an id
may repeat or be missing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casona.functions.storage import removed
from casona.llm import decontamination, langid, mixing, sharding, simhash
from casona.llm.shared import checkpoint_folder, free_names, table, with_row_numbers

#: A document whose language is less likely than this is rejected, as is one without a letter.
MIN_SCORE = 0.3
SHARDS = 8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter go (null and empty texts too), and those whose best language scores too little.

    Scores compare the languages that were learned, so that texts in others mostly stay (README).
    """
    model = langid.train(docs)
    return langid.predict(docs, model, min_score=MIN_SCORE, names=tuple(free_names(docs, "__lang", "__score"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts (five-word shingles, 0.8): that with the smallest id, rows without one last."""
    [row] = free_names(docs, "__row")
    rows = with_row_numbers(docs, row)
    found = simhash.similar_rows(rows, row).join(rows.select(F.col(row).alias("row"), F.col("doc_id").alias("id")), "row")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    kept = found.groupBy("component").agg(F.min(order)["row"].alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a hit: those that hold ten words of a benchmark item in a row, or a whole shorter item, go.

    Each row is judged where its text is read, so ids don't matter.
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), n=10)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, whole."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ``shard`` and ``slot``; the shards' counts are at most one apart."""
    return sharding.sharded(docs, SHARDS)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("sharded", sharded),
]

#: A trained network can't be expressed in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages on ``documents``; what each returns is written as Parquet and read again.

    In a ``folder`` that is given, all stages' tables stay, and a run that was
    broken off goes on after the last stage that was written.  Else they lie in
    the shared checkpoint folder, and each goes once the next one is written.
    """
    docs = table(spark, sf_dir, "documents")
    own = folder or f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before: str | None = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{own}/{k}-{name}"
        if not is_written(spark, path):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if folder is None and before is not None:
            removed(spark, before)
        before = path
    return docs
