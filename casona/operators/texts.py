"""Listings by texts that their project or city contains, through an index of short grams.

Listings share texts, so the index is of the distinct folded projects and
cities.  At each place of a text begins one gram, of ``LONGEST`` characters or up
to the text's end; the index has a row for each gram of a text, sorted by gram,
so that a look-up reads the few row groups that hold it, how many texts have
each gram, and the texts.  A text of up to ``LONGEST`` characters is what a gram
begins with; a longer one is looked up by its rarest gram, and compared with the
candidates at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casona.functions.labels import folded
from casona.functions.storage import stored

#: Characters of the longest gram.
LONGEST = 8
SEARCHED = ("project", "city")


def grams_of(text: Column, shortest: int = 1) -> Column:
    """What begins at each place of a text, up to ``LONGEST`` characters and no less than ``shortest``, each once."""
    last = F.char_length(text) - shortest + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda k: F.substr(text, k, F.lit(LONGEST))))).otherwise(F.array().cast("array<string>"))


def searched(column: str) -> Column:
    """A listing's folded text; an empty one if it has none."""
    return F.lower(F.coalesce(F.col(column), F.lit("")))


def distinct_texts(listings: DataFrame) -> DataFrame:
    """``(at, text)``: the folded texts of all listings, each once, and a number for each, which two may share."""
    texts = listings.select(F.explode(F.array(*[searched(c) for c in SEARCHED])).alias("text")).where("text <> ''").distinct()
    return texts.select(F.xxhash64("text").alias("at"), "text")


def write_index(listings: DataFrame, folder: str) -> None:
    """The index as three tables, ``texts``, ``postings`` and ``grams``, in ``folder``."""
    spark = listings.sparkSession
    distinct_texts(listings).write.parquet(f"{folder}/texts")
    rows = spark.read.parquet(f"{folder}/texts").select(F.explode(grams_of(F.col("text"))).alias("gram"), "at")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # by both columns, so that a very common gram is spread over files
    rows.repartitionByRange(parts, "gram", "at").sortWithinPartitions("gram", "at").write.option("parquet.block.size", 1 << 20).parquet(f"{folder}/postings")
    counted = spark.read.parquet(f"{folder}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counted.repartitionByRange(parts, "gram").sortWithinPartitions("gram").write.parquet(f"{folder}/grams")


def index_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{folder}/postings"), spark.read.parquet(f"{folder}/grams")


def candidates(text: str, folder: str, spark: SparkSession) -> DataFrame | None:
    """``(at)`` of the texts with the rarest gram of a text; nothing if the text is empty, as then all are."""
    text = folded(text)
    if not text:
        return None
    rows, counted = index_tables(spark, folder)
    if len(text) <= LONGEST:
        return rows.where(F.startswith(F.col("gram"), F.lit(text))).select("at").distinct()
    own = sorted({text[k : k + LONGEST] for k in range(len(text) - LONGEST + 1)})
    known = {r["gram"]: r["n"] for r in counted.where(F.col("gram").isin(own)).collect()}  # a row for each gram of the text
    # a gram that no listing has answers the search
    rarest = min(own, key=lambda g: (known.get(g, 0), g))
    return rows.where(F.col("gram") == rarest).select("at")


def matched_text(listings: DataFrame, folder: str, text: str) -> DataFrame:
    """Listings whose project or city contains ``text``, outer white space and case aside."""
    spark = listings.sparkSession
    found = candidates(text, folder, spark)
    if found is None:
        return listings
    held = spark.read.parquet(f"{folder}/texts").where(F.contains("text", F.lit(folded(text)))).join(found, "at", "left_semi")
    held = stored(held.select("text"))  # few mostly, and then Spark knows it
    rows = listings
    for c in SEARCHED:
        rows = rows.join(held.select(F.col("text").alias(f"__{c}")), searched(c) == F.col(f"__{c}"), "left")
    either = [f"__{c}" for c in SEARCHED]
    return rows.where(F.coalesce(*either).isNotNull()).drop(*either)


def texts_held(folder: str, texts: DataFrame) -> DataFrame:
    """``(text, asked)``: for each text of the index the folded texts ``q`` of ``texts`` that it contains, each once, if there are any.

    Each of them is a part of the text, which bounds their number however many are asked for.
    """
    spark = texts.sparkSession
    rows, counted = index_tables(spark, folder)
    asked = stored(texts.select("q").where("q <> ''").distinct())
    size = F.char_length("q")
    own = asked.where(size > LONGEST).select("q", F.explode(grams_of(F.col("q"), LONGEST)).alias("gram"))
    rarest = own.join(counted, "gram", "left").groupBy("q").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    sizes = [r[0] for r in asked.where(size <= LONGEST).select(size).distinct().collect()]  # LONGEST at most
    begins = F.array_distinct(F.array(*[F.left("gram", F.lit(n)) for n in sorted(sizes)]).cast("array<string>"))
    short = counted.select("gram", F.explode(begins).alias("q")).join(asked, "q").select("q", "gram")
    found = rarest.select("q", "gram").union(short).join(rows, "gram").groupBy("at").agg(F.collect_set("q").alias("asked"))
    both = spark.read.parquet(f"{folder}/texts").join(found, "at")
    return both.select("text", F.filter("asked", lambda q: F.contains(F.col("text"), q)).alias("asked")).where(F.size("asked") > 0)


def asked_of(rows: DataFrame, folder: str, texts: DataFrame) -> DataFrame:
    """``rows`` with their folded ``project`` and ``city`` once for each ``q`` that either contains."""
    held = stored(texts_held(folder, texts))
    # cities are few mostly: what they hold then goes to the rows
    of_city = stored(held.join(rows.select(F.col("city").alias("text")).distinct(), "text", "left_semi"))
    none = F.array().cast("array<string>")
    both = rows
    for c, own in zip(SEARCHED, (held, of_city), strict=True):
        both = both.join(own.select(F.col("text").alias(c), F.col("asked").alias(f"in_{c}")), c, "left")
    every = F.array_union(*[F.coalesce(f"in_{c}", none) for c in SEARCHED])
    return both.withColumn("q", F.explode(every)).drop(*[f"in_{c}" for c in SEARCHED])


def matched_texts(listings: DataFrame, folder: str, texts: DataFrame) -> DataFrame:
    """``(q, listing_id)`` for each listing that contains a folded text ``q`` of ``texts``; each text once, none empty or null."""
    rows = listings.select("listing_id", *[searched(c).alias(c) for c in SEARCHED])
    return asked_of(rows, folder, texts).select("q", "listing_id")


def texts_counted(listings: DataFrame, folder: str, texts: DataFrame) -> DataFrame:
    """``(q, n_listings)``: how many listings ``matched_texts`` has of each text, if any; listings of the same project and city count together."""
    rows = stored(listings.groupBy(*[searched(c).alias(c) for c in SEARCHED]).agg(F.count(F.lit(1)).alias("n")))
    return asked_of(rows, folder, texts).groupBy("q").agg(F.sum("n").alias("n_listings"))
