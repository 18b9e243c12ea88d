import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casona.llm import queries, vafile


def slow(rows, k=20, every=20):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (q, v) in enumerate(vectors):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for at, (i, w) in enumerate(vectors) if at != own and len(w) == len(v))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("block, query_block, bits", [(65_536, 4_096, 8), (40, 7, 8), (40, 7, 3)])
def test_ties_copies_and_bad_vectors(spark, monkeypatch, block, query_block, bits):
    monkeypatch.setattr(vafile, "BLOCK", block)
    monkeypatch.setattr(vafile, "QUERY_BLOCK", query_block)
    over = vafile.Cells.over
    monkeypatch.setattr(vafile.Cells, "over", staticmethod(lambda least, most: over(least, most, bits)))
    rng = random.Random(block)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(6)]) for k in range(200)]
    rows += [(1000 + k, [0.5] * 6) for k in range(100)] + [(5, [0.1] * 6), (20, [0.9] * 6), (20, [0.9] * 6), (20, [0.5] * 6), (300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [0.1] * 6)]
    rows += [(400, [1.0, 2.0]), (401, [0.5, 0.5]), (420, []), (440, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "v": F.lit("y"), "rank": F.lit(0), "row": F.lit(1), "query": F.lit("z")})
    assert got(vafile.top_k(df, F.col("vec_id") % 20 == 0, 20)) == slow(rows)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    assert got(vafile.top_k(df, F.col("vec_id") % 20 == 0, 20)) == [(0, 1, 1, 8192), (0, 2, 2, -4096)]
    assert got(vafile.top_k(df.where("false"), F.col("vec_id") % 20 == 0, 20)) == []
    assert got(vafile.top_k(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0, 20)) == []


@pytest.mark.parametrize("large", [1e9, 1e300])
def test_scores_beyond_64_bits_are_refused(spark, large):
    df = spark.createDataFrame([(0, [large, 1.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="2\\*\\*63"):
        vafile.top_k(df, F.col("vec_id") % 20 == 0, 20)


@pytest.mark.parametrize("power, dim", [(10, 4), (16, 3), (21, 1), (24, 2), (25, 1)])
def test_large_scores_are_exact(spark, power, dim):
    rng = random.Random(power)
    rows = [(k, [float(rng.randrange(-(2**power), 2**power + 1)) + rng.randrange(64) / 64 for _ in range(dim)]) for k in range(60)] + [(k, [2.0**power] * dim) for k in (100, 101, 120)]
    assert got(vafile.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 20)) == slow(rows)


@pytest.mark.parametrize("spread", [9, 300, 2**20, 2**29])
@pytest.mark.parametrize("bits", [2, 4, 6])
def test_bounds_hold(bits, spread):
    rng = np.random.default_rng(1)
    exact, q = rng.integers(-spread, spread, (500, 9)), rng.integers(-spread, spread, (20, 9))
    cells = vafile.Cells.over(exact.min(axis=0), exact.max(axis=0), bits)
    assert int(cells.of(exact).max()) < 1 << bits
    weights, low, high = cells.bounds(q)
    sums, true = (weights @ cells.of(exact).T.astype(weights.dtype)).astype(object), q.astype(object) @ exact.T.astype(object)
    sums = np.vectorize(int, otypes=[object])(sums)
    assert (sums + low.astype(object)[:, None] <= true).all() and (true <= sums + high.astype(object)[:, None]).all()


def test_few_exact_vectors_are_read(spark, small):
    read = []
    rng = np.random.default_rng(2)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(0, 20, (2000, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(vafile.top_k(df, F.col("vec_id") % 20 == 0, 20, counted=read)) == slow(rows)
    assert 100 * 20 <= read[0] < 100 * 2000 / 10
    # with components of few different values the cells say all
    few = spark.createDataFrame([(k, (np.clip(v, -15, 15) / 64).tolist()) for k, v in rows], "vec_id long, embedding array<double>")
    vafile.top_k(few, F.col("vec_id") % 20 == 0, 20, counted=read)
    assert read[1] == 0


def test_no_table_outgrows_vectors_and_results(spark, monkeypatch):
    """Where two far vectors leave the others in one cell and the bounds tell nothing apart, what is stored are vectors and the best of each query and block."""
    counts, store = [], vafile.stored
    monkeypatch.setattr(vafile, "stored", lambda df: counts.append((out := store(df)).count()) or out)
    monkeypatch.setattr(vafile, "BLOCK", 150)
    monkeypatch.setattr(vafile, "QUERY_BLOCK", 30)
    rng = np.random.default_rng(3)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(0, 1, (600, 4)))] + [(601, [1e4] * 4), (602, [-1e4] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(vafile.top_k(df, F.col("vec_id") % 5 == 0, 3)) == slow(rows, 3, 5)
    assert max(counts) <= 120 * 5 * 4 + 602


def test_more_results_than_vectors(spark):
    rows = [(k, [k / 7, 1 - k / 9]) for k in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(vafile.top_k(df, F.col("vec_id") % 10 == 0, 10**9)) == slow(rows, 10**9, 10)


def test_blocks_of_long_vectors_and_of_many_results_are_small(spark):
    rows = spark.createDataFrame([(64,)] * 100 + [(640,)] * 50, "dim int")
    assert [vafile.parts(rows, 10), vafile.parts(rows, 10, 6400), vafile.parts(rows.where("dim = 64"), 100), vafile.parts(rows.where("false"), 10)] == [50, 1000, 1, 1]


def test_query(same_as_sql):
    same_as_sql(queries.op10_exact_top_k, vafile.TOP_K_SQL)


def test_the_query_reads_few_exact_vectors(spark, small):
    read, table = [], spark.read.parquet(f"{small}/embeddings.parquet")
    vafile.top_k(table, F.col("vec_id") % 20 == 0, 20, counted=read)
    n, asked = table.count(), table.where("vec_id % 20 = 0").count()
    assert 0 < read[0] <= n * asked / 2  # a tenth of so few rows is among the best
