"""Codes of vectors against codebooks worked out number by number, and against SQL."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casona.llm import codes, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    near = lambda v, p: min((sum((x - y) ** 2 for x, y in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        members = [[[] for _ in books[p]] for p in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                members[p][near(v, p)[1]].append(cut(v, p))
        books = [[[sum(x) // len(m) for x in zip(*m, strict=True)] if m else e for e, m in zip(books[p], members[p], strict=True)] for p in range(parts)]
    found = [(i, label, [near(v, p) for p in range(parts)]) for i, v, label in kept]
    totals = {}
    for _, label, x in found:
        totals[label] = totals.get(label, 0) + sum(d for d, _ in x)
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted([(i, "".join(f"{k:02x}" for _, k in x), sum(d for d, _ in x), totals[label], sha) for i, label, x in found], key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=repr)


def vectors(n, dim, seed=3, scale=1.0):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0, scale) for _ in range(dim)], rng.choice([None, 1, 2])) for k in range(n)]


def test_edge_rows(spark):
    rows = vectors(150, 32)
    rows += [rows[5], rows[5], (None, rows[9][1], None), (900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 1), (903, [float("inf")] + [0.0] * 31, 2), (904, [-0.001] * 32, 2)]
    assert rows_of(codes.digest(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65])
def test_few_rows_and_small_blocks(spark, n, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_ROWS", 7)
    rows = vectors(n, 16, seed=n)
    assert rows_of(codes.digest(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_large_numbers_stay_exact(spark):
    rows = [(k, [(-1) ** k * 2.0 ** (16 + k % 6) + k for _ in range(16)], 1) for k in range(80)]
    assert rows_of(codes.digest(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    with pytest.raises(Exception, match="2\\*\\*62"):
        codes.digest(spark.createDataFrame([(1, [1e30] * 16, 1)], SCHEMA)).collect()


@pytest.mark.parametrize("spread", [2**20, 2**29, 2**31])
def test_tables_of_every_width(spread):
    rng = np.random.default_rng(1)
    numbers = rng.integers(-spread, spread, (50, 32))
    books = rng.integers(-spread, spread, (16, 9, 2))
    found = [np.unique(numbers[:, d], return_inverse=True) for d in range(32)]
    entry, distance = codes.nearest([v for v, _ in found], [c for _, c in found], 50, books)
    for p in range(16):
        for r in range(50):
            each = [sum((int(numbers[r, 2 * p + j]) - int(books[p, e, j])) ** 2 for j in range(2)) for e in range(9)]
            assert (entry[p, r], distance[p, r]) == (each.index(min(each)), min(each))


def test_empty_and_lengths(spark):
    assert codes.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert codes.digest(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    [row] = codes.digest(spark.createDataFrame([(1, [], 1)], SCHEMA)).collect()
    assert (row["code"], row["error"]) == ("00" * 16, 0)
    with pytest.raises(ValueError, match="components"):
        codes.digest(spark.createDataFrame([(1, [1.0] * 16, 1), (2, [1.0] * 32, 1)], SCHEMA))


def test_names_do_not_matter(spark):
    rows = vectors(30, 16)
    named = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "v", "of", "n", "ids", "labels", "codes", "code", "error", "label_error", "dictionaries")})
    assert rows_of(codes.digest(named)) == expected(rows)


def test_rows_of_sql(same_as_sql):
    same_as_sql(queries.op12_dictionary_codes, codes.CODES_SQL)
