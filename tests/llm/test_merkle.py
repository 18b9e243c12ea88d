"""The Merkle manifest against trees that are built level by level, and against SQL."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from casona.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    text, lang, source, n = row[1:5]
    values = [None if v is None else str(v) for v in (row[0], source, lang, n, text)]
    return digest(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def tree(leaves):
    """The root, and each leaf's siblings with the sides on which they stand."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, p in enumerate(at):
            other = p ^ 1
            paths[k].append((other < p, level[other]) if other < len(level) else None)
            at[k] = p // 2
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    root, upper = tree([trees[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for row, path in zip(groups[g], trees[g][1], strict=True):
            path = path + upper[k]
            folded = leaf(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                folded = leaf((*row[:4], row[4] + 1))
            for step in path:
                folded = digest(folded) if step is None else digest(step[1], folded) if step[0] else digest(folded, step[1])
            out.append((row[0], leaf(row), trees[g][0], root, digest(*[s[1] for s in path if s]), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_edge_rows(edge, edge_rows, height, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    assert rows_of(merkle.digest(edge)) == expected(edge_rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_every_size(spark, n, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    rows = [(k, f"t{k}", "en", "a", k) for k in range(n)]
    found = rows_of(merkle.digest(spark.createDataFrame(rows, SCHEMA)))
    assert found == expected(rows) and len(found) == n
    if n == 1:
        assert found[0][1] == found[0][2] == found[0][3] and found[0][4] == digest()


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    rows = [(k, "t", f"l{k * 7 % 13}", None, None) for k in range(40)]
    assert rows_of(merkle.digest(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_proofs_hold_and_names_do_not_matter(docs):
    named = docs.withColumns({c: F.lit("x") for c in ("key", "group", "leaf", "claimed", "tree", "place", "n", "digest", "block", "at", "part", "start", "g", "__part", "__n", "__at", "__start")})
    found = merkle.proofs(named)
    assert found.where("folded_root <> root").count() == 0 and found.count() == docs.count()


def test_ids_may_be_texts(docs):
    found = merkle.digest(docs.withColumn("doc_id", F.col("doc_id").cast("string")))
    assert found.select("root").distinct().count() == 1 and dict(found.dtypes)["doc_id"] == "string"


def test_empty(none):
    assert merkle.digest(none).collect() == []


def test_rows_of_sql(same_as_sql):
    same_as_sql(queries.op11_merkle_manifest, merkle.MERKLE_SQL)
