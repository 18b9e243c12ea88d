import re
from collections import defaultdict

import pytest

from casona.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_targets(rows):
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += words(text)
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share >= 2 * sizes[s]}
        if not full:
            return sizes, target | {s: weight[s] * share for s in open_}
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= full
    return sizes, target


def check(rows, out):
    sizes, target = slow_targets(rows)
    assert sorted((r["doc_id"], r["size"]) for r in out if r["doc_id"] is not None) == sorted((d, words(t)) for d, t, *_ in rows if d is not None)
    of = defaultdict(set)
    for d, t, _, s, _ in rows:
        of[d, words(t)].add(s)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        source = next(s for s in of[r["doc_id"], r["size"]] if sizes[s] == r["source_size"])
        assert r["target"] == pytest.approx(target[source]) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    total = sum(sizes.values())
    assert total * 1.5 - max(largest.values(), default=0) <= sum(taken.values()) <= total * 1.5
    slack = sum(largest.values())
    for s in target:
        assert taken[s] <= 2 * sizes[s] and abs(taken[s] - target[s]) <= largest[s] + target[s] * slack / max(1, 1.5 * total)


def test_documents(docs, doc_rows):
    a, b = (mixing.allotments(docs.repartition(n)).collect() for n in (3, 5))
    check(doc_rows, a)
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_edge_cases(edge, edge_rows):
    out = mixing.allotments(edge).collect()
    assert len(out) == len(edge_rows)
    check(edge_rows, out)
    mixed = mixing.mixed(edge)
    assert mixed.columns == edge.columns
    assert sum(words(r["text"]) for r in mixed.collect()) == sum(r["taken"] for r in out)


def test_no_words(spark, none):
    assert mixing.allotments(none).count() == 0
    empty = spark.createDataFrame([(1, "", None, "a", 0), (2, None, None, None, 0)], none.schema)
    assert {(r["taken"], r["target"]) for r in mixing.allotments(empty).collect()} == {(0, 0.0)}


def test_capped_sources(spark, none):
    rows = [(k, "w " * 10, None, "small", 0) for k in range(3)] + [(100 + k, "w " * 10, None, "z", 0) for k in range(300)]
    out = mixing.allotments(spark.createDataFrame(rows, none.schema)).collect()
    assert {r["target"] for r in out if r["source_size"] == 30} == {60.0}
    assert all(r["taken"] == 20 for r in out if r["source_size"] == 30)


def test_runs_of_one_source(spark, none):
    rows = [(k, "w " * (k % 7), None, "a" if k % 3 else "b", 0) for k in range(400)]
    check(rows, mixing.allotments(spark.createDataFrame(rows, none.schema)).collect())


def test_many_sources(spark, none):
    rows = [(k, "w " * (1 + k * k % 13), None, f"s{k % 60}" if k % 61 else None, 0) for k in range(600)]
    check(rows, mixing.allotments(spark.createDataFrame(rows, none.schema)).collect())
