import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casona.llm import simhash
from casona.llm.shared import connected_components


def slow_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [b" ".join(words)] * bool(words)
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum((2 * c > len(shingles)) << b for b, c in enumerate(counts))


def slow_components(rows, bits=4):
    prints = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= bits):
            parent[root(i)] = root(int(j))
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[root(i)].append(doc)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((d, f"{p:016x}", smallest[root(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=repr)


def got(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


def test_equals_brute_force(docs, doc_rows):
    assert got(simhash.near_duplicates(docs)) == slow_components([r[:2] for r in doc_rows])


def test_edge_cases(edge, edge_rows):
    assert got(simhash.near_duplicates(edge)) == slow_components([r[:2] for r in edge_rows])


def test_ids_that_are_too_large_are_refused(spark):
    with pytest.raises(ValueError, match="ids"):
        simhash.near_duplicates(spark.createDataFrame([(2**62, "a")], "doc_id long, text string"))
    low = [(-5, "a b"), (-7, "a b"), (None, "c"), (2**62 - 1, "d")]
    assert got(simhash.near_duplicates(spark.createDataFrame(low, "doc_id long, text string"))) == slow_components(low)


def test_empty(none):
    assert got(simhash.near_duplicates(none)) == []


def clustered(rng, n):
    """Fingerprints around few centres, so that links, chains and near misses occur."""
    centres = [rng.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randrange(9)):
            x ^= 1 << b
        out.add(x)
    return list(out)


@pytest.mark.parametrize("bits, pair_rows, n", [(4, 1024, None), (4, 20, None), (4, 1024, 10**10), (0, 1024, None), (7, 30, None)])
def test_links_join_what_is_near(spark, monkeypatch, bits, pair_rows, n):
    monkeypatch.setattr(simhash, "PAIR_ROWS", pair_rows)
    values = clustered(random.Random(bits), 600)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(v, v) for v in signed], "fp long, node long"), bits, n)
    roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
    u = np.array(values, np.uint64)
    label = list(range(len(u)))
    for _ in range(len(u)):
        new = [min(label[j] for j in np.flatnonzero(np.bitwise_count(u ^ x) <= bits)) for x in u]
        if new == label:
            break
        label = new
    groups, found = defaultdict(set), defaultdict(set)
    for k, x in enumerate(signed):
        groups[label[k]].add(x)
        found[roots.get(x, x)].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {roots[k] for k in range(41)} == {0} and {roots[k] for k in range(1000, 1200)} == {1000}


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c d", 42)
