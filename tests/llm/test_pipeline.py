import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from casona.llm import langid, mixing
from casona.llm.shared import table

from .conftest import CLASHING
from .test_decontamination import slow as slow_contamination
from .test_mixing import words


def test_stage_names():
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminated", "mixed", "sharded"]


def slow_kept(rows):
    """The least id of each component of texts whose sets of five-word shingles are 0.8 similar."""
    sets = []
    for _, text in rows:
        w = [x.translate({k: k + 32 for k in range(65, 91)}) for x in re.split(r"[\x20\x09-\x0d]+", text or "") if x]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = [d for d, _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return set(label)


def test_stages_equal_brute_force(spark, small, docs, doc_rows):
    benchmark = [tuple(r) for r in table(spark, small, "benchmark").select("item_id", "text").collect()]
    model = langid.train(docs)
    labels, scores = model.predict([(r[1] or "").encode() for r in doc_rows])
    rows = [r for r, n, s in zip(doc_rows, labels, scores, strict=True) if n != "und" and s >= cp.MIN_SCORE]
    a = cp.language(spark, docs, small)
    assert a.columns == docs.columns and sorted(map(tuple, a.collect())) == sorted(rows)
    kept = slow_kept([r[:2] for r in rows])
    b = cp.near_duplicates(spark, a, small)
    rows = [r for r in rows if r[0] in kept]
    assert b.columns == docs.columns and sorted(map(tuple, b.collect())) == sorted(rows)
    clean = {r[0] for r in slow_contamination(rows, benchmark) if not r[-1]}
    c = cp.decontaminated(spark, b, small)
    rows = [r for r in rows if r[0] in clean]
    assert c.columns == docs.columns and sorted(map(tuple, c.collect())) == sorted(rows)
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.allotments(c).collect()}
    d = cp.mixed(spark, c, small)
    assert d.columns == docs.columns and Counter(tuple(r) for r in d.collect()) == Counter({r: times[r[0]] for r in rows if times[r[0]]})
    e = cp.sharded(spark, d, small).collect()
    counts = Counter(r["shard"] for r in e)
    assert sum(counts.values()) == sum(times.values()) and max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_edge_cases(spark, small, edge, edge_rows, none, name, stage):
    out = stage(spark, edge, small)
    assert set(out.columns) >= set(edge.columns)
    rows = out.collect()
    ids = Counter(r["doc_id"] for r in rows)
    assert all(r[c] == v for r in rows for c, v in CLASHING.items() if c not in ("shard", "slot"))
    of = lambda r: (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
    if name == "language":
        assert {4, 5, 6, 7}.isdisjoint(ids) and {1, 2, 3, 8, 10, 11} <= set(ids)
    if name == "near_duplicates":
        assert ids[3] <= 1 and ids[None] == 1 and ids[1] == 1 and ids[2] == 0 and ids[4] == 1 and ids[5] == ids[6] == 0 and ids[8] == 1
    if name == "decontaminated":
        assert Counter(map(of, rows)) == Counter(edge_rows)
    if name == "mixed":
        times = Counter(map(of, rows))
        assert set(times) <= set(edge_rows) and sum(words(r["text"]) for r in rows) > 0
        assert all(n <= 2 * edge_rows.count(row) for row, n in times.items())
        assert all(times[row] == edge_rows.count(row) for row in edge_rows if not words(row[1]))
        assert stage(spark, edge.repartition(5), small).count() == len(rows)
    if name == "sharded":
        assert Counter(map(of, rows)) == Counter(edge_rows)
        counts = Counter(r["shard"] for r in rows)
        assert max(counts.values()) - min(counts.values()) <= 1 and all(sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(n)) for k, n in counts.items())
    assert stage(spark, none, small).count() == 0


def test_contaminated_edge_rows_go_and_no_others(spark, small, edge, edge_rows):
    passage = spark.read.parquet(f"{small}/benchmark.parquet").first()["text"]
    hit = [(None, f"x {passage} y", None, None, 1), (1, passage.upper(), "en", "a", 1)]
    docs = spark.createDataFrame(edge_rows + hit, spark.read.parquet(f"{small}/documents.parquet").schema)
    kept = Counter(tuple(r) for r in cp.decontaminated(spark, docs, small).collect())
    assert kept == Counter(edge_rows)


def test_run(spark, small, docs, doc_rows):
    out = cp.run(spark, small)
    rows = out.collect()
    assert out.columns == [*docs.columns, "shard", "slot"] and {tuple(r)[:5] for r in rows} <= set(doc_rows)
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) > len(doc_rows) / 2 and set(counts) == set(range(cp.SHARDS)) and max(counts.values()) - min(counts.values()) <= 1


def test_run_goes_on_where_it_was_broken_off(spark, small, tmp_path, monkeypatch):
    done = []

    def step(name):
        def stage(_, docs, __):
            done.append(name)
            if name == "b" and done.count("b") == 1:
                raise RuntimeError("lost")
            return docs.select("doc_id").limit(3)

        return stage

    monkeypatch.setattr(cp, "STAGES", [(n, step(n)) for n in "abc"])
    with pytest.raises(RuntimeError):
        cp.run(spark, small, str(tmp_path / "run"))
    assert cp.run(spark, small, str(tmp_path / "run")).count() == 3 and done == ["a", "b", "b", "c"]
