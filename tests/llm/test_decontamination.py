import hashlib
import re

import pytest

from casona.llm import decontamination as dc
from casona.llm import queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(rows, items, n=10):
    windows = set()
    for item, text in items:
        w = words(text)
        windows |= {(item, tuple(w[k : k + n])) for k in range(max(1, len(w) - n + 1))} if w and item is not None else set()
    out = []
    for doc, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    found.add(item)
        joined = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in dc.digest(df).collect()), key=repr)


ITEMS = [(1, "The of tion"), (2, "one"), (3, None), (4, ""), (None, "one"), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (6, "--- !!"), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (70, "漢字 \U0001f600 the")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def planted(edge_rows):
    passage = ITEMS[5][1]
    return edge_rows + [(50, f"x {passage.upper()} y", None, None, 0), (51, " ".join(passage.split()[1:11]), None, None, 0), (52, " ".join(passage.split()[:9]), None, None, 0), (53, f"{passage}, {passage}", None, None, 0)]


@pytest.mark.parametrize("block, lot", [(1 << 20, 1_000_000), (30, 1_000_000), (200, 15)])
def test_edge_cases(spark, edge_rows, none, items, monkeypatch, block, lot):
    monkeypatch.setattr(dc, "BLOCK_TOKENS", block)
    monkeypatch.setattr(dc, "LOT_TOKENS", lot)
    rows = planted(edge_rows) + [(None, f"a {ITEMS[5][1]} b", None, None, 0), (52, ITEMS[5][1], None, None, 0)]
    assert got(dc.contamination(spark.createDataFrame(rows, none.schema), items)) == slow(rows, ITEMS)


def test_empty(spark, none, edge, edge_rows, items):
    assert got(dc.contamination(none, items)) == []
    assert got(dc.contamination(edge, items.where("false"))) == slow(edge_rows, [])


def test_query(same_as_sql):
    same_as_sql(queries.op7_benchmark_decontamination, dc.DECONTAMINATION_SQL)


def test_stored_index_is_searched_again(spark, none, edge_rows, items, tmp_path):
    index = dc.build_index(spark.createDataFrame(planted(edge_rows), none.schema), str(tmp_path / "index"))
    again = spark.read.parquet(str(tmp_path / "index"))
    other = spark.createDataFrame([(8, "zeta eta theta iota kappa")], "item_id long, text string")
    assert got(dc.matches(again, items)) == slow(planted(edge_rows), ITEMS)
    assert got(dc.matches(index, other)) == slow(planted(edge_rows), [(8, "zeta eta theta iota kappa")])


@pytest.mark.parametrize("lot", [1_000_000, 15])
def test_clean_rows_are_kept_whatever_their_id(spark, edge, edge_rows, items, none, monkeypatch, lot):
    monkeypatch.setattr(dc, "BLOCK_TOKENS", 100)
    monkeypatch.setattr(dc, "LOT_TOKENS", lot)
    rows = planted(edge_rows) + [(None, f"a {ITEMS[5][1]} b", None, None, 0), (1, ITEMS[5][1], None, None, 0)]
    kept = dc.clean(spark.createDataFrame(rows, none.schema), items)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r in rows if not slow([r], ITEMS)[0][-1]), key=repr)
    assert dc.clean(edge, items).columns == edge.columns and dc.clean(none, items).count() == 0


def slow_near(rows, items, n=10):
    out = []
    for doc, text, *_ in rows:
        w, found = words(text), set()
        for item, passage in items:
            ws = words(passage) if item is not None else []
            for k in range(max(1, len(ws) - n + 1) if ws else 0):
                window = ws[k : k + n]
                first, far = max(window, key=lambda x: (len(x.encode()), x.encode())), dc.reach(len(window))
                found |= {(item, p) for p, x in enumerate(w) if x == first and set(window) <= set(w[max(0, p - far) : p + far + 1])}
        out.append((doc, sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, lot", [(1 << 20, 1_000_000), (30, 1_000_000), (200, 15)])
def test_proximity_matches(spark, edge_rows, none, items, monkeypatch, block, lot):
    monkeypatch.setattr(dc, "BLOCK_TOKENS", block)
    monkeypatch.setattr(dc, "LOT_TOKENS", lot)
    w = ITEMS[5][1].split()
    inserted = " ".join(x for k in range(0, 12, 4) for x in [*w[k : k + 4], "other"])
    rows = [*planted(edge_rows), (60, f"x {inserted} y", None, None, 0), (61, " ".join([w[1], w[0], *w[2:]]), None, None, 0), (62, " ".join(w[:6]), None, None, 0), (63, " ".join(w[6:]), None, None, 0), (64, " far out ".join(w), None, None, 0)]
    rows = list({r[0]: r for r in rows if r[0] is not None}.values())
    found = {r["doc_id"]: [tuple(x) for x in r["near"]] for r in dc.contamination(spark.createDataFrame(rows, none.schema).coalesce(1), items).collect()}
    assert sorted(found.items(), key=repr) == slow_near(rows, ITEMS)
    assert found[60] and found[61] and not found[62] and not found[63] and not found[64]
