"""Personal data: base spans against the plain patterns, message passing against enumeration, consistency within a document."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from casona.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = 0
        for k, d in enumerate(reversed(digits)):
            x = int(d) * (1 + k % 2)
            total += x - 9 * (x > 9)
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), m.end(), k) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if holds(kind, m.group())]
    return sorted(found, key=lambda x: (x[0], x[2]))


def card(rng, n=16):
    digits = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(digits + d for d in "0123456789" if holds("card", digits + d))


def test_base_spans_on_random_texts():
    rng = random.Random(5)
    for alphabet in ("a1.@-", "01 -", "0.2519", "+1 ()-.9", "a@.b_%+-1 é", "@.-", "4 1-"):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert pii.base_spans(text) == plain(text), text
    for _ in range(300):
        parts = [rng.choice([card(rng), card(rng, 19), "10.0.255.1", "256.1.1.1", "a.b@c.de", "+1 (555) 010-9999", "001.2.3.4", "x@y", "é", "4111-1111 1111-1111", ".", "\n"]) for _ in range(12)]
        text = rng.choice(["", " ", ","]).join(parts)
        assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("unit", ["1", "a", "@", "1.", "a@", "a@b", "+1", "1-", "9 ", "a1", "a.", "()", "+"])
def test_long_runs_take_linear_time(unit):
    text = unit * (400_000 // len(unit))
    spans = pii.base_spans(text)
    g = pii.graph_of([text], [spans])
    assert len(g.edges) <= 3 * max(1, len(g.at))


def enumerated(nodes, edges, pairs):
    total = np.zeros(nodes.shape)
    for labels in itertools.product(range(pii.LABELS), repeat=len(nodes)):
        p = np.exp(sum(nodes[i, k] for i, k in enumerate(labels)) + sum(pairs[t, labels[a], labels[b]] for a, b, t in edges))
        for i, k in enumerate(labels):
            total[i, k] += p
    return total / total.sum(axis=1, keepdims=True)


def test_marginals_are_exact_on_trees_and_near_on_loops():
    rng = np.random.default_rng(2)
    nodes, pairs = rng.normal(size=(5, pii.LABELS)), rng.normal(size=(2, pii.LABELS, pii.LABELS))
    pairs[1] = (pairs[1] + pairs[1].T) / 2
    tree = np.array([(0, 1, 0), (1, 2, 0), (0, 3, 1), (1, 4, 1)])
    got, _ = pii.passed(nodes, tree, pairs, rounds=60)
    assert np.abs(np.exp(got) - enumerated(nodes, tree, pairs)).max() < 1e-6
    loop = np.vstack([tree, (2, 3, 1)])
    got, _ = pii.passed(nodes, loop, pairs / 2, rounds=60)
    assert np.abs(np.exp(got) - enumerated(nodes, loop, pairs / 2)).max() < 0.05


def training(rng, n=400):
    texts = []
    for k in range(n):
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        ip = ".".join(str(rng.randrange(1, 255)) for _ in range(4))
        choices = [phone, ip, f"name{k}@mail.example.com", card(rng), str(rng.randrange(1900, 2100)), str(rng.randrange(10**6, 10**7)), f"x{k}y"]
        picked = [rng.choice(choices) for _ in range(3)]
        texts.append(" word of text ".join([*picked, picked[0]]))
    return texts


@pytest.fixture(scope="module")
def weights():
    return pii.learned(training(random.Random(3)))


def spans_of(text, weights, least=0.5):
    base = pii.base_spans(text)
    return pii.added_spans(pii.graph_of([text], [base]), weights, [text], least)[0]


def test_a_document_agrees(weights):
    """A number that is no span by itself is one in a document that has it as a phone elsewhere."""
    text = "+1 (743) 555-3824 is his number " + "and on " * 500 + "7435553824 again"
    g = pii.graph_of([text], [pii.base_spans(text)])
    assert g.edges[:, 2].tolist().count(1) == 1
    alone = "word of text 7435553824 again"
    sure = lambda t: np.exp(marginal(t, weights))[-1, 4]
    assert sure(text) > 3 * sure(alone)


def marginal(text, w):
    g = pii.graph_of([text], [pii.base_spans(text)])
    held = np.where((g.base[:, None] == 0) | (g.base[:, None] == np.arange(pii.LABELS)), 0.0, -60.0)
    return pii.passed(pii.scores(g.features, w.node) + held, g.edges, np.stack([w.chain, w.skip]))[0]


def test_added_spans_do_not_touch_base_ones(weights):
    rng = random.Random(8)
    for text in training(rng, 100) + ["+1 (826) 555-4081 190.137.2.1", "300.1.2.3 300.1.2.3", "a@b a@b 5@c.d"]:
        base, more = pii.base_spans(text), spans_of(text, weights)
        assert all(e <= s or f <= b for b, e, _ in base for s, f, _ in more) and all(s < e for s, e, _ in more)


def test_plain_prose_has_none(weights):
    assert spans_of("no digits here", weights) == [] and spans_of("in 1999, 3 of 20", weights) == []


def test_documents_do_not_touch_each_other(weights):
    texts = training(random.Random(9), 30)
    base = [pii.base_spans(t) for t in texts]
    assert pii.added_spans(pii.graph_of(texts, base), weights, texts, 0.5) == [spans_of(t, weights) for t in texts]


def test_edge_rows(edge, edge_rows):
    named = edge.withColumns({c: F.lit("x") for c in ("keep", "base", "spans", "h", "passage", "n_email", "n_ip")})
    rows = pii.digest(named).collect()
    assert len(rows) == len(edge_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["spans"] == "" and by_id[4]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty(none):
    assert pii.digest(none).collect() == []


def test_whole_table(spark, small, doc_rows):
    rows = queries.op13_skip_chain_pii(spark, small).collect()
    expected = {}
    for row in doc_rows:
        spans = plain(row[1])
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in spans)
        expected[row[0]] = (*[sum(k == kind for _, _, k in spans) for kind in range(4)], hashlib.sha256(base.encode()).hexdigest(), set(base.split(",")) - {""})
    assert len(rows) == len(doc_rows)
    for r in rows:
        e = expected[r["doc_id"]]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == e[:5] and e[5] <= set(r["spans"].split(","))
    assert sorted(rows) == sorted(queries.op13_skip_chain_pii(spark, small).collect())
