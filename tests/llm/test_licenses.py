import random

import numpy as np
import pytest

from casona.llm import licenses as lc


def lcs_in_band(template, ids, diagonal, band):
    """Longest common subsequence by a full table, cells outside the band left out."""
    table = np.zeros((len(template) + 1, len(ids) + 1), int)
    for k in range(len(template)):
        for j in range(len(ids)):
            hit = template[k] == ids[j] and abs(j - k - diagonal) <= band
            table[k + 1, j + 1] = max(table[k, j + 1], table[k + 1, j], table[k, j] + 1 if hit else 0)
    return int(table[-1, -1])


def test_alignment_equals_full_table():
    rng = random.Random(5)
    for _ in range(300):
        template = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 14))])
        ids = np.array([rng.randrange(-1, 6) for _ in range(rng.randrange(1, 40))])
        diagonal, band = rng.randrange(-5, 30), rng.randrange(0, 6)
        matched, first, last = lc.aligned(template, ids, diagonal, band)
        assert matched == lcs_in_band(template, ids, diagonal, band)
        if matched:
            assert lcs_in_band(template, np.where((np.arange(len(ids)) >= first) & (np.arange(len(ids)) <= last), ids, -2), diagonal, band) == matched


def found(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted((r["doc_id"], r["license"], texts[r["doc_id"]][r["start"] : r["stop"]], round(r["coverage"], 2)) for r in lc.license_spans(df, **more).collect())


def test_whole_templates_and_spans(spark):
    texts = [f"Some words before. {t} And after it." for t in lc.TEMPLATES.values()]
    rows = found(spark, texts)
    for k, name in enumerate(lc.TEMPLATES):
        mine = [r for r in rows if r[0] == k and r[1] == name]
        assert mine and mine[0][3] == 1.0
        assert mine[0][2].split()[0].strip('"') == lc.TEMPLATES[name].split()[0].strip('"')


def test_changed_words(spark):
    text = lc.TEMPLATES["MIT"].split()
    rng = random.Random(2)
    for at in rng.sample(range(10, len(text)), 6):
        text[at] = "zzz"
    dropped = [w for k, w in enumerate(text) if k % 25 != 24]
    rows = found(spark, ["x " + " ".join(text), " ".join(dropped), " ".join(text[:20])])
    assert {(r[0], r[1]) for r in rows if r[1] == "MIT"} == {(0, "MIT"), (1, "MIT")}


def test_clean_and_edge(spark, edge, none):
    assert found(spark, ["Permission slips are due. All the rights we reserved were free of charge.", ""]) == []
    assert lc.license_spans(edge).count() == 0 and lc.license_spans(none).count() == 0
    two = found(spark, ["All rights reserved. " + "filler words here " * 9 + "ALL RIGHTS RESERVED"])
    assert {r[2] for r in two} == {"All rights reserved", "ALL RIGHTS RESERVED"}


def slow_scan(index, text):
    """Every template aligned on every diagonal; of overlapping findings of one the best stays."""
    ids = np.array([index.vocabulary.get(w, -1) for w in lc.words(text)], int)
    out = []
    for t, name in enumerate(index.names):
        size, best = len(index.tokens[t]), set()
        for diagonal in range(-size, len(ids) + size):
            matched, first, last = lc.aligned(index.tokens[t], ids, diagonal, min(lc.BAND, max(1, size // 2)))
            if matched >= lc.COVERAGE * size - 1e-9 and matched >= lc.DENSITY * (last - first + 1):
                best.add((matched, first, last))
        kept = []
        for m, i, j in sorted(best, key=lambda x: (-x[0], x[2] - x[1], x[1])):
            if all(j < a or i > b for a, b, _ in kept):
                kept.append((i, j, m))
        out += [(name, i, j, m) for i, j, m in sorted(kept)]
    return out


def changed(rng, tokens, vocabulary):
    """The words with some replaced, lost or put between."""
    share = rng.uniform(0, 0.3)
    out = []
    for w in tokens:
        kind = rng.random()
        if kind < share / 2:
            out.append(rng.choice(["zzz", rng.choice(vocabulary)]))
        elif kind < 0.75 * share:
            continue
        else:
            out.append(w)
        if rng.random() < share / 4:
            out.append(rng.choice(["yyy", rng.choice(vocabulary)]))
    return out


def test_nothing_that_qualifies_is_lost():
    index, rng = lc.TemplateIndex({n: t for n, t in lc.TEMPLATES.items() if len(lc.words(t)) < 36}), random.Random(21)
    vocabulary, found = sorted(index.vocabulary), 0
    names = index.names
    for k in range(80):
        parts = ["xxx"] * (400 if k % 20 == 0 else 0)
        for name in rng.choices(names, k=3):
            parts += [*rng.choices([*vocabulary, "xxx"], k=rng.randrange(6)), *changed(rng, lc.words(lc.TEMPLATES[name]), vocabulary)]
        text = " ".join(parts)
        spans = {x.start(): n for n, x in enumerate(lc.WORD.finditer(text))}
        ends = {x.end(): n for n, x in enumerate(lc.WORD.finditer(text))}
        got = [(x[0], spans[x[2]], ends[x[3]], x[4]) for x in index.scan(text)]
        assert got == slow_scan(index, text)
        found += len(got)
    assert found > 100


def test_whole_licenses_with_changed_words():
    index, rng = lc.TemplateIndex(lc.TEMPLATES), random.Random(22)
    for name in ("MIT", "BSD-3-Clause", "AGPL-3.0-header"):
        parts = changed(rng, lc.words(lc.TEMPLATES[name]), ["the"])
        got = {(x[0], x[4]) for x in index.scan(" ".join(["Some", "words", *parts]))}
        assert got == {(n, m) for n, _, _, m in slow_scan(index, " ".join(["Some", "words", *parts]))}


def test_documents_equal_all_diagonals(docs, doc_rows):
    index = lc.TemplateIndex({n: t for n, t in lc.TEMPLATES.items() if len(lc.words(t)) < 15})
    rng = random.Random(23)
    some = rng.sample([r for r in doc_rows if r[1] and len(r[1]) < 1500], 25) + [r for r in doc_rows if r[1] and len(r[1]) < 1500 and "icense" in r[1]][:10]
    for r in some:
        assert [(x[0], x[4]) for x in index.scan(r[1])] == [(n, m) for n, _, _, m in slow_scan(index, r[1])]
    rows = {(r["doc_id"], r["license"]) for r in lc.license_spans(docs).collect()}
    for name in ("Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", "MIT-notice", "all-rights-reserved"):
        want = " ".join(lc.words(lc.TEMPLATES[name]))
        plain = {r[0] for r in doc_rows if f" {want} " in f" {' '.join(lc.words(r[1]))} "}
        assert plain <= {d for d, n in rows if n == name}


def test_templates_without_words_are_an_error():
    with pytest.raises(ValueError, match="blank"):
        lc.TemplateIndex({"blank": " -- "})


def test_notices_that_follow_one_another():
    index = lc.TemplateIndex(lc.TEMPLATES)
    assert [(x[2], x[3]) for x in index.scan("All rights reserved. " * 3)] == [(0, 19), (21, 40), (42, 61)]
    assert len(index.scan("Released under the MIT License. " * 500)) == 500


def test_short_notices_beside_words_of_templates():
    index, rng = lc.TemplateIndex(lc.TEMPLATES), random.Random(11)
    vocabulary = sorted(index.vocabulary)
    contexts = [("the license", "You may not"), ("this license", "Use of this")] + [(" ".join(rng.choices(vocabulary, k=4)), " ".join(rng.choices(vocabulary, k=4))) for _ in range(2000)]
    for before, after in contexts:
        text = f"{before}. All rights reserved. {after}"
        assert "All rights reserved" in {text[x[2] : x[3]] for x in index.scan(text) if x[0] == "all-rights-reserved"}
