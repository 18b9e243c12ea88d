import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from casona.llm import queries, repeats

WHITE = " \t\r\n\x0b\x0c"


def unspaced(c):
    n = ord(c)
    return any(a <= n <= b for a, b in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)))


def pieces(text):
    """Character by character: ``(start, stop, words, normalised)``, by the definition and not by the code."""
    out, begin = [], 0
    for at, c in enumerate(text):
        ends = c == "\n" or c in "。！？｡" or (c in ".!?" and at + 1 < len(text) and text[at + 1] in WHITE and at > 0 and text[at - 1] not in WHITE + ".!?")
        if not ends and at + 1 < len(text):
            continue
        raw, start = text[begin : at + 1], begin
        begin = at + 1
        lower = raw.lower()
        while lower and lower[0] in WHITE + ".,;:!?\"'()[]。！？｡、，":
            lower = lower[1:]
        while lower and lower[-1] in WHITE + ".,;:!?\"'()[]。！？｡、，":
            lower = lower[:-1]
        words = ["".join(g) for blank, g in groupby(lower, lambda x: x in WHITE) if not blank]
        if words:
            first = min(k for k, x in enumerate(raw) if x not in WHITE)
            last = max(k for k, x in enumerate(raw) if x not in WHITE)
            out.append((start + first, start + last + 1, sum(max(1, sum(map(unspaced, w))) for w in words), " ".join(words)))
    return out


def later_units(rows):
    """Every occurrence of a unit but its first, in order of id and unit, as ``(place, doc_id, unit, start, stop, words, kept id)``."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    first, out = {}, []
    for k in order:
        for n, (start, stop, words, unit) in enumerate(pieces(rows[k][1] or "")):
            if unit in first:
                out.append((k, rows[k][0], n, start, stop, words, first[unit]))
            else:
                first[unit] = rows[k][0]
    return out


def slow_spans(rows):
    out, run = [], []
    for x in [*sorted(later_units(rows)), None]:
        if run and (x is None or x[0] != run[-1][0] or x[2] != run[-1][2] + 1):
            words = sum(r[5] for r in run)
            out.append((run[0][1], run[0][3], run[-1][4], len(run), words, run[0][6], words >= repeats.PASSAGE_WORDS))
            run = []
        run.append(x)
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "start", "stop", "n_units", "n_words", "kept_doc_id", "passage")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_equals_brute_force(docs, doc_rows):
    expected = slow_spans(doc_rows)
    assert expected and got(repeats.repeated_spans(docs)) == expected
    assert sum(x[3] for x in expected) == len(later_units(doc_rows))


def test_query(same_as_sql):
    same_as_sql(queries.op5_line_hash_repeats, repeats.REPEATS_SQL)


def test_edge_cases(edge, edge_rows, none):
    # one partition, so that rows with one id are in the order of the table
    assert got(repeats.repeated_spans(edge.coalesce(1))) == slow_spans(edge_rows)
    assert got(repeats.repeated_spans(none)) == [] and repeats.without_repeats(none).count() == 0


PASSAGE = "The old mill stood by the river for years. Nobody ground corn in it any more; the wheel hung still. Children came on Sundays to look for frogs. In winter the pond froze and the mill was silent. Once a year the owner came from town and walked around it slowly."


def test_passage_inside_lines_is_cut(spark, none):
    rng = random.Random(3)
    own = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40)) + "."
    rows = [(k, f"{own()} {PASSAGE if k % 2 else own()} {own()}\n{own()}", None, None, 0) for k in range(10)]
    df = spark.createDataFrame(rows, none.schema)
    assert {r[0] for r in got(repeats.repeated_spans(df)) if r[-1]} == {3, 5, 7, 9}
    for r in repeats.without_repeats(df).collect():
        before = dict((k, t) for k, t, *_ in rows)[r["doc_id"]]
        cut = "".join(c for i, c in enumerate(before) if not any(s["start"] <= i < s["stop"] for s in r["removed"]))
        assert r["text"] == cut and (PASSAGE in r["text"]) == (r["doc_id"] == 1)


def test_rows_that_share_an_id_are_cut_by_themselves(spark, none):
    rows = [(1, "First line\nown line", None, None, 0), (1, "First line\nanother line", None, None, 0), (None, "first line!\nmine", None, None, 0), (None, None, None, None, 0)]
    out = repeats.without_repeats(spark.createDataFrame(rows, none.schema).coalesce(1))
    assert sorted((r["text"] for r in out.collect()), key=repr) == sorted([rows[0][1], "\nanother line", "\nmine", None], key=repr)


def test_parameters_leave_short_runs_in(spark, none):
    line = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(0, line + ".\nYes. No. Of it", None, None, 0), (1, "x\n  " + line.upper().replace(" ", "  ") + " !\nNo", None, None, 0), (2, "Of it. Yes. No.", None, None, 0)]
    df = spark.createDataFrame(rows, none.schema)
    assert {r[0] for r in got(repeats.repeated_spans(df))} == {1, 2}
    assert [r[0] for r in got(repeats.repeated_spans(df, min_words=20))] == [1]
    assert [r[0] for r in got(repeats.repeated_spans(df, min_words=4))] == [1, 2] and [r[0] for r in got(repeats.repeated_spans(df, min_words=4, unit_words=2))] == [1]


@pytest.mark.parametrize("unit, n", [("paragraph", 2), ("line", 3), ("sentence", 4)])
def test_units(unit, n):
    assert len(list(repeats.units("A b. C d\ne f\n \n\ng", unit))) == n


def test_texts_without_blanks(spark, none):
    chinese = "这是一个没有空格的句子用来测试重复的段落是否会被删除。它还有第二个句子在后面"
    rows = [(0, f"Own words here.\nMenu\n{chinese}", None, None, 0), (2, f"Its own begin. {chinese}。", None, None, 0), (3, chinese, None, None, 0)]
    spans = got(repeats.repeated_spans(spark.createDataFrame(rows, none.schema)))
    assert [(r[0], rows[r[0] - 1][1][r[1] : r[2]], r[-1]) for r in spans] == [(2, chinese + "。", True), (3, chinese, True)]


@pytest.mark.parametrize("text", ["", "a", "\U0001f600 x. \U0001f600 y.\nz!", "No end", "Dots... here. v1.2 stays. End.", "a.. b", ". x", "\x0b\x0c q ?\r\n"])
def test_offsets(text):
    assert [(a, b, n, u.decode()) for a, b, n, u in repeats.units(text)] == pieces(text)
