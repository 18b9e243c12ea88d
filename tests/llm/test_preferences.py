from casona.llm import preferences as pf
from casona.llm import queries

SCHEMA = "pair long, turn long, role string, text string, turns string, good string"


def render(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def slow(good, bad):
    p = 0
    while p < min(len(good), len(bad)) and good[p] == bad[p]:
        p += 1
    out = [p, render(good[:p]), render(good[p:]), render(bad[p:])]
    for side in (good[p:], bad[p:]):
        trained = [f"{t}<|im_end|>" for r, t in side if r == "assistant"]
        out.append(trained)
    return out


PAIRS = {
    1: ([("system", "s"), ("user", "q"), ("assistant", "yes")], [("system", "s"), ("user", "q"), ("assistant", "no way")]),
    2: ([("user", "a"), ("assistant", "b")], [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]),
    3: ([("user", "a")], [("user", "a")]),
    4: ([("user", "x"), ("assistant", "1")], [("user", "y"), ("assistant", "1")]),
    5: ([("user", ""), ("assistant", "é\U0001f600 漢")], [("user", ""), ("assistant", "z" * 200_000)]),
    6: ([("assistant", "b"), ("user", "a")], [("user", "a"), ("assistant", "b")]),
}


def tables(spark, pairs):
    rows = [[(k, n, r, t, "c", "c") for k, p in pairs.items() for n, (r, t) in enumerate(p[side])] for side in (0, 1)]
    return [spark.createDataFrame(r, SCHEMA) for r in rows]


def test_equals_brute_force(spark):
    good, bad = tables(spark, PAIRS)
    found = {r["pair"]: r for r in pf.preference_pairs(good.union(good), bad, "pair").collect()}  # rows that repeat count once
    assert set(found) == set(PAIRS)
    for k, (a, b) in PAIRS.items():
        r = found[k]
        trained = [[r[c][s["start"] : s["stop"]] for s in r[f"{c}_mask"]] for c in ("chosen", "rejected")]
        assert [r["prefix_turns"], r["prompt"], r["chosen"], r["rejected"], *trained] == slow(a, b)
    assert {k for k, r in found.items() if r["usable"]} == {1, 4, 5, 6}


def test_nulls_and_missing_sides(spark):
    rows = [(1, 0, None, "t", "", ""), (1, 1, "assistant", None, "", ""), (None, 0, "user", "x", "", ""), (2, None, "user", "x", "", ""), (3, 0, "user", "x", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = pf.preference_pairs(df, df.where("pair is null or pair < 3"), "pair").collect()
    assert [(r["pair"], r["prefix_turns"], r["prompt"]) for r in found] == [(1, 2, render([("", "t"), ("assistant", "")]))]
    assert pf.preference_pairs(df.where("false"), df, "pair").count() == 0


def test_query(same_as_sql):
    same_as_sql(queries.op8_preference_pairs, pf.PREFERENCES_SQL)


def test_turns_that_share_a_number(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "mine"), (1, 1, "user", "and?"), (2, 0, "assistant", "theirs"), (3, 0, "user", "alone"), (3, 0, "user", "alone"), (5, 1, None, None), (None, 0, "assistant", "x")]
    found = {r["conv_id"]: r for r in pf.swapped_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    user, mine = ("user", "q"), ("assistant", "mine")
    assert set(found) == {1, 2, 3, 5}
    assert found[1]["prompt"] == render([user]) and found[1]["chosen"] == render([mine, ("user", "and?")]) and found[1]["rejected"] == render([("assistant", "theirs")])
    assert found[2]["rejected"] == render([("assistant", "")]) and found[3]["prompt"] == render([("user", "alone")]) and not found[3]["usable"]
