"""Texts by grams and many requests at once, each against single searches."""

import random

import pytest
from pyspark.sql import functions as F

from casona.functions.labels import folded
from casona.operators import requests as rq
from casona.operators import search, texts
from casona.operators.search import ListingQuery

ASKED = "request_id long, q string, property_type string, city string, unit_type string, min_bathrooms double, min_price double, max_price double"
WORDS = ["Casa", "Mar", "100%", "a_b", "Ñandú", "Öl", "del Sol", "x", "", "ÉT", "漢字"]


@pytest.fixture(scope="module")
def stock():
    rng = random.Random(4)
    listings = [(k, k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(4))) if k % 9 else None, rng.choice(["Lima, P", "Roma, I", "Öst, %"]), rng.choice(["Condo", "Villa", None])) for k in range(60)]
    units = []
    for k in range(55):
        for n in range(rng.randrange(1, 8)):
            units.append((k, n, rng.choice(["Studio", "1BR", "2BR", None]), rng.choice([0.5, 1.0, 1.5, 2.0, None]), rng.choice([None, float(rng.randrange(40)), float("nan") if k % 17 == 0 else 7.0]), rng.choice([0, 1, 3])))
    return listings, units


@pytest.fixture(scope="module")
def tables(spark, stock):
    return spark.createDataFrame(stock[0], "listing_id long, position long, project string, city string, property_type string").cache(), spark.createDataFrame(stock[1], "listing_id long, unit_seq int, type string, bathrooms double, price double, available int").cache()


def brute(stock, request):
    _, q, kind, city, unit_type, baths, low, high = request
    q = folded(q or "")
    greater = lambda a, b: a is not None and (a != a or a >= b)  # noqa: E731  not a number is the largest
    less = lambda a, b: a is not None and a == a and a <= b
    n = units = 0
    for key, _, project, town, of in stock[0]:
        if q and q not in (project or "").lower() and q not in town.lower() or kind and of != kind or city and town != city:
            continue
        own = [u for u in stock[1] if u[0] == key]
        if any((not unit_type or u[2] == unit_type) and (baths is None or greater(u[3], baths)) and (low is None or greater(u[4], low)) and (high is None or less(u[4], high)) for u in own):
            n, units = n + 1, units + sum(u[5] for u in own)
    return n, units


def random_requests(rng, n, plain=False):
    pick = lambda *x: rng.choice([None, "", *x])
    for k in range(n):
        price = lambda: rng.choice([None, float(rng.randrange(-1, 42)), rng.randrange(80) / 2])
        rest = (None,) * 5 if plain else (rng.choice([None, None, " CASA ", "a", "%", "_", "ñandú", "del sol", "öl", "xx", "éT", "漢", "   "]), pick("Condo", "Villa"), pick("Lima, P"), pick("2BR", "Studio"), rng.choice([None, 0.0, 0.7, 1.5, 9.0]))
        yield (k, *rest, price(), price())


@pytest.mark.parametrize("plain, block", [(True, 4), (False, 1024), (False, 3)])
def test_many_requests_equal_brute_force(spark, stock, tables, plain, block, monkeypatch):
    monkeypatch.setattr(rq, "BLOCK", block)
    asked = list(random_requests(random.Random(block), 300, plain))
    asked.append((300, *asked[0][1:]))
    got = rq.requests_counted(spark.createDataFrame(asked, ASKED), *tables).collect()
    assert {r["request_id"]: (r["n_listings"], r["n_units"]) for r in got} == {r[0]: brute(stock, r) for r in asked} and len(got) == len(asked)


def test_as_the_join_answers(spark, tables):
    asked = spark.createDataFrame(list(random_requests(random.Random(8), 60)), ASKED)
    named = [t.withColumns({c: F.lit("x") for c in ("at", "slot", "way", "total", "key", "block", "tops", "low", "k0", "kq", "least")}) for t in tables]
    assert sorted(rq.requests_counted(asked, *named).collect()) == sorted(search.requests_matched(asked, *tables).collect())


def test_no_requests_and_no_units(spark, tables):
    none = spark.createDataFrame([], ASKED)
    assert rq.requests_counted(none, *tables).collect() == []
    some = spark.createDataFrame(list(random_requests(random.Random(1), 9)), ASKED)
    assert {tuple(r[1:]) for r in rq.requests_counted(some, tables[0], tables[1].limit(0)).collect()} == {(0, 0)}


def test_no_join_on_a_constant_and_bounded_nodes(spark, tables):
    asked = spark.createDataFrame(list(random_requests(random.Random(2), 200, plain=True)), ASKED)
    plan = rq.requests_counted(asked, *tables)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.fixture(scope="module")
def index(tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("grams") / "index")
    texts.write_index(tables[0], folder)
    return folder


@pytest.mark.parametrize("text", ["casa", " CASA  mar", "a", "%", "_", "0%", "ñan", "Ñ", "öl", "l s", "del sol", "p", ", ", "漢字", "字", "zzz", "casa zzz", "a_b", "", "  ", "ét"])
def test_text_equals_contains(tables, index, text):
    expected = tables[0].where(search.listing_predicate(ListingQuery(text=text)))
    key = lambda df: sorted(r["listing_id"] for r in df.collect())
    assert key(texts.matched_text(tables[0], index, text)) == key(expected)


def test_many_texts(spark, stock, tables, index):
    asked = ["casa", "a", "%", "_", "del sol", "öl", "zzz", "lima, p", "", None, "casa", "漢字 "]
    got = texts.matched_texts(tables[0], index, spark.createDataFrame([(q,) for q in asked], "q string")).collect()
    assert sorted(map(tuple, got)) == sorted((q, r[0]) for q in {q for q in asked if q} for r in stock[0] if q in (r[2] or "").lower() or q in r[3].lower())


def test_a_search_reads_few_postings(spark, tmp_path):
    """The rarest gram decides how much is read, and only the files that may hold it."""
    listings = spark.range(2000).select(F.col("id").alias("listing_id"), F.concat(F.lit("casa numero "), F.lpad(F.col("id").cast("string"), 5, "0")).alias("project"), F.lit("Lima").alias("city"))
    texts.write_index(listings, str(tmp_path / "i"))
    rows, _ = texts.index_tables(spark, str(tmp_path / "i"))
    found = texts.candidates("CASA NUMERO 01234", str(tmp_path / "i"), spark)
    assert found.count() < 100 < rows.count() / 100
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram," in found._jdf.queryExecution().executedPlan().toString()
    assert texts.matched_text(listings, str(tmp_path / "i"), "CASA NUMERO 01234").count() == 1


def test_index_is_of_distinct_texts(spark, tmp_path):
    """Listings that share their texts add no rows, and a place of a text has one gram."""
    listings = spark.range(3000).select(F.col("id").alias("listing_id"), F.concat(F.lit("Casa "), (F.col("id") % 3).cast("string")).alias("project"), F.lit("Lima").alias("city"))
    folder = str(tmp_path / "i")
    texts.write_index(listings, folder)
    assert texts.index_tables(spark, folder)[0].count() == 3 * len("casa 0") + len("lima")
    asked = spark.createDataFrame([("casa",), ("a",), ("casa 1",), ("z",)], "q string")
    assert sorted(map(tuple, texts.texts_counted(listings, folder, asked).collect())) == [("a", 3000), ("casa", 3000), ("casa 1", 1000)]


def test_texts_longer_than_a_gram(spark, tmp_path):
    listings = spark.createDataFrame([(1, "residencial del sol", "Lima"), (2, "residencial del mar", "Lima"), (3, None, "residencial del sol")], "listing_id long, project string, city string")
    folder = str(tmp_path / "i")
    texts.write_index(listings, folder)
    asked = ["residencial", "encial del sol", "residencial del s", "dencial x del", "l sol"]
    expected = {("residencial", 1), ("residencial", 2), ("residencial", 3), *((q, k) for q in ("encial del sol", "residencial del s", "l sol") for k in (1, 3))}
    assert set(map(tuple, texts.matched_texts(listings, folder, spark.createDataFrame([(q,) for q in asked], "q string")).collect())) == expected
    assert {(q, r["listing_id"]) for q in asked for r in texts.matched_text(listings, folder, q).collect()} == expected


def test_hits_of_requests_are_numbers_and_totals_need_no_window(spark, tables):
    """What a task holds of a hit is a request's number and a listing; no window sorts all units for their totals."""
    plans, stored = [], search.stored
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(search, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df))
        search.requests_matched(spark.createDataFrame(list(random_requests(random.Random(3), 20)), ASKED), *tables)
    assert not any("Window" in p for p in plans) and "Aggregate [kind" in plans[-1]


def test_many_slots_equal_brute_force(spark, stock, tables, monkeypatch):
    """More slots than are broadcast meet the units in a join of equals, those that ask for nothing equal apart."""
    monkeypatch.setattr(rq, "FEW", 0)
    asked = list(random_requests(random.Random(12), 120))
    got = rq.requests_counted(spark.createDataFrame(asked, ASKED), *tables).collect()
    assert {r["request_id"]: (r["n_listings"], r["n_units"]) for r in got} == {r[0]: brute(stock, r) for r in asked}


def test_units_are_placed_once_for_all_ways_to_ask(spark, tables):
    """Units are read for their totals and for their places, not again for each kind of request."""
    plans, stored = [], rq.stored
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(rq, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df))
        rq.requests_counted(spark.createDataFrame(list(random_requests(random.Random(2), 60)), ASKED), *tables)
    assert sum("InMemoryRelation" in line and "unit_seq#" in line for line in plans[-1].splitlines()) == 2


@pytest.mark.parametrize("block, n", [(1024, 0), (1024, 1), (3, 9), (4, 50), (1024, 50)])
def test_places_are_found_by_compiled_steps(spark, block, n, monkeypatch):
    """A search of bounds is made of projections; a function of arrays would be interpreted for each unit."""
    monkeypatch.setattr(rq, "BLOCK", block)
    values, nan = [float(k) for k in range(0, 2 * n, 2)], float("nan")
    bounds = rq.Bounds(spark.createDataFrame([(v, None) for v in values], "min_price double, max_price double"))
    prices = [None, nan, -1.0, *[k / 2 for k in range(4 * n + 4)]]
    placed = bounds.placed(spark.createDataFrame([(p,) for p in prices], "price double"))
    place = lambda p: 2 * n + 1 if p is None else 2 * sum(p != p or v < p for v in values) + (p in values)
    assert sorted(map(repr, map(tuple, placed.collect()))) == sorted(repr((p, place(p))) for p in prices)
    assert "lambda" not in placed._jdf.queryExecution().optimizedPlan().toString()
