"""Golden searches and the traps of the listing semantics, on a small catalogue."""

import pytest
from pyspark.sql import functions as F

from casona.functions import labels as lb
from casona.functions.geo import haversine_km
from casona.functions.storage import checkpoint_folder
from casona.operators import detail, prep, search, summary
from casona.operators import preferences as prefs
from casona.operators.search import ListingQuery
from casona.sources import catalogue as cat
from casona.sources import fx
from casona.streaming import state

# Invented: property type, delivery, units as (type, bedrooms, bathrooms, price, size).
CATALOGUE = {
    1: ("Condo", "Ready to move in", [("1BR", 1, 1.0, 150_000, 40)]),
    2: ("Land", "Mar 2027", [("Land", 0, 0.0, 60_500, 250), ("Land", 0, 0.0, 48_000, 200)]),
    3: ("Villa", "Jun 2028", [("2BR", 2, 2.5, 310_000, 120.5), ("3BR", 3, 3.0, 295_000, 150)]),
    4: ("Condo", "Nov 2027", [("Studio", 0, 1.0, 99_000, 25), ("1BR", 1, 1.5, 140_000, 50), ("2BR", 2, 2.0, 260_000, 75.5)]),
    5: ("Condo", "Ready to move in", [("Studio", 0, 1.0, 120_000, 30), ("Studio", 0, 1.0, 120_000, 32.5)]),
    6: ("Villa", "Sept 2026", [("3BR", 3, 3.5, 900_000, 300)]),
    7: ("Condo", "TBD", [("2BR", 2, 1.0, 305_000, 80), ("2BR", 2, 2.0, 280_000, 70), ("1BR", 1, 1.0, 200_000, 55)]),
    8: ("Condo", "Dec 2026", [("1BR", 1, 1.0, 120_000, 45)]),
}
LISTINGS = "listing_id long, position long, project string, developer string, city string, lat double, lng double, delivery_date string, property_type string, amenities array<string>, photos array<string>"
UNITS = "listing_id long, unit_seq int, unit_label string, type string, bedrooms int, bathrooms double, price double, size double, available int"


@pytest.fixture(scope="module")
def listings(spark):
    rows = [(k, k, f"Casa {k}%", None, f"Ciudad {k % 5}, Estado", 20.0 + k / 100, -87.0, d, p, list("abcdefgh")[: k % 7], None if k % 3 == 0 else ["x", "y"][: k % 3]) for k, (p, d, _) in CATALOGUE.items()]
    return spark.createDataFrame(rows, LISTINGS).cache()


@pytest.fixture(scope="module")
def units(spark):
    rows = [(k, i, f"{k}-{i}" if i else "", t, b, h, float(p), float(z), 1) for k, (_, _, us) in CATALOGUE.items() for i, (t, b, h, p, z) in enumerate(us)]
    return spark.createDataFrame(rows, UNITS).cache()


def ids(df):
    return [r["listing_id"] for r in df.collect()]


def test_no_filter_finds_all(listings, units):
    found = search.search(listings, units, ListingQuery())
    assert ids(found) == list(range(1, 9))
    assert search.header(found).first()["header"] == "8 Listings / 15 Units matching your search"


def test_price_order(listings, units):
    up = ids(search.search(listings, units, ListingQuery(sort="price-asc")))
    assert up == [2, 4, 5, 8, 1, 7, 3, 6]
    assert ids(search.search(listings, units, ListingQuery(sort="price-desc"))) == [6, 3, 7, 1, 5, 8, 4, 2]
    ranked = search.ranked(search.search(listings, units, ListingQuery()), "price-asc", groups=3)
    assert {r["listing_id"]: r["rank"] for r in ranked.collect()} == {k: n for n, k in enumerate(up, 1)}


def test_ties_keep_catalogue_order(spark, listings, units):
    same = units.withColumn("price", F.lit(5.0))
    for sort in ("price-asc", "price-desc", "newest"):
        assert ids(search.search(listings, same, ListingQuery(sort=sort))) == list(range(1, 9))


def test_header_counts_all_units_of_matches(listings, units):
    found = search.search(listings, units, ListingQuery(unit_type="2BR", max_price=300000))
    assert sorted(ids(found)) == [4, 7]
    assert search.header(found).first()["n_units"] == 6
    one = search.header(search.search(listings, units, ListingQuery(unit_type="1BR", min_bathrooms=1.5))).first()
    assert one["header"] == "1 Listing / 3 Units matching your search"


def test_predicates_hold_on_one_unit(listings, units):
    assert ids(search.search(listings, units, ListingQuery(property_type="Villa", unit_type="2BR", max_price=300000))) == []
    assert ids(search.search(listings, units, ListingQuery(unit_type="1BR", min_bathrooms=1.5))) == [4]


@pytest.mark.parametrize("query", [ListingQuery(), ListingQuery(unit_type="2BR", max_price=300000), ListingQuery(min_price=500000), ListingQuery(property_type="Villa", min_bathrooms=3), ListingQuery(max_price=0)])
def test_nested_equals_flat(listings, units, query):
    nested = search.matched_nested(cat.nested(listings, units), query)
    assert sorted(ids(nested)) == sorted(ids(search.matched(listings, units, query)))


def test_text_is_literal_and_skips_the_developer(spark, listings, units):
    assert ids(search.search(listings, units, ListingQuery(text="  CASA 3%"))) == [3]
    assert ids(search.search(listings, units, ListingQuery(text="_"))) == []
    assert len(ids(search.search(listings, units, ListingQuery(text="  ")))) == 8
    assert sorted(ids(search.search(listings, units, ListingQuery(text="ciudad 1")))) == [1, 6]


def test_form():
    form = {"text": "", "property_type": "Condo", "unit_type": "", "min_bathrooms": "1.5", "min_price": "", "max_price": "0"}
    assert ListingQuery.from_form(form) == ListingQuery(property_type="Condo", min_bathrooms=1.5, max_price=0.0)
    assert ListingQuery.from_form({}) == ListingQuery()
    assert ListingQuery.from_form({"min_price": "abc", "max_price": " 1e3 "}) == ListingQuery(max_price=1000.0)


@pytest.mark.parametrize("text", ["", " ", "12", " 1.5\t", ".5", "5.", "-3e2", "abc", "1,000", "NaN", "inf", "1_0", "0x1f", "1d", None])
def test_number_of_a_form(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(lb.form_number(F.col("t"))).first()[0]
    assert got == lb.number_of(text or "") and (got is None) == (text not in ("12", " 1.5\t", ".5", "5.", "-3e2"))


def test_description_stays_without_amenities(listings):
    rows = detail.listing_text(listings.withColumn("description", F.lit("d"))).where("listing_id = 7").collect()
    assert [(r["amenity"], r["description"]) for r in rows] == [(None, "d")]


def test_zero_is_a_bound(listings, units):
    assert ids(search.search(listings, units, ListingQuery(max_price=0))) == []


def test_listing_without_units(spark, listings, units):
    few = units.where("listing_id <> 1")
    assert 1 not in ids(search.search(listings, few, ListingQuery()))
    row = summary.listing_summary(listings, few).where("listing_id = 1").first()
    assert row["available"] == 0 and row["min_price"] is None
    assert detail.gallery(listings).count() == 8


def test_summary_labels(spark, listings, units):
    rate = spark.createDataFrame([(20.0,)], "rate double")
    favorites = spark.createDataFrame([(1, 3), (1, 3), (2, 4)], "user_id long, listing_id long")
    rows = detail.with_favorite(summary.listing_summary(listings, units), favorites, 1)
    cards = {r["listing_id"]: r for r in detail.cards(rows, rate).collect()}
    assert [k for k, r in cards.items() if r["favorite"]] == [3]
    beds = {1: "1 Bed", 2: "Land", 3: "2 Bed - 3 Bed", 4: "Studio - 2 Bed", 5: "Studio", 6: "3 Bed", 7: "1 Bed - 2 Bed", 8: "1 Bed"}
    assert {k: r["beds"] for k, r in cards.items()} == beds
    feet = {1: "430.56", 2: "2152.78", 3: "1297.05", 4: "269.1", 5: "322.92", 6: "3229.17", 7: "592.01", 8: "484.38"}
    assert {k: r["size"].split(" / ")[1] for k, r in cards.items()} == {k: f"{v}ft²" for k, v in feet.items()}
    assert cards[1]["size"] == "From 40m² / 430.56ft²" and cards[1]["price"] == "From US $150,000"
    assert cards[5]["more_label"] == "+1 more amenities" and cards[4]["more_label"] == "" and cards[5]["pills"] == "a|b|c|d"
    assert cards[1]["initials"] == "C1" and cards[1]["photo"].endswith("/x=w500") and cards[3]["photo"] is None
    pins = {r["listing_id"]: r for r in detail.markers(rows, rate, "MXN").collect()}
    assert pins[6]["label"] == "Sep 26" and pins[1]["label"] == "Now" and pins[8]["label"] == "Dec 26" and pins[7]["label"] == "TBD"
    assert pins[5]["price"] == "MX $2,400,000" and pins[4]["price"] == "MX $1,980,000 – MX $5,200,000"


def test_tabs_and_unknown_types(spark, units):
    more = units.union(spark.createDataFrame([(1, 9, None, "4BR", 4, 2.0, 1.0, 1.0, 3), (1, 10, None, "Studio", 0, 1.0, 1.0, 1.0, 0)], UNITS))
    tabs = {(r["label"], r["available"]) for r in summary.unit_tabs(more).where("listing_id = 1").collect()}
    assert tabs == {("All", 4), ("1 Bed", 1), ("Studio", 0)}
    assert summary.bed_summary(more).where("listing_id = 1").first()["bed_summary"] == "Studio & 1 Bed"
    three = summary.bed_summary(units).where("listing_id = 4").first()["bed_summary"]
    assert three == "Studio, 1 Bed & 2 Bed"


def test_unit_table(spark, units):
    rate = spark.createDataFrame([(18.0,)], "rate double")
    rows = {(r["listing_id"], r["unit_seq"]): r for r in detail.unit_table(units.withColumn("available", F.lit(0)), rate).collect()}
    assert len(rows) == 15 and {r["status"] for r in rows.values()} == {"Available"}
    assert rows[2, 0]["label"] == "Land" and rows[2, 0]["bed"] == "Land" and rows[2, 0]["bath"] == "—"
    assert rows[4, 0]["bed"] == "Studio" and rows[4, 1]["bath"] == "1.5" and rows[4, 2]["bath"] == "2" and rows[4, 1]["label"] == "4-1"
    assert rows[1, 0]["size"] == "40 m²" and rows[3, 0]["size"] == "120.5 m²"
    assert detail.unit_table(units, rate, "Land", "MXN").count() == 2


def test_facts(spark, listings, units):
    row = detail.facts(summary.listing_summary(listings, units), units).where("listing_id = 4").first()
    assert row["units_line"] == "3 / 4" and row["city_part"] == "Ciudad 4" and row["state_part"] == "Estado"
    city, state_part = lb.state_of(F.lit("Alone"))
    assert spark.range(1).select(city, state_part).first() == ("Alone", "Alone")


def test_gallery(spark, listings):
    rows = {r["listing_id"]: r for r in detail.gallery(listings).collect()}
    assert rows[3]["main"] is None and rows[3]["thumbs"] == "Exterior|Interior|Amenities" and rows[3]["counter"] == ""
    assert rows[2]["main"].endswith("/x=w800") and rows[2]["thumbs"] == "y" and rows[2]["counter"] == "1 / 2"


@pytest.mark.parametrize("text, label", [("READY soon", "Now"), ("Sept. 2026", "Sep 26"), ("TBD", "TBD"), ("May  2030 or Jun 2031", "May 30")])
def test_delivery_label(spark, text, label):
    assert spark.range(1).select(lb.short_delivery(F.lit(text))).first()[0] == label


@pytest.mark.parametrize("x, text", [(1000.0, "US $1,000"), (1234567.5, "US $1,234,567.5"), (0.125, "US $0.125"), (12.0, "US $12")])
def test_price_text(spark, x, text):
    assert spark.range(1).select(lb.price_usd(F.lit(x))).first()[0] == text


def test_falsy_width_and_half_up(spark):
    row = spark.range(1).select(lb.photo_url(F.lit("a"), 0), lb.photo_url(F.lit("a")), lb.half_up(F.lit(2.5)), lb.half_up(F.lit(-2.5))).first()
    assert row[0].endswith("a=w800") and row[1].endswith("a=w800") and row[2] == 3 and row[3] == -2


def test_visibility_keeps_all(listings, units):
    rows = search.visibility(listings, search.matched(listings, units, ListingQuery(unit_type="Land"))).collect()
    assert len(rows) == 8 and [r["listing_id"] for r in rows if r["visible"]] == [2]


def test_many_requests_equal_single_ones(spark, listings, units):
    asked = [(1, None, None, None, None, None, None, None), (2, None, None, None, "2BR", None, None, 300000.0), (3, " CASA 3% ", "", "", "", None, None, None), (4, None, "Villa", None, None, 3.0, None, None), (5, None, None, None, None, None, None, 0.0), (6, None, "", None, "2BR", None, None, 300000.0), (7, None, "Villa", "Ciudad 3, Estado", "3BR", None, 1.0, None)]
    requests = spark.createDataFrame(asked, "request_id long, q string, property_type string, city string, unit_type string, min_bathrooms double, min_price double, max_price double")
    expected = {1: (8, 15), 2: (2, 6), 3: (1, 2), 4: (2, 3), 5: (0, 0), 6: (2, 6), 7: (1, 2)}
    for limit in (10_000, 2):
        rows = search.requests_matched(requests, listings, units, limit).collect()
        assert {r["request_id"]: (r["n_listings"], r["n_units"]) for r in rows} == expected


def test_rate(spark):
    ok = '{"result":"success","rates":{"MXN":%s},"time_last_update_utc":"t"}'
    rows = [(1, 1, True, ok % 17), (2, 2, True, ok % 19), (3, 3, False, ok % 20), (4, 4, True, ok % 0), (5, 5, True, '{"result":"error","rates":{"MXN":21}}'), (6, 6, True, '{"result":'), (7, 7, True, None)]
    payloads = spark.createDataFrame(rows, "event_id long, ts long, http_ok boolean, body string")
    assert fx.current_rate(payloads).first().asDict() == {"rate": 19.0, "updated_utc": "t", "is_live": True}
    fallback = fx.current_rate(payloads.where("event_id > 2")).first()
    assert fallback["rate"] == 18.0 and not fallback["is_live"]
    assert spark.range(1).select(lb.rate_label(F.lit(18.0), F.lit(False))).first()[0] == "1 USD = 18.00 MXN (offline estimate)"


def test_saved_favorites(spark):
    rows = [(1, "[]"), (2, "[1,2]"), (3, "[2,2]"), (4, '[1,"a"]'), (5, "[1,"), (6, "null"), (7, None)]
    saved = spark.createDataFrame(rows, "user_id long, body string")
    assert sorted((r[0], r[1]) for r in prefs.load_favorites(saved).collect()) == [(2, 1), (2, 2), (3, 2), (4, 1)]


TOGGLES = [(1, 1, 7, 10), (2, 2, 7, 10), (3, 3, 7, 11), (4, 4, 7, 12), (5, 5, 7, 12), (6, 6, 7, 12), (3, 3, 7, 11), (7, 0, 8, 10)]


def test_toggle_parity(spark):
    toggles = spark.createDataFrame(TOGGLES, "event_id long, ts long, user_id long, listing_id long")
    assert sorted(map(tuple, prefs.favorites_from_toggles(toggles).collect())) == [(7, 11), (7, 12), (8, 10)]
    assert {r["user_id"]: r["body"] for r in prefs.saved_texts(toggles).collect()} == {7: "[11,12]", 8: "[10]"}


def test_toggle_stream_equals_batch(spark, tmp_path):
    schema = "event_id long, ts long, user_id long, listing_id long"
    for k, row in enumerate(reversed(TOGGLES)):  # one file for each micro-batch, out of order
        late = (row[0], 1_700_000_000 + row[1], *row[2:])  # a watermark starts in 1970
        spark.createDataFrame([late], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    rows = state.run_to_end(state.favorite_changes(stream), ["user_id", "listing_id"]).where("favorite")
    assert sorted((r["user_id"], r["listing_id"]) for r in rows.collect()) == [(7, 11), (7, 12), (8, 10)]


def test_toggle_state_ends(spark, tmp_path):
    """What is kept are favorites and the pairs of recent events, not every pair ever toggled."""
    schema, day = "event_id long, ts long, user_id long, listing_id long", 86_400
    start = 1_700_000_000
    old = [(2 * k + n, start + k + n, 1, k) for k in range(40) for n in range(2)] + [(500 + k, start, 2, k) for k in range(5)]
    recent = [(900, start + 100 * day, 3, 1), (901, start + 100 * day, 3, 2), (902, start + 100 * day + 1, 3, 2), (902, start + 100 * day + 1, 3, 2)]
    for k, rows in enumerate((old, recent, [(950, start + 101 * day, 4, 1)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    progress = []
    rows = state.run_to_end(state.favorite_changes(stream, "30 days"), ["user_id", "listing_id"], progress=progress).where("favorite")
    assert sorted((r["user_id"], r["listing_id"]) for r in rows.collect()) == [(2, k) for k in range(5)] + [(3, 1), (4, 1)]
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(kept) >= 45 and kept[-1] == 5 + 3  # favorites of user 2, and three pairs with recent events


def test_pairs_share_keys_of_state(spark, tmp_path, monkeypatch):
    """Many pairs in one call, missing users apart from others, large ids as they are."""
    monkeypatch.setattr(state, "BUCKETS", 2)
    schema, start, large = "event_id long, ts long, user_id long, listing_id long", 1_700_000_000, 2**60 + 1
    rows = [(k, start + k, large + k % 50, 7) for k in range(150)] + [(500, start, None, 7), (501, start, 3, None), (501, start, 3, None)]
    for k in range(3):
        spark.createDataFrame(rows[k::3], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    progress = []
    found = state.run_to_end(state.favorite_changes(stream), ["user_id", "listing_id"], progress=progress).where("favorite")
    assert set(map(tuple, found.select("user_id", "listing_id").collect())) == {(large + k, 7) for k in range(50)} | {(None, 7), (3, None)}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]) <= 2


def test_rate_and_choice_streams(spark, tmp_path):
    ok = '{"result":"success","rates":{"MXN":%s},"time_last_update_utc":"t"}'
    schema = "event_id long, ts long, http_ok boolean, body string"
    spark.createDataFrame([(1, 5, True, ok % 17), (2, 2, True, ok % 19)], schema).write.parquet(str(tmp_path / "fx"))
    got = state.run_to_end(state.last_rates(spark.readStream.schema(schema).parquet(str(tmp_path / "fx"))), [])
    assert got.first()["x"]["rate"] == 17.0
    chosen = "event_id long, ts long, user_id long, currency string"
    spark.createDataFrame([(1, 5, 1, "MXN"), (2, 2, 1, "USD"), (3, 1, 2, "EUR")], chosen).write.parquet(str(tmp_path / "c"))
    last = state.run_to_end(state.last_choices(spark.readStream.schema(chosen).parquet(str(tmp_path / "c"))), ["user_id"])
    assert {r["user_id"]: r["last"] for r in last.collect()} == {1: "MXN", 2: "EUR"}


def test_currency(spark):
    rows = [(1, 1, 1, "USD"), (2, 2, 1, "MXN"), (3, 3, 1, "MXN"), (4, 4, 2, "MXN"), (5, 5, 2, "EUR")]
    choices = spark.createDataFrame(rows, "event_id long, ts long, user_id long, currency string")
    assert {r[0]: r[1] for r in prefs.current_currency(choices).collect()} == {1: "MXN", 2: "USD"}
    assert sorted(r["event_id"] for r in prefs.currency_changes(choices).collect()) == [2, 4, 5]


def test_page_requests(spark, listings):
    urls = ["https://e.org/d?id=3", "https://e.org/d?id=99", "https://e.org/d", "https://e.org/d?id=abc", "https://e.org/d?id=", "https://e.org/d?id=4&id=5", "::bad::"]
    requests = spark.createDataFrame(list(enumerate(urls)), "request_id long, url string")
    rows = {r["request_id"]: r for r in detail.requested(requests, listings).collect()}
    assert {k for k, r in rows.items() if r["found"]} == {0, 5} and rows[5]["id"] == 4 and rows[2]["id"] == 0 and rows[3]["id"] is None


def test_price_list(spark):
    rows = [(1, "a", "DISPONIBLE", 1800.0, "MXN"), (1, "b", " available ", 77.0, "USD"), (1, "c", "SOLD", 1.0, "USD"), (1, "d", None, 1.0, "USD")]
    raw = spark.createDataFrame(rows, "listing_id long, unit_label string, status string, price double, currency string")
    assert {r["unit_label"]: r["price"] for r in prep.available_units(raw).collect()} == {"a": 100.0, "b": 77.0}
    names = spark.createDataFrame([("A",), (" ",), (None,)], "d string").select(prep.developer_name(F.col("d")))
    assert [r[0] for r in names.collect()] == ["A", prep.UNKNOWN_DEVELOPER, prep.UNKNOWN_DEVELOPER]


def test_snapshot_diff(spark):
    schema = "listing_id long, unit_label string, price double"
    before = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "c", None), (1, "d", None)], schema)
    after = spark.createDataFrame([(1, "b", 3.0), (1, "c", None), (1, "d", 4.0), (1, "e", 5.0)], schema)
    assert {r["unit_label"]: r["change"] for r in prep.snapshot_diff(before, after).collect()} == {"a": "removed", "b": "price-changed", "d": "price-changed", "e": "added"}


def test_distance(spark):
    km = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).first()
    assert km[0] == pytest.approx(111.195, abs=1e-3) and km[1] == pytest.approx(20015.11, abs=0.1)


def test_grid_finds_what_all_pairs_find(spark):
    import random

    rng = random.Random(1)
    places = [(k, rng.uniform(-89, 89), rng.uniform(-180, 180)) for k in range(150)] + [(900, 89.9, 10.0), (901, 0.0, 179.99), (902, 0.0, -179.99)]
    marks = [(c, f"{c}{k}", rng.uniform(-89, 89), rng.uniform(-180, 180)) for c in "ab" for k in range(60)] + [("c", "only", 10.0, 170.0)]
    listings = spark.createDataFrame(places, "listing_id long, lat double, lng double")
    landmarks = spark.createDataFrame(marks, "category string, name string, lat double, lng double")
    key = lambda df: sorted((r["listing_id"], r["category"], r["name"], r["distance_km"]) for r in df.collect())
    assert key(prep.nearest_by_grid(listings, landmarks)) == key(prep.nearest_landmarks(listings, landmarks))


def test_missing_coordinates_poles_and_the_date_line(spark, monkeypatch):
    none, bad = None, float("nan")
    places = [(1, none, 1.0), (2, 1.0, none), (3, bad, 1.0), (4, 90.0, 0.0), (5, -90.0, 77.0), (6, 0.0, 180.0), (7, 0.0, -180.0), (8, 45.0, 179.999), (9, 89.99, -120.0)]
    marks = [("a", "none", none, 1.0), ("a", "bad", 1.0, bad), ("a", "north", 90.0, 50.0), ("a", "near north", 89.0, 170.0), ("a", "south", -90.0, -10.0), ("a", "east", 0.0, 180.0), ("a", "west", 0.1, -179.9), ("a", "cross", 45.0, -179.99), ("b", "one", none, none)]
    listings, landmarks = spark.createDataFrame(places, "listing_id long, lat double, lng double"), spark.createDataFrame(marks, "category string, name string, lat double, lng double")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    near = key(prep.nearest_landmarks(listings, landmarks))
    assert near == key(prep.nearest_by_grid(listings, landmarks)) and {r[0]: r[2] for r in near} == {4: "north", 5: "south", 6: "east", 7: "east", 8: "cross", 9: "north"}
    monkeypatch.setattr(prep, "BROADCAST_LANDMARKS", 3)
    assert near == key(prep.nearest_landmarks(listings, landmarks))
    assert spark.range(1).select(haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0))).first()[0] is None


@pytest.mark.parametrize("a, taken", [("'0'", True), ("''", False), ("'x'", True), ("cast(null as string)", False), ("0.0D", False), ("0", False), ("-0.0D", False), ("0.5D", True), ("double('NaN')", False), ("cast(0 as decimal(9,2))", False), ("true", True), ("false", False)])
def test_falsy_by_type(spark, a, taken):
    row = spark.sql(f"select {a} as a").select(lb.or_else(F.col("a"), F.lit(None)).alias("x"), "a").first()
    assert (row["x"] is not None) == taken and (not taken or row["x"] == row["a"])


def test_grid_reads_landmarks_once_a_step(spark):
    listings = spark.createDataFrame([(1, 20.0, -87.0)], "listing_id long, lat double, lng double")
    landmarks = spark.createDataFrame([("a", f"m{k}", 20.0 + k / 50, -87.0) for k in range(40)], "category string, name string, lat double, lng double")
    plan = prep.nearest_by_grid(listings, landmarks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 6 and prep.nearest_by_grid(listings, landmarks).first()["name"] == "m0"


def test_listings_in_one_place_meet_few_landmarks(spark, monkeypatch):
    monkeypatch.setattr(prep, "BROADCAST_LANDMARKS", 3)
    listings = spark.range(50).select(F.col("id").alias("listing_id"), F.lit(20.5).alias("lat"), (F.lit(-87.0) + F.col("id") / 1000).alias("lng"))
    far = [("far", f"f{k}", 50.0 + k % 7 / 10, 10.0 + k / 10) for k in range(30)]
    landmarks = spark.createDataFrame([("near", f"n{k}", 20.0 + k / 50, -87.0) for k in range(40)] + far, "category string, name string, lat double, lng double")
    key = lambda df: sorted(map(tuple, df.collect()))
    found = key(prep.nearest_landmarks(listings, landmarks))
    monkeypatch.setattr(prep, "BROADCAST_LANDMARKS", 10_000)
    assert len(found) == 100 and found == key(prep.nearest_landmarks(listings, landmarks))


def test_prices_keep_the_fallback_without_a_valid_rate(spark, tmp_path):
    schema = "event_id long, ts long, http_ok boolean, body string"
    ok = '{"result":"success","rates":{"MXN":%s},"time_last_update_utc":"t"}'
    prices = spark.createDataFrame([(1, 10.0)], "listing_id long, min_price double")
    for name, body, rate in (("none", ok % 0, 18.0), ("one", ok % 17.5, 17.5)):
        spark.createDataFrame([(1, 5, True, body)], schema).write.parquet(str(tmp_path / name))
        rows = state.prices_at_rates(spark.readStream.schema(schema).parquet(str(tmp_path / name)), prices).collect()
        assert [(r["listing_id"], r["rate"]) for r in rows] == [(1, rate)]


def test_a_rate_writes_no_prices_and_goes_on(spark, tmp_path):
    schema = "event_id long, ts long, http_ok boolean, body string"
    ok = '{"result":"success","rates":{"MXN":%s},"time_last_update_utc":"t"}'
    prices = spark.range(1000).withColumn("price", F.lit(2.0))
    for k, rate in enumerate((17.0, 19.0, 18.5)):
        spark.createDataFrame([(k, 5 - 3 * (k == 2), True, ok % rate)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        rows = state.prices_at_rates(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), prices, str(tmp_path / "rates"))
        assert rows.select("rate").distinct().collect() == [(19.0 if k else 17.0,)] and rows.count() == 1000
    assert spark.read.parquet(str(tmp_path / "rates/rows")).count() <= 3


def test_order_of_a_catalogue_is_that_of_its_files(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    for name, ids_of in (("a.json", (9, 2, 5)), ("b.json", (1, 8))):
        (tmp_path / "lines" / name).write_text("".join(f'{{"id": {k}, "units": []}}\n' for k in ids_of))
    (tmp_path / "array.json").write_text('[{"id": 9}, {"id": 2},\n {"id": 5}]')
    for path, multiline, order in (("lines", False, [9, 2, 5, 1, 8]), ("array.json", True, [9, 2, 5])):
        rows = cat.listings_of(cat.read_json(spark, str(tmp_path / path), multiline)).orderBy("position").collect()
        assert [r["listing_id"] for r in rows] == order and [r["position"] for r in rows] == list(range(1, len(order) + 1))
    with pytest.raises(ValueError, match="position"):
        cat.listings_of(spark.createDataFrame([(1,)], "id long"))


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_folder(Session())


def test_nested_catalogue(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"id": 1, "project": "A", "city": "B, C", "amenities": ["x"], "units": [{"unitLabel": "u", "type": "1BR", "bedrooms": 1, "bathrooms": 1, "price": 5, "size": 2, "available": 3}], "pointsOfInterest": [{"label": "Airport", "name": "N", "distanceKm": 1.5}]}\n{"id": 2, "units": []}\n')
    catalogue = cat.read_json(spark, str(tmp_path / "c.json"))
    cat.write_flat(catalogue, str(tmp_path / "flat"), buckets=2)
    flat = {n: spark.read.parquet(str(tmp_path / "flat" / n)) for n in ("listings", "units", "listing_poi")}
    assert {k: v.count() for k, v in flat.items()} == {"listings": 2, "units": 1, "listing_poi": 1}
    assert detail.poi_rows(flat["listing_poi"]).first()["distance"] == "1.5 km"
    again = cat.nested(flat["listings"], flat["units"]).orderBy("listing_id").collect()
    assert again[0]["units"][0]["price"] == 5.0 and again[1]["units"] == []
