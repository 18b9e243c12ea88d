"""Searches of listings by optional predicates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.functions.labels import folded, form_number, number_of, results_header
from casona.functions.ranks import numbered
from casona.functions.storage import stored
from casona.operators.summary import unit_summary


@dataclass(frozen=True)
class ListingQuery:
    """What a search asks for; what is not set asks for nothing.

    The unit predicates hold together on one unit.  Prices are the stored ones.
    """

    text: str | None = None
    property_type: str | None = None
    city: str | None = None
    unit_type: str | None = None
    min_bathrooms: float | None = None
    min_price: float | None = None
    max_price: float | None = None
    favorites_of: int | None = None
    sort: str = "newest"

    @staticmethod
    def from_form(values: dict[str, str]) -> ListingQuery:
        """Of the texts of a form: one that is empty, or is to be a number and is none, is unset."""
        text = lambda name: values.get(name, "") or None
        number = lambda name: number_of(values.get(name, ""))
        return ListingQuery(text("text"), text("property_type"), text("city"), text("unit_type"), number("min_bathrooms"), number("min_price"), number("max_price"), sort=values.get("sort", "") or "newest")


def every(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def listing_predicate(query: ListingQuery) -> Column:
    parts = []
    if query.text and (text := folded(query.text)):
        parts.append(F.contains(F.lower("project"), F.lit(text)) | F.contains(F.lower("city"), F.lit(text)))
    if query.property_type:
        parts.append(F.col("property_type") == query.property_type)
    if query.city:
        parts.append(F.col("city") == query.city)
    return every(parts)


def unit_predicate(query: ListingQuery, field=F.col) -> Column:
    """``field``: how a unit's column is named, so that it also serves inside an array."""
    parts = []
    if query.unit_type:
        parts.append(field("type") == query.unit_type)
    if query.min_bathrooms is not None:
        parts.append(field("bathrooms") >= query.min_bathrooms)
    if query.min_price is not None:
        parts.append(field("price") >= query.min_price)
    if query.max_price is not None:
        parts.append(field("price") <= query.max_price)
    return every(parts)


def matched(listings: DataFrame, units: DataFrame, query: ListingQuery, favorites: DataFrame | None = None) -> DataFrame:
    """Listings that match.  One without units never does, whatever is asked."""
    found = listings.where(listing_predicate(query)).join(units.where(unit_predicate(query)).select("listing_id"), "listing_id", "left_semi")
    if query.favorites_of is not None:
        own = favorites.where(F.col("user_id") == query.favorites_of).select("listing_id")
        found = found.join(own, "listing_id", "left_semi")
    return found


def matched_nested(catalogue: DataFrame, query: ListingQuery) -> DataFrame:
    """The same on listings that carry their units as an array."""
    one = F.exists("units", lambda u: unit_predicate(query, lambda c: u[c]))
    return catalogue.where(listing_predicate(query) & F.coalesce(one, F.lit(False)))


def ordering(sort: str) -> list[Column]:
    """Sort keys; the catalogue's order decides last, and alone for ``newest``."""
    by = {"price-asc": [F.asc("min_price")], "price-desc": [F.desc("min_price")]}.get(sort, [])
    return [*by, F.asc("position")]


def matched_summary(listings: DataFrame, units: DataFrame, query: ListingQuery, favorites: DataFrame | None = None) -> DataFrame:
    """Matching listings with the summary of all their units, of which one must fit: units are read and grouped once."""
    summed = unit_summary(units, F.bool_or(unit_predicate(query)).alias("__fits")).where("__fits").drop("__fits")
    found = listings.where(listing_predicate(query))
    if query.favorites_of is not None:
        own = favorites.where(F.col("user_id") == query.favorites_of).select("listing_id")
        found = found.join(own, "listing_id", "left_semi")
    return found.join(summed, "listing_id")


def search(listings: DataFrame, units: DataFrame, query: ListingQuery, favorites: DataFrame | None = None) -> DataFrame:
    """Matching listings with their summary, over all their units, in order."""
    return matched_summary(listings, units, query, favorites).orderBy(*ordering(query.sort))


def ranked(found: DataFrame, sort: str, groups: int | None = None) -> DataFrame:
    """``found`` with its place in the order, from 1."""
    return numbered(found, ordering(sort), "rank", groups).withColumn("rank", F.col("rank").cast("int"))


def visibility(listings: DataFrame, found: DataFrame) -> DataFrame:
    """Every listing with ``visible``: whether it is among those found."""
    mark = found.select("listing_id").distinct().withColumn("visible", F.lit(True))
    return listings.join(mark, "listing_id", "left").withColumn("visible", F.coalesce("visible", F.lit(False)))


def header(found: DataFrame) -> DataFrame:
    """One row ``(n_listings, n_units, header)``; units are all available ones of the listings found."""
    totals = found.agg(F.count(F.lit(1)).alias("n_listings"), F.coalesce(F.sum("available"), F.lit(0)).cast("long").alias("n_units"))
    return totals.withColumn("header", results_header(F.col("n_listings"), F.col("n_units")))


#: What a request asks for, in the order of the columns of ``requests_matched``.
ASKED = ("q", "property_type", "city", "unit_type", "min_bathrooms", "min_price", "max_price")
#: Of these the ones that must be equal, and the column of the stock that each is compared with.
EQUAL = {"unit_type": "type", "property_type": "property_type", "city": "city"}
#: Parts into which units are dealt where the requests are too many to be broadcast.
PARTS = 64


def requests_of_forms(forms: DataFrame) -> DataFrame:
    """Requests of the texts of many forms, with the columns of ``requests_matched``; what is empty or no number is unset."""
    numbers = ("min_bathrooms", "min_price", "max_price")
    return forms.select("request_id", *[(form_number(F.col(c)) if c in numbers else F.nullif(F.col(c), F.lit(""))).alias(c) for c in ASKED])


def requests_matched(requests: DataFrame, listings: DataFrame, units: DataFrame, limit: int = 10_000) -> DataFrame:
    """``(request_id, n_listings, n_units)`` of many searches at once.

    ``requests``: ``request_id`` and the columns ``ASKED``; null or empty asks for
    nothing.  Equal requests are answered once.  Units, each with its listing,
    meet the requests in one join: on equal type, property type and city where
    those are asked for (a unit goes there once for each of the at most eight
    ways to ask), and all other predicates besides.  Up to ``limit`` different
    requests are broadcast; beyond, units are dealt out in ``PARTS``, each of
    which meets all requests.
    """
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    folded_text = F.nullif(F.lower(F.regexp_replace(F.col("q"), r"(?U)^\s+|\s+$", "")), F.lit(""))
    asked = requests.select("request_id", folded_text.alias("q"), *[text(c).alias(c) for c in ASKED[1:4]], *ASKED[4:])
    asked = stored(asked.withColumn("key", F.md5(F.to_json(F.struct(*ASKED)).cast("binary"))))
    way = reduce(lambda x, y: x + y, [F.when(F.col(c).isNotNull(), 1 << k).otherwise(0) for k, c in enumerate(EQUAL)])
    kinds = stored(asked.groupBy("key").agg(*[F.first(c).alias(c) for c in ASKED]).withColumns({"way": way, "kind": F.monotonically_increasing_id()}))
    few = kinds.count() <= limit
    ways = [r["way"] for r in kinds.select("way").distinct().collect()]  # eight at most
    totals = units.groupBy("listing_id").agg(F.sum("available").alias("total"))
    stock = units.select("listing_id", "type", "bathrooms", "price").join(listings.select("listing_id", F.lower("project").alias("project"), "city", F.lower("city").alias("city_folded"), "property_type"), "listing_id")
    stock = stock.withColumn("way", F.explode(F.array(*[F.lit(w) for w in ways]) if ways else F.expr("cast(array() as array<int>)")))
    # what isn't asked for is the same empty text on both sides
    met = lambda column, k: F.when(F.col("way").bitwiseAND(1 << k) > 0, F.col(column)).otherwise("")
    stock = stock.select("*", *[met(column, k).alias(f"__{k}") for k, column in enumerate(EQUAL.values())]).alias("u")
    sought = kinds.select("*", *[met(c, k).alias(f"__{k}") for k, c in enumerate(EQUAL)])
    keys = ["way", *[f"__{k}" for k in range(len(EQUAL))]]
    if not few:
        stock, keys = stock.withColumn("__part", F.pmod(F.xxhash64("listing_id"), F.lit(PARTS)).cast("int")).alias("u"), [*keys, "__part"]
        sought = sought.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    sought = (F.broadcast(sought) if few else sought).alias("r")
    bound = lambda c, test: F.col(f"r.{c}").isNull() | test
    fits = every(
        [
            *[F.col(f"u.{k}") == F.col(f"r.{k}") for k in keys],
            F.col("r.q").isNull() | F.contains("u.project", F.col("r.q")) | F.contains("u.city_folded", F.col("r.q")),
            bound("min_bathrooms", F.col("u.bathrooms") >= F.col("r.min_bathrooms")),
            bound("min_price", F.col("u.price") >= F.col("r.min_price")),
            bound("max_price", F.col("u.price") <= F.col("r.max_price")),
        ]
    )
    # what is kept of a hit is two numbers; totals come to the listings that have any
    hits = stock.join(sought, fits).select("r.kind", "u.listing_id").distinct().join(totals, "listing_id")
    counts = hits.groupBy("kind").agg(F.count(F.lit(1)).alias("n_listings"), F.sum("total").cast("long").alias("n_units"))
    counts = counts.join(kinds.select("kind", "key"), "kind").drop("kind")
    counts = stored(counts)
    every_one = asked.select("request_id", "key").join(F.broadcast(counts) if few else counts, "key", "left")
    return every_one.select("request_id", F.coalesce("n_listings", F.lit(0)).alias("n_listings"), F.coalesce("n_units", F.lit(0)).alias("n_units"))
