"""Cards, markers and the tables of one listing's page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casona.functions import labels as lb
from casona.operators.summary import bed_summary

SHOWN_AMENITIES = 4


def with_favorite(listings: DataFrame, favorites: DataFrame, user_id: int) -> DataFrame:
    """``favorite``: whether the user has the listing."""
    own = favorites.where(F.col("user_id") == user_id).select("listing_id").distinct().withColumn("favorite", F.lit(True))
    return listings.join(own, "listing_id", "left").withColumn("favorite", F.coalesce("favorite", F.lit(False)))


def amenity_pills(listings: DataFrame, expanded: bool = False) -> DataFrame:
    """``shown``, ``remaining`` and the text of the button that shows more or less."""
    size = F.coalesce(F.size(F.coalesce("amenities", F.array().cast("array<string>"))), F.lit(0))
    shown = F.coalesce(F.col("amenities"), F.array().cast("array<string>"))
    shown = shown if expanded else F.slice(shown, 1, SHOWN_AMENITIES)
    remaining = F.lit(0) if expanded else F.greatest(size - SHOWN_AMENITIES, F.lit(0))
    less = F.when(size > SHOWN_AMENITIES, "Show less").otherwise("") if expanded else F.lit("")
    more = F.when(remaining > 0, F.concat(F.lit("+"), remaining.cast("string"), F.lit(" more amenities"))).otherwise(less)
    return listings.withColumns({"shown": shown, "remaining": remaining, "more_label": more})


def listing_text(listings: DataFrame) -> DataFrame:
    """``(listing_id, seq, amenity, description)``: all amenities in order beside the description; one row where there are none."""
    return listings.select("listing_id", "description", F.posexplode_outer("amenities").alias("seq", "amenity"))


def amenity_icons(listings: DataFrame) -> DataFrame:
    """``(listing_id, seq, amenity, has_icon)``."""
    known = F.array(*[F.lit(a) for a in lb.ICON_AMENITIES])
    rows = listings.select("listing_id", F.posexplode("amenities").alias("seq", "amenity"))
    return rows.withColumn("has_icon", F.array_contains(known, F.col("amenity")))


def cards(summary: DataFrame, rate: DataFrame, currency: str = "USD") -> DataFrame:
    """The card of each listing of ``summary`` (with ``favorite``, ``amenities`` and ``photos``), at the one ``rate``."""
    x = amenity_pills(summary).crossJoin(F.broadcast(rate.select("rate")))
    first = F.get("photos", F.lit(0))
    colours = lb.palette(F.col("listing_id"))
    return x.select(
        "listing_id",
        "position",
        F.concat(F.col("available").cast("string"), F.lit(" units available")).alias("header"),
        lb.initials(F.col("project")).alias("initials"),
        F.when(F.nullif(first, F.lit("")).isNotNull(), lb.photo_url(first, 500)).alias("photo"),
        colours[0].alias("colour_from"),
        colours[1].alias("colour_to"),
        "property_type",
        "favorite",
        "delivery_date",
        "project",
        F.concat(F.lit("From "), lb.money(F.col("min_price"), F.col("rate"), F.lit(currency))).alias("price"),
        lb.bed_range(F.col("property_type"), F.col("min_bedrooms"), F.col("max_bedrooms")).alias("beds"),
        lb.size_from(F.col("min_size")).alias("size"),
        F.concat("city", F.lit(", Mexico")).alias("address"),
        F.array_join("shown", "|").alias("pills"),
        "remaining",
        "more_label",
    )


def markers(summary: DataFrame, rate: DataFrame, currency: str = "USD") -> DataFrame:
    """Every listing's marker: place, short delivery label, and what its popup says."""
    x = summary.crossJoin(F.broadcast(rate.select("rate")))
    return x.select(
        "listing_id",
        "lat",
        "lng",
        lb.short_delivery(F.col("delivery_date")).alias("label"),
        "project",
        lb.price_range(F.col("min_price"), F.col("max_price"), F.col("rate"), F.lit(currency)).alias("price"),
        F.concat(F.lit("detail.html?id="), F.col("listing_id").cast("string")).alias("link"),
    )


def unit_rows(units: DataFrame) -> DataFrame:
    """A row for each unit; its label falls back to its type."""
    return units.select("listing_id", "unit_seq", lb.or_else(F.col("unit_label"), F.col("type")).alias("label"), "type", "bedrooms", "bathrooms", "size", "price")


def unit_table(units: DataFrame, rate: DataFrame, unit_type: str | None = None, currency: str = "USD") -> DataFrame:
    """The table of units as text, all or of one type."""
    rows = unit_rows(units if unit_type is None else units.where(F.col("type") == unit_type)).crossJoin(F.broadcast(rate.select("rate")))
    return rows.select(
        "listing_id",
        "unit_seq",
        "label",
        lb.unit_bed(F.col("type"), F.col("bedrooms")).alias("bed"),
        lb.unit_bath(F.col("type"), F.col("bathrooms")).alias("bath"),
        F.concat(lb.number_text(F.col("size")), F.lit(" m²")).alias("size"),
        lb.money(F.col("price"), F.col("rate"), F.lit(currency)).alias("price"),
        F.lit("Available").alias("status"),
    )


def poi_rows(poi: DataFrame) -> DataFrame:
    return poi.select("listing_id", "seq", "label", "name", F.concat(lb.number_text(F.col("distance_km")), F.lit(" km")).alias("distance"))


def facts(summary: DataFrame, units: DataFrame) -> DataFrame:
    """City line, available and (placeholder) total units, type, beds and delivery lines."""
    x = summary.join(bed_summary(units), "listing_id", "left")
    city, state = lb.state_of(F.col("city"))
    total = lb.placeholder_total(F.col("available")).cast("long")
    return x.select(
        "listing_id",
        city.alias("city_part"),
        state.alias("state_part"),
        F.concat(F.col("city"), F.lit(", Mexico")).alias("city_line"),
        F.concat(F.col("available").cast("string"), F.lit(" / "), total.cast("string")).alias("units_line"),
        total.alias("total_units_placeholder"),
        "property_type",
        F.coalesce("bed_summary", F.lit("")).alias("bed_summary"),
        F.concat(F.lit("Available · Earliest Delivery: "), "delivery_date").alias("status_line"),
        F.concat(F.lit("✓ Phase 1: Delivery "), "delivery_date").alias("phase_line"),
    )


def gallery(listings: DataFrame) -> DataFrame:
    """Main photo, up to three more, and the counter; captions where there is no photo."""
    n = F.coalesce(F.size(F.coalesce("photos", F.array().cast("array<string>"))), F.lit(0))
    captions = F.array(*[F.lit(c) for c in ("Exterior", "Interior", "Amenities")])
    thumbs = F.when(n > 0, F.slice("photos", 2, 3)).otherwise(captions)
    return listings.select(
        "listing_id",
        F.when(n > 0, lb.photo_url(F.get("photos", F.lit(0)))).alias("main"),
        F.array_join(thumbs, "|").alias("thumbs"),
        F.when(n > 0, F.concat(F.lit("1 / "), n.cast("string"))).otherwise("").alias("counter"),
    )


def requested(requests: DataFrame, listings: DataFrame) -> DataFrame:
    """``(request_id, id, project, found)``: the listing that each page request names by the first ``id`` of its URL.

    No id counts as 0, one that is no number names nothing.
    """
    query = F.expr("try_parse_url(url, 'QUERY')")
    text = F.expr("try_parse_url(url, 'QUERY', 'id')")
    has = F.coalesce(query.rlike("(^|&)id="), F.lit(False))
    asked = requests.withColumn("id", F.when(~has | (F.coalesce(text, F.lit("")) == ""), 0.0).otherwise(text.try_cast("double")))
    keyed = listings.select(F.col("listing_id").cast("double").alias("id"), "project")
    return asked.join(keyed, "id", "left").select("request_id", "id", "project", F.col("project").isNotNull().alias("found"))
