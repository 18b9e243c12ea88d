"""Text and number formats of listings, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit types in their order and the label of each.
UNIT_TYPES = (("Studio", "Studio"), ("1BR", "1 Bed"), ("2BR", "2 Bed"), ("3BR", "3 Bed"), ("Land", "Land"))
# Banner colours, picked by listing id modulo 6.
PALETTE = (
    ("#0e7c86", "#0b5f68"),
    ("#2472a8", "#173f63"),
    ("#1c8c6b", "#0f5c46"),
    ("#3f6e9c", "#24466b"),
    ("#0f9aa0", "#0a6970"),
    ("#4a7fae", "#2a4f7c"),
)
# Amenities that have an icon.
ICON_AMENITIES = (
    "Pool", "Gym", "Rooftop Terrace", "Security 24/7", "Elevator", "Parking", "Coworking", "Kids Club", "BBQ Area", "Concierge",
    "Pet Friendly", "Beach Club", "Spa", "EV Charging", "Restaurant", "Golf", "Jacuzzi", "Yoga", "Tennis Court", "Marina",
)
# Square feet of a square metre, the rate that holds without a live one, how delivery texts and photo links are made.
SQFT_IN_SQM = 10.7639
FALLBACK_RATE = 18.0
DELIVERY = r"([A-Za-z]+)\.?\s+(\d{4})"
PHOTO_URL = "https://lh3.googleusercontent.com/d/"


def half_up(x: Column) -> Column:
    """Rounded to a whole number, halves towards plus infinity."""
    return F.floor(x + 0.5)


def or_else(a: Column, b: Column) -> Column:
    """``a``, unless it is null, an empty text, false, or a number that is zero or none; the text ``0`` counts."""
    number = a.try_cast("double")
    nothing = (F.typeof(a) != "string") & ((number == 0) | F.isnan(number))
    return F.when(a.isNull() | (a.cast("string") == "") | F.coalesce(nothing, F.lit(False)), b).otherwise(a)


def folded(query: str) -> str:
    """A search text without outer white space, in lower case."""
    return query.strip().lower()


NUMBER = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def number_of(text: str) -> float | None:
    """The number that a form's text says; nothing if it is empty or says none."""
    return float(text.strip()) if re.fullmatch(NUMBER, text.strip()) else None


def form_number(text: Column) -> Column:
    """The same of a column; null if there is no text, or none that is a number."""
    bare = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(bare.rlike(f"^(?:{NUMBER})$"), bare.try_cast("double"))


def page_title(project: Column, site: str) -> Column:
    return F.concat(project, F.lit(f" — {site}"))


def number_text(x: Column, pattern: str = "0.##########") -> Column:
    return F.call_function("format_number", x, F.lit(pattern))


def price_usd(usd: Column) -> Column:
    return F.concat(F.lit("US $"), number_text(usd, "#,##0.###"))


def price_mxn(usd: Column, rate: Column) -> Column:
    return F.concat(F.lit("MX $"), F.format_number(half_up(usd * rate), 0))


def money(usd: Column, rate: Column, currency: Column) -> Column:
    return F.when(currency == "MXN", price_mxn(usd, rate)).otherwise(price_usd(usd))


def range_label(low: Column, high: Column) -> Column:
    """Of two money texts, whose order is that of their prices."""
    return F.when(low == high, low).otherwise(F.concat(low, F.lit(" – "), high))


def price_range(low: Column, high: Column, rate: Column, currency: Column) -> Column:
    """One price if the bounds are equal, else both; equality is that of the stored prices."""
    a, b = money(low, rate, currency), money(high, rate, currency)
    return F.when(low == high, a).otherwise(F.concat(a, F.lit(" – "), b))


def bed_range(property_type: Column, low: Column, high: Column) -> Column:
    beds = lambda n: F.concat(n.cast("string"), F.lit(" Bed"))
    return (
        F.when(property_type == "Land", "Land")
        .when((low == 0) & (high == 0), "Studio")
        .when(low == high, beds(high))
        .otherwise(F.concat(F.when(low == 0, F.lit("Studio")).otherwise(beds(low)), F.lit(" - "), beds(high)))
    )


def size_from(low: Column) -> Column:
    feet = half_up(low * SQFT_IN_SQM * 100) / 100
    return F.concat(F.lit("From "), number_text(low), F.lit("m² / "), number_text(feet), F.lit("ft²"))


def short_delivery(text: Column) -> Column:
    """``Now`` if it is ready, ``Sep 26`` for ``Sept 2026`` or ``September. 2026``, else as it is."""
    short = F.concat(F.substring(F.regexp_extract(text, DELIVERY, 1), 1, 3), F.lit(" "), F.substring(F.regexp_extract(text, DELIVERY, 2), 3, 2))
    return F.when(text.rlike("(?i)ready"), "Now").when(text.rlike(DELIVERY), short).otherwise(text)


def initials(project: Column) -> Column:
    words = F.slice(F.filter(F.split(project, r"\s+"), lambda w: w != ""), 1, 2)
    return F.upper(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))


def photo_url(photo: Column, width: Column | int | None = None) -> Column:
    wide = F.lit(width) if width is None or isinstance(width, int) else width
    return F.concat(F.lit(PHOTO_URL), photo, F.lit("=w"), F.coalesce(F.nullif(wide.cast("int"), F.lit(0)), F.lit(800)).cast("string"))


def palette(listing_id: Column) -> tuple[Column, Column]:
    at = F.pmod(listing_id, F.lit(len(PALETTE))).cast("int")
    return tuple(F.get(F.array(*[F.lit(p[k]) for p in PALETTE]), at) for k in (0, 1))


def state_of(city: Column) -> tuple[Column, Column]:
    """City and state of ``City, State``; the state is the whole text where it is missing."""
    parts = F.split(city, ",")
    return F.trim(F.get(parts, F.lit(0))), or_else(F.trim(F.get(parts, F.lit(1))), city)


def unit_bed(unit_type: Column, bedrooms: Column) -> Column:
    return F.when(unit_type == "Land", "Land").when(bedrooms == 0, "Studio").otherwise(bedrooms.cast("string"))


def unit_bath(unit_type: Column, bathrooms: Column) -> Column:
    return F.when(unit_type == "Land", "—").otherwise(number_text(bathrooms))


def listed(labels: Column) -> Column:
    """An array of labels as ``a, b & c``."""
    return F.regexp_replace(F.array_join(labels, ", "), ",([^,]*)$", " &$1")


def results_header(listings: Column, units: Column) -> Column:
    return F.concat(listings.cast("string"), F.when(listings == 1, F.lit(" Listing / ")).otherwise(F.lit(" Listings / ")), units.cast("string"), F.lit(" Units matching your search"))


def rate_label(rate: Column, is_live: Column) -> Column:
    return F.concat(F.format_string("1 USD = %.2f MXN", rate), F.when(is_live, F.lit(" (live)")).otherwise(F.lit(" (offline estimate)")))


def placeholder_total(available: Column) -> Column:
    """Available units and a quarter more: a stand-in, as no total is known."""
    return available + half_up(available * 0.25)
