"""Preparation of price lists, distances and monthly changes."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.functions.geo import EARTH_KM, haversine_km
from casona.functions.labels import FALLBACK_RATE, half_up
from casona.functions.storage import stored

AVAILABLE = ("DISPONIBLE", "AVAILABLE")
UNKNOWN_DEVELOPER = "Developer not confirmed"
#: Landmarks up to which every listing is compared with every landmark, the landmarks being broadcast.
BROADCAST_LANDMARKS = 10_000
#: What a computed distance may be off.
ROUNDING_KM = 1e-6


def available_units(raw: DataFrame) -> DataFrame:
    """Units that the list marks as available, priced in whole USD at the fixed rate."""
    usd = F.when(F.col("currency") == "MXN", half_up(F.col("price") / FALLBACK_RATE).cast("double")).otherwise(F.col("price"))
    return raw.where(F.upper(F.trim("status")).isin(*AVAILABLE)).withColumn("price", usd).drop("status", "currency")


def developer_name(developer: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(developer), F.lit("")), F.lit(UNKNOWN_DEVELOPER))


def located(rows: DataFrame) -> DataFrame:
    """Rows with both coordinates."""
    return rows.where(is_number("lat") & is_number("lng"))


def is_number(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))


def nearest_of(pairs: DataFrame) -> DataFrame:
    best = pairs.groupBy("listing_id", "category").agg(F.min_by(F.struct("name", "km"), F.struct("km", "name")).alias("x"))
    return best.select("listing_id", "category", "x.name", (half_up(F.col("x.km") * 10) / 10).alias("distance_km"))


def nearest_landmarks(listings: DataFrame, landmarks: DataFrame) -> DataFrame:
    """``(listing_id, category, name, distance_km)``: the nearest landmark of each category, to 0.1 km; ties by name.

    What lacks a coordinate, or has one that is no number, is left out, on either
    side.  Few landmarks are broadcast, all of a category as one row, and each
    listing looks through them where it is; of more only near ones are met.
    """
    listings, landmarks = located(listings), located(landmarks)
    if landmarks.limit(BROADCAST_LANDMARKS + 1).count() > BROADCAST_LANDMARKS:
        return nearest_by_grid(listings, landmarks)
    marks = landmarks.groupBy("category").agg(F.collect_list(F.struct("name", "lat", "lng")).alias("marks"))
    to_each = F.transform("marks", lambda m: F.struct(haversine_km(F.col("lat"), F.col("lng"), m["lat"], m["lng"]).alias("km"), m["name"].alias("name")))
    best = listings.select("listing_id", "lat", "lng").crossJoin(F.broadcast(marks)).withColumn("x", F.array_min(to_each))
    return best.select("listing_id", "category", "x.name", (half_up(F.col("x.km") * 10) / 10).alias("distance_km"))


def cells_of(marks: DataFrame, ratio: int, parent: int | None) -> DataFrame:
    """``(category, y, x, up_y, up_x, rep_lat, rep_lng)``: the cells that are ``ratio`` finest ones wide, one landmark of each, and the cell of ``parent`` finest ones in which it lies."""
    at = [F.floor(F.col(c) / ratio).alias(n) for c, n in (("fine_y", "y"), ("fine_x", "x"))]
    up = [F.floor(F.col(c) * ratio / (parent or ratio)).alias(n) for c, n in (("y", "up_y"), ("x", "up_x"))]
    reps = marks.groupBy("category", *at).agg(F.min(F.struct("mark_lat", "mark_lng")).alias("rep"))
    return reps.select("category", "y", "x", *up, F.col("rep.mark_lat").alias("rep_lat"), F.col("rep.mark_lng").alias("rep_lng"))


def nearest_by_grid(listings: DataFrame, landmarks: DataFrame, finest: float = 0.05, ratios: tuple[int, ...] = (900, 180, 36, 6, 1)) -> DataFrame:
    """The same by grid cells, for any number of landmarks.

    A listing starts with the widest cells that hold a landmark of a category,
    and goes down to the cells within them.  At each step it keeps those that may
    hold the nearest one: whose nearest point isn't farther than the nearest of
    the landmarks that stand for the cells.  In the finest cells that are left
    it meets the landmarks themselves.  ``finest``: degrees; ``ratios``: how many
    of the finest cells the cells of each step are wide.
    """
    listings, landmarks = located(listings), located(landmarks)
    placed = [F.floor(F.col(c) / finest).alias(n) for c, n in (("lat", "fine_y"), ("lng", "fine_x"))]
    marks = stored(landmarks.select("category", "name", F.col("lat").alias("mark_lat"), F.col("lng").alias("mark_lng"), *placed))
    here = listings.select("listing_id", "lat", "lng")
    left: DataFrame | None = None
    for step, ratio in enumerate(ratios):
        cells = cells_of(marks, ratio, ratios[step - 1] if step else None)
        few = cells.limit(BROADCAST_LANDMARKS + 1).count() <= BROADCAST_LANDMARKS
        cells = F.broadcast(cells) if few else cells
        if left is None:
            met = here.crossJoin(cells)  # every category is asked of every listing, and there are some dozens of the widest cells
        else:
            met = left.withColumnsRenamed({"y": "up_y", "x": "up_x"}).join(cells, ["category", "up_y", "up_x"])
        degrees = finest * ratio
        centre = [(F.col(c) + 0.5) * degrees for c in ("y", "x")]
        reach = EARTH_KM * math.radians(degrees) / math.sqrt(2)  # no place of a cell is farther from its centre
        nearest = F.min(haversine_km(F.col("lat"), F.col("lng"), F.col("rep_lat"), F.col("rep_lng"))).over(W.partitionBy("listing_id", "category"))
        least = haversine_km(F.col("lat"), F.col("lng"), *centre) - reach
        left = met.withColumn("km", nearest).where(least <= F.col("km") + ROUNDING_KM).select("listing_id", "lat", "lng", "category", "y", "x")
    met = left.join(marks.withColumnsRenamed({"fine_y": "y", "fine_x": "x"}), ["category", "y", "x"])
    return nearest_of(met.withColumn("km", haversine_km(F.col("lat"), F.col("lng"), F.col("mark_lat"), F.col("mark_lng"))))


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(listing_id, unit_label, change, old_price, new_price)`` between two price lists; unchanged units are left out, a missing key is a key."""
    key = ["listing_id", "unit_label"]
    a = before.select(*key, F.col("price").alias("old_price"), F.lit(1).alias("old")).alias("a")
    b = after.select(*key, F.col("price").alias("new_price"), F.lit(1).alias("new")).alias("b")
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key]), "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(~F.col("old_price").eqNullSafe(F.col("new_price")), "price-changed")
    own = [F.when(F.col("old").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in key]
    return both.withColumn("change", change).where("change is not null").select(*own, "change", "old_price", "new_price")
