"""Counts of very many search requests at once, without a request meeting each unit.

What requests ask for is an index.  The bounds of prices that occur in any
request cut the prices into cells, numbered in order, and a request asks for a
run of cells.  Requests that agree on all else (what must be equal, the text, the
least number of bathrooms) share a slot, and a unit goes to the slots that it
fits.  Within a slot a listing is a row of cells; of those that a request asks
for, the first one has its predecessor before the run.  So a listing is counted
once, by pairs of a cell and the cell before it in the same listing, and the
number of listings, or of their units, is the sum over the pairs that begin
before the run and end in it.

These sums come from nodes of a radix tree over the first of both cells: a pair
is in one node of each level, a request asks for a few nodes of each, and within
a node a running sum over the second cell answers it.  How much a node holds is
bounded by the number of bounds in the requests, however many units there are.
"""

from __future__ import annotations

import uuid
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.functions.ranks import numbered
from casona.functions.storage import checkpoint_folder, stored
from casona.operators import texts
from casona.operators.search import ASKED, EQUAL

#: Bits of a digit of the radix tree; bounds of a block; slots up to which they are broadcast.
DIGIT, BLOCK, FEW = 4, 1_024, 10_000
#: Bits of a way to ask: one for each column that must be equal, and one for the text.
TEXT = 1 << len(EQUAL)
KEYS = [*(f"k{n}" for n in range(len(EQUAL))), "kq"]


def normal_requests(requests: DataFrame) -> DataFrame:
    """Requests with ``key``, the same for equal ones; texts are folded, empty ones null."""
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    folded_text = F.nullif(F.lower(F.regexp_replace(F.col("q"), r"(?U)^\s+|\s+$", "")), F.lit(""))
    asked = requests.select("request_id", folded_text.alias("q"), *[text(c).alias(c) for c in ASKED[1:4]], *[F.col(c).cast("double").alias(c) for c in ASKED[4:]])
    return stored(asked.withColumn("key", F.md5(F.to_json(F.struct(*ASKED)).cast("binary"))))


def below(rows: DataFrame, name: str, values: str, x: str, most: int) -> DataFrame:
    """``rows`` with ``name``: how many numbers of the sorted array ``values``, of ``most`` or fewer, are less than ``x``.

    A projection for each step of the search: these are compiled, functions of arrays are not.
    """
    rows = rows.withColumn(name, F.lit(0))
    for step in (1 << k for k in reversed(range(most.bit_length()))):
        at = F.col(name)
        rows = rows.withColumn(name, F.when(F.get(F.col(values), at + (step - 1)) < F.col(x), at + step).otherwise(at))
    return rows


class Bounds:
    """The bounds of prices that occur in requests, in order, in blocks.

    A price has an odd place at a bound, an even one between two, and the last
    one, ``last``, if it is null.
    """

    def __init__(self, kinds: DataFrame) -> None:
        values = kinds.select(F.explode(F.array("min_price", "max_price")).alias("value")).where("value is not null").distinct()
        self.values = stored(numbered(values, [F.col("value")], "nth"))
        self.count = self.values.count()
        self.last = 2 * self.count + 1
        block = F.floor((F.col("nth") - 1) / BLOCK)
        self.blocks = stored(self.values.groupBy(block.alias("__block")).agg(F.sort_array(F.collect_list("value")).alias("__values")))
        # one row: the first number of each block
        self.tops = self.blocks.agg(F.sort_array(F.collect_list(F.get("__values", F.lit(0)))).alias("__tops"))

    def placed(self, units: DataFrame, price: str = "price", name: str = "at") -> DataFrame:
        """``units`` with the place of their price."""
        x, top, within = F.col("__x"), F.col("__top"), F.col("__within")
        before = units.withColumn("__x", F.col(price).cast("double")).crossJoin(F.broadcast(self.tops))
        before = below(before, "__top", "__tops", "__x", -(-self.count // BLOCK))
        joined = below(before.join(self.blocks, F.col("__block") == top - 1, "left"), "__within", "__values", "__x", min(BLOCK, self.count))
        less = F.greatest(top - 1, F.lit(0)).cast("long") * BLOCK + within
        same = F.coalesce(F.get("__tops", top) == x, F.lit(False)) | F.coalesce(F.get("__values", within) == x, F.lit(False))
        at = F.when(x.isNull(), F.lit(self.last)).otherwise(2 * less + same.cast("int"))
        return joined.withColumn(name, at.cast("long")).drop("__x", "__tops", "__top", "__within", "__block", "__values")

    def ranges(self, kinds: DataFrame) -> DataFrame:
        """``kinds`` with the first and last place that each asks for; a unit without a price fits only those without a bound."""
        of = lambda c, name: self.values.select(F.col("value").alias(c), (2 * F.col("nth") - 1).alias(name))
        both = kinds.join(of("min_price", "low"), "min_price", "left").join(of("max_price", "high"), "max_price", "left")
        none = F.col("low").isNull() & F.col("high").isNull()
        high = F.when(none, F.lit(self.last)).otherwise(F.coalesce("high", F.lit(self.last - 1)))
        return both.withColumns({"low": F.coalesce("low", F.lit(0)).cast("long"), "high": high.cast("long")}).where("low <= high")

    @property
    def levels(self) -> int:
        """Digits that a place needs, after one is added."""
        return max(1, -(-(self.last + 2).bit_length() // DIGIT))


def node_in(level: int, node: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), node.alias("node"))


def nodes_of(place: Column, levels: int) -> Column:
    """The node of each level that holds a place."""
    return F.array(*[node_in(n, F.shiftright(place, DIGIT * n)) for n in range(levels)])


def nodes_up_to(place: Column, levels: int) -> Column:
    """The nodes that hold the places from 0 to ``place`` between them, each place once."""
    end = place + 1
    each = []
    for n in range(levels):
        first, last = F.shiftleft(F.shiftright(end, DIGIT * (n + 1)), DIGIT), F.shiftright(end, DIGIT * n) - 1
        run = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        each.append(F.transform(run, partial(node_in, n)))
    return F.concat(*each)


def nodes_between(low: Column, high: Column, levels: int) -> Column:
    """The nodes that hold the places from ``low`` to ``high`` between them, each place once."""
    firsts = [F.ceil(low / (1 << DIGIT * n)).cast("long") for n in range(levels + 1)]
    ends = [F.floor((high + 1) / (1 << DIGIT * n)).cast("long") for n in range(levels + 1)]
    run = lambda a, b: F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
    each = []
    for n in range(levels):
        # without what nodes of the next level hold
        outside = F.concat(run(firsts[n], F.shiftleft(firsts[n + 1], DIGIT)), run(F.shiftleft(ends[n + 1], DIGIT), ends[n]))
        own = F.when(firsts[n + 1] < ends[n + 1], outside).otherwise(run(firsts[n], ends[n]))
        each.append(F.transform(own, partial(node_in, n)))
    return F.concat(*each)


def ways(rows: DataFrame) -> DataFrame:
    """``rows`` of requests with ``way`` and the columns ``KEYS``, empty where nothing is asked."""
    asked = [*EQUAL, "q"]
    way = reduce(lambda x, y: x + y, [F.when(F.col(c).isNotNull(), 1 << n).otherwise(0) for n, c in enumerate(asked)])
    return rows.select("*", way.alias("way"), *[F.coalesce(F.col(c), F.lit("")).alias(k) for c, k in zip(asked, KEYS, strict=True)])


def requests_counted(requests: DataFrame, listings: DataFrame, units: DataFrame) -> DataFrame:
    """``(request_id, n_listings, n_units)`` of many searches, as ``search.requests_matched``: any number of requests, units and bounds.

    ``requests``: ``request_id`` and the columns ``search.ASKED``; null or empty
    asks for nothing, equal requests are answered once.  A null in a unit or
    listing fits no predicate on it.  A listing without units matches nothing;
    no requests give no rows.
    """
    asked = normal_requests(requests)
    kinds = stored(ways(asked.groupBy("key").agg(*[F.first(c).alias(c) for c in ASKED])))
    bounds = Bounds(kinds)
    # a least number of bathrooms is as good as the next larger one that a unit has: one row with those that there are
    held = units.agg(F.sort_array(F.collect_set("bathrooms")).alias("held"))
    least = F.get(F.filter("held", lambda v: v >= F.col("min_bathrooms")), F.lit(0))
    kinds = kinds.crossJoin(F.broadcast(held)).withColumn("least", least).where("min_bathrooms is null or least is not null").drop("held")
    kinds = stored(bounds.ranges(kinds))
    slots = stored(kinds.select("way", *KEYS, "least").distinct().withColumn("slot", F.monotonically_increasing_id()))
    present = sorted(r["way"] for r in slots.select("way").distinct().collect())  # sixteen at most
    if not present:
        return asked.select("request_id", F.lit(0).cast("long").alias("n_listings"), F.lit(0).cast("long").alias("n_units"))

    totals = units.groupBy("listing_id").agg(F.coalesce(F.sum("available"), F.lit(0)).cast("long").alias("total"))
    offered = listings.select("listing_id", "property_type", "city").join(totals, "listing_id")
    stock = bounds.placed(units.select("listing_id", "type", "bathrooms", "price")).drop("price").join(offered, "listing_id")
    columns = ["listing_id", "bathrooms", "at", "total"]
    fits = F.col("least").isNull() | (F.col("bathrooms") >= F.col("least"))

    worded = [w for w in present if w >= TEXT]
    if worded:
        folder = f"{checkpoint_folder(units.sparkSession)}/grams-{uuid.uuid4().hex}"
        texts.write_index(listings, folder)
        found = texts.matched_texts(listings, folder, kinds.select("q").where("q is not null"))
        # each of them is a part of the listing's texts
        stock = stock.join(found.groupBy("listing_id").agg(F.collect_list("q").alias("texts")), "listing_id", "left")

    def in_slots(some: list[int], slots: DataFrame) -> DataFrame:
        """Units meet, in one pass for all ways to ask, the slots that are equal to them."""
        met = lambda n, c: F.when(F.col("way").bitwiseAND(1 << n) > 0, F.col(c)).otherwise("")
        each = stock.withColumn("way", F.explode(F.array(*[F.lit(w) for w in some])))
        text = F.explode(F.when(F.col("way") >= TEXT, F.col("texts")).otherwise(F.array(F.lit("")))) if worded else F.lit("")
        keyed = each.select(*columns, "way", *[met(n, c).alias(k) for n, (c, k) in enumerate(zip(EQUAL.values(), KEYS, strict=False))], text.alias("kq"))
        return keyed.join(slots, ["way", *KEYS]).where(fits).select("slot", *columns)

    if slots.count() <= FEW:
        parts = [in_slots(present, F.broadcast(slots))]
    else:
        parts = [in_slots(some, slots)] if (some := [w for w in present if w > 0]) else []
        if 0 in present:  # nothing must be equal: a slot for each number of bathrooms, of which there are as many as units have
            parts.append(stock.crossJoin(F.broadcast(slots.where("way = 0").select("slot", "least"))).where(fits).select("slot", *columns))
    cells = reduce(DataFrame.union, parts).groupBy("slot", "listing_id", "at").agg(F.first("total").alias("total"))
    # places from 1 on: 0 stands before the first
    pairs = cells.withColumn("before", F.coalesce(F.lag("at").over(W.partitionBy("slot", "listing_id").orderBy("at")) + 1, F.lit(0).cast("long")))
    summed = pairs.groupBy("slot", "before", "at").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("units"))

    equal = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("way", *KEYS, "least")]
    sought = kinds.alias("a").join(slots.alias("b"), equal).select("a.key", "b.slot", "a.low", "a.high")
    nodes = sought.select("key", "slot", "low", "high", F.inline(nodes_up_to(F.col("low"), bounds.levels)))
    ends = F.array(F.struct(F.col("high").alias("at"), F.lit(1).alias("sign")), F.struct((F.col("low") - 1).alias("at"), F.lit(-1).alias("sign")))
    questions = nodes.select("slot", "level", "node", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("units"), "key", F.inline(ends))
    at = ["slot", "level", "node"]
    held_in = summed.select("slot", "at", "n", "units", F.inline(nodes_of(F.col("before"), bounds.levels)))
    held_in = held_in.groupBy(*at, "at").agg(F.sum("n").alias("n"), F.sum("units").alias("units"))
    every = held_in.select(*at, "at", "n", "units", F.lit(None).cast("string").alias("key"), F.lit(0).alias("sign")).unionByName(questions)
    up_to = W.partitionBy(*at).orderBy("at")
    answered = every.select("key", "sign", F.sum("n").over(up_to).alias("n"), F.sum("units").over(up_to).alias("units")).where("key is not null")
    counts = answered.groupBy("key").agg(F.sum(F.col("sign") * F.col("n")).alias("n_listings"), F.sum(F.col("sign") * F.col("units")).alias("n_units"))
    rows = asked.select("request_id", "key").join(stored(counts), "key", "left")
    return rows.select("request_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_listings", "n_units")])
