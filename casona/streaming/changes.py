"""Roll-ups and standing searches that follow a stream of changed units.

A change says how a unit is from a version on, or that it is gone.  Changes may
come late, again and in any order; the greatest version of a unit holds, and
what is older than that changes nothing.  The first stream turns changes into a
log of deltas: a row that takes back what a unit was, and one that adds what it
is.  Others read this log and keep what follows from it, a listing at a time, so
that each change costs what it touches:

* roll-ups, with the values of a listing's units as an ordered multiset, so that
  a least or greatest value can be taken back;
* the counts of standing requests, with how many units of a listing fit each
  request, so that a listing enters or leaves a count once.

A key of state holds ``NEAR`` listings with ids in a row, as each key costs a call,
and at most ``TOGETHER`` units of each, however many it has; a call works on columns
of all its rows.  A task sums up what it has of a listing before the log's rows meet
at it.  State is kept by
Spark's state store; for much of it choose the RocksDB provider in the session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DoubleType, StringType

from casona.functions.storage import checkpoint_folder, removed, stored
from casona.operators import texts
from casona.operators.requests import KEYS, TEXT, Bounds, nodes_between, nodes_of, normal_requests, ways
from casona.operators.search import ASKED, EQUAL

#: Listings, by their ids, and units of each, by their numbers, that one key of state holds.
NEAR, TOGETHER = 2_048, 64
VALUES = ("type", "bedrooms", "bathrooms", "price", "size", "available")
KINDS = "type string, bedrooms int, bathrooms double, price double, size double, available int"
CHANGES = f"listing_id long, unit_seq int, version long, removed boolean, {KINDS}"
LOG = f"listing_id long, sign int, {KINDS}"
STATE = "body binary"


def table_of(frames: Iterator[pd.DataFrame], schema: pa.Schema) -> pa.Table:
    """Rows as Spark hands them over; numbers in them are never missing, so that one that is none stays what it is."""
    column = lambda f, c: pa.array(f[c.name].to_numpy(), c.type, from_pandas=pa.types.is_string(c.type))
    return pa.concat_tables([schema.empty_table(), *(pa.table([column(f, c) for c in schema], schema=schema) for f in frames)])


def unpacked(state: GroupState, schema: pa.Schema) -> pa.Table:
    """A state's rows."""
    return pa.ipc.open_stream(state.get[0]).read_all() if state.exists else schema.empty_table()


def kept(state: GroupState, rows: pa.Table) -> None:
    """State that is empty goes."""
    if len(rows):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
            out.write_table(rows.combine_chunks())
        state.update((sink.getvalue().to_pybytes(),))
    elif state.exists:
        state.remove()


def summed_up(rows: pa.Table) -> pa.Table:
    """Rows that are equal but for their signs as one, without those that come to nothing."""
    kinds = [c for c in rows.column_names if c != "sign"]
    total = rows.group_by(kinds, use_threads=False).aggregate([("sign", "sum")])
    total = pa.table({c: total["sign_sum" if c == "sign" else c] for c in rows.column_names})
    return total.filter(pc.not_equal(total["sign"], 0))


def masked(frame: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """``frame`` with zeros for missing numbers, and a bit for each value that is missing: pandas has one mark for a missing number and for none."""
    bits = [F.when(F.col(v).isNull(), 1 << n).otherwise(0) for n, v in enumerate(values)]
    kinds = {f.name: f.dataType for f in frame.schema}
    # one that is no number is always the same
    number = lambda v: F.nanvl(v, F.lit(float("nan"))) if kinds[v] == DoubleType() else F.col(v)
    filled = {v: F.coalesce(number(v), F.lit(0).cast(kinds[v])) for v in values if kinds[v] != StringType()}
    return frame.withColumns({**filled, "missing": reduce(lambda x, y: x + y, bits)})


def unmasked(frame: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """``masked`` taken back; a number that is none comes from pandas as a missing one."""
    kinds = {f.name: f.dataType for f in frame.schema}
    value = lambda v: F.coalesce(F.col(v), F.lit(float("nan"))) if kinds[v] == DoubleType() else F.col(v)
    return frame.withColumns({v: F.when(F.col("missing").bitwiseAND(1 << n) == 0, value(v)) for n, v in enumerate(values)}).drop("missing")


#: Values as functions of state have them.
HELD = {"type": pa.string(), "bedrooms": pa.int32(), "bathrooms": pa.float64(), "price": pa.float64(), "size": pa.float64(), "available": pa.int32()}
#: A unit in state: its latest version, and how it is.
UNIT = pa.schema([("listing_id", pa.int64()), ("unit_seq", pa.int64()), ("version", pa.int64()), ("removed", pa.bool_()), ("missing", pa.int32()), *HELD.items()])


def bits(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that are equal where a column's values are."""
    if pa.types.is_string(column.type):
        return column.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
    values = column.to_numpy()
    return values.view("int64") if values.dtype == "float64" else values


def latest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The log of some units: what they were with sign -1, what they are with 1."""
    held = unpacked(state, UNIT)
    rows = pa.concat_tables([held, table_of(frames, UNIT)]).combine_chunks()
    at = np.arange(len(rows))
    listing, unit, version = (rows[c].to_numpy() for c in ("listing_id", "unit_seq", "version"))
    # of equal versions the one that came first holds
    order = np.lexsort((-at, version, unit, listing))
    starts = np.flatnonzero(np.r_[True, (np.diff(listing[order]) != 0) | (np.diff(unit[order]) != 0)])
    now, first = order[np.r_[starts[1:], len(rows)] - 1], np.minimum.reduceat(order, starts)
    kept(state, rows.take(now))
    newer = now >= len(held)
    now, first = now[newer], first[newer]  # first is how a unit was, if it is held
    gone = rows["removed"].to_numpy()
    was, is_now = (first < len(held)) & ~gone[first], ~gone[now]
    equal = was & is_now
    for v in ("missing", *VALUES):
        own = bits(rows[v])
        equal &= own[now] == own[first]
    back, added = first[was & ~equal], now[is_now & ~equal]
    if len(back) or len(added):
        log = rows.select(["listing_id", "missing", *VALUES]).take(np.r_[back, added]).to_pandas()
        log["sign"] = np.repeat(np.array([-1, 1], "int32"), [len(back), len(added)])
        yield log


def near(rows: DataFrame) -> DataFrame:
    return rows.withColumn("near", F.floor(F.col("listing_id") / NEAR))


def change_log(changes: DataFrame) -> DataFrame:
    """The stream of deltas ``LOG`` of a stream of ``CHANGES``; a change without an id of a listing or a unit, or a version, is left out."""
    whole = changes.where("listing_id is not null and unit_seq is not null and version is not null").withColumn("removed", F.coalesce("removed", F.lit(False)))
    keyed = near(masked(whole, VALUES).withColumn("part", F.floor(F.col("unit_seq") / TOGETHER)))
    log = keyed.groupBy("near", "part").applyInPandasWithState(latest, f"listing_id long, missing int, {KINDS}, sign int", STATE, "append", GroupStateTimeout.NoTimeout)
    return unmasked(log, VALUES).select("listing_id", "sign", *VALUES)


def written_log(changes: DataFrame) -> str:
    """The folder with the log of all changes that there are now; written once, whatever breaks in between."""
    folder = f"{checkpoint_folder(changes.sparkSession)}/log-{uuid.uuid4().hex}"
    query = change_log(changes).writeStream.format("parquet").outputMode("append").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return folder


def log_stream(spark: SparkSession, folder: str, files: int = 256) -> DataFrame:
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files).parquet(f"{folder}/rows")


def followed(stream: DataFrame, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``write`` makes of each micro-batch, with its number ``batch``, once the stream is read; a batch that is written again replaces itself."""
    spark = stream.sparkSession
    folder = f"{checkpoint_folder(spark)}/followed-{uuid.uuid4().hex}"

    def each(batch: DataFrame, number: int) -> None:
        write(batch).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    stream.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in write(spark.createDataFrame([], stream.schema)).schema)
    rows = spark.read.schema(f"{columns}, batch int").parquet(f"{folder}/rows")
    removed(spark, f"{folder}/state")
    return rows


# Roll-ups


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deltas that are equal but for their signs as one, within what a task has at once."""
    for batch in batches:
        if len(batch):
            yield from summed_up(pa.Table.from_batches([batch])).to_batches()


ROLLUP = "listing_id long, min_price double, max_price double, min_bedrooms int, max_bedrooms int, min_size double, available long, units long, tabs string"
MEASURES = ("price", "bedrooms", "size")
ENDS = tuple(f"{end}_{measure}" for measure in MEASURES for end in ("min", "max"))
#: How often a listing has a unit of such values; ``missing`` tells which of them it lacks.
OWN = ("type", *MEASURES, "available")
KIND = pa.schema([("listing_id", pa.int64()), ("missing", pa.int32()), *((v, HELD[v]) for v in OWN), ("sign", pa.int64())])


def ends(values: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least and the greatest of the values at each of ``n`` places, and where there is none; what is no number is greater than all numbers, as Spark has it."""
    none = np.isnan(values)
    low, high = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(low, at[~none], values[~none])
    np.maximum.at(high, at[~none], values[~none])
    numbers, others = np.bincount(at[~none], minlength=n), np.bincount(at[none], minlength=n)
    return np.where(numbers > 0, low, np.nan), np.where(others > 0, np.nan, high), numbers + others == 0


def rolled(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The roll-ups of listings after some deltas of theirs."""
    new = table_of(frames, KIND)
    rows = summed_up(pa.concat_tables([unpacked(state, KIND), new]))
    kept(state, rows)
    touched = np.unique(new["listing_id"].to_numpy())
    rows = rows.filter(pa.array(np.isin(rows["listing_id"].to_numpy(), touched))).combine_chunks()
    at, n = np.searchsorted(touched, rows["listing_id"].to_numpy()), len(touched)
    lacking, sign = rows["missing"].to_numpy(), rows["sign"].to_numpy()
    out, missing = {"listing_id": touched}, np.zeros(n, "int32")
    for k, measure in enumerate(MEASURES):
        there = lacking & (1 << OWN.index(measure)) == 0
        low, high, neither = ends(rows[measure].to_numpy()[there].astype("float64"), at[there], n)
        out[f"min_{measure}"], out[f"max_{measure}"] = low, high
        missing += np.where(neither, 3 << 2 * k, 0).astype("int32")
    total = sign * rows["available"].to_numpy()
    for name, values in (("units", sign), ("available", total)):
        out[name] = np.zeros(n, "int64")
        np.add.at(out[name], at, values)
    typed = pa.table({"at": at, "type": rows["type"], "total": total}).filter(rows["type"].is_valid())
    typed = typed.group_by(["at", "type"], use_threads=False).aggregate([("total", "sum")]).sort_by([("at", "ascending"), ("type", "ascending")])
    each = pc.binary_join_element_wise(typed["type"].cast(pa.string()), typed["total_sum"].cast(pa.string()), ":").combine_chunks()
    cuts = np.searchsorted(typed["at"].to_numpy(), np.arange(n + 1)).astype("int32")
    out["tabs"] = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), each), ",").to_pandas()
    yield pd.DataFrame({**out, "missing": missing})


def rollups(log: DataFrame) -> DataFrame:
    """The roll-up of each listing that has units, ``ROLLUP``, once a stream of deltas is read; ``tabs`` are the available units by type."""
    kinds, own = (dict(x.strip().split(" ") for x in text.split(",")) for text in (ROLLUP, KINDS))
    ready = log.select("listing_id", "sign", *OWN).mapInArrow(summed, f"listing_id long, sign long, {', '.join(f'{v} {own[v]}' for v in OWN)}")
    rolled_up = f"listing_id long, missing int, {', '.join(f'{c} double' for c in ENDS)}, available long, units long, tabs string"
    stream = near(masked(ready, OWN)).groupBy("near").applyInPandasWithState(rolled, rolled_up, STATE, "update", GroupStateTimeout.NoTimeout)
    rows = unmasked(followed(stream, lambda batch: batch), ENDS)
    last = rows.groupBy("listing_id").agg(F.max_by(F.struct(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items() if c != "listing_id"]), "batch").alias("x"))
    return last.select("listing_id", "x.*").where("units > 0")


# Standing requests


#: What the log's rows of a listing are matched to: a request's number, or ``AVAILABLE``.
MATCHES = "listing_id long, kind long, sign long"
#: The same in state; ``AVAILABLE`` stands for the listing's available units.
MATCH, AVAILABLE = pa.schema([(c, pa.int64()) for c in ("listing_id", "kind", "sign")]), -1


def request_offers(listings: DataFrame, kinds: DataFrame) -> DataFrame:
    """``(listing_id, property_type, city, kq)``: each listing once without a text and once for each text of a request that it contains."""
    plain = listings.select("listing_id", "property_type", "city", F.lit("").alias("kq"))
    asked = kinds.select("q").where("q is not null").distinct()
    if asked.isEmpty():
        return plain
    folder = f"{checkpoint_folder(listings.sparkSession)}/grams-{uuid.uuid4().hex}"
    texts.write_index(listings, folder)
    found = texts.matched_texts(listings, folder, asked).withColumnRenamed("q", "kq")
    offers = stored(plain.unionByName(found.join(listings.select("listing_id", "property_type", "city"), "listing_id")))
    removed(listings.sparkSession, folder)
    return offers


def fitting(rows: pd.DataFrame) -> pd.DataFrame:
    """``(listing_id, kind, n, units)``: the requests that some of a listing's units fit, once, with its available units."""
    totals = rows[rows["kind"] == AVAILABLE].set_index("listing_id")["sign"]
    fits = rows[rows["kind"] != AVAILABLE]
    return pd.DataFrame({"listing_id": fits["listing_id"], "kind": fits["kind"], "n": 1, "units": fits["listing_id"].map(totals).fillna(0).astype("int64")})


def counted(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """By how much the counts of requests change with some listings.  State: the available units of each, and how many of its units fit each request."""
    held, new = unpacked(state, MATCH), table_of(frames, MATCH)
    rows = summed_up(pa.concat_tables([held, new]))
    kept(state, rows)
    held, rows = held.to_pandas(), rows.to_pandas()
    touched = np.unique(new["listing_id"].to_numpy())
    now, was = (fitting(x[x["listing_id"].isin(touched)]) for x in (rows, held))
    was[["n", "units"]] *= -1
    change = pd.concat([now, was]).groupby("kind", as_index=False)[["n", "units"]].sum()
    change = change[(change["n"] != 0) | (change["units"] != 0)]
    if len(change):
        yield change.set_axis(["kind", "n_listings", "n_units"], axis=1)


def standing_counts(log: DataFrame, requests: DataFrame, listings: DataFrame) -> DataFrame:
    """``(request_id, n_listings, n_units)`` of standing requests once a stream of deltas is read, as ``search.requests_matched`` of the units that there are then.

    A delta meets the requests at the nodes that hold its price's place, of which
    a request has exactly one, together with all that must be equal; so it meets
    those that it may concern and no others.
    """
    asked = normal_requests(requests)
    kinds = stored(ways(asked.groupBy("key").agg(*[F.first(c).alias(c) for c in ASKED])).withColumn("kind", F.monotonically_increasing_id()))
    bounds = Bounds(kinds)
    nodes = bounds.ranges(kinds).select("kind", "way", *KEYS, "min_bathrooms", F.inline(nodes_between(F.col("low"), F.col("high"), bounds.levels)))
    nodes = stored(nodes)
    present = sorted(r["way"] for r in nodes.select("way").distinct().collect())  # sixteen at most
    offers = request_offers(listings, kinds)
    met = lambda n, c: F.when(F.col("way").bitwiseAND(1 << n) > 0, F.col(c)).otherwise("")
    stock = bounds.placed(log).join(offers, "listing_id").withColumn("way", F.explode(F.array(*[F.lit(w) for w in present]).cast("array<int>")))
    stock = stock.where((F.col("way") >= TEXT) == (F.col("kq") != ""))
    keyed = stock.select("listing_id", "sign", "bathrooms", "way", "kq", *[met(n, c).alias(k) for n, (c, k) in enumerate(zip(EQUAL.values(), KEYS, strict=False))], F.inline(nodes_of(F.col("at"), bounds.levels)))
    fits = F.col("min_bathrooms").isNull() | (F.col("bathrooms") >= F.col("min_bathrooms"))
    hits = keyed.join(nodes, ["way", *KEYS, "level", "node"]).where(fits).select("listing_id", "kind", F.col("sign").cast("long").alias("sign"))
    totals = log.select("listing_id", F.lit(AVAILABLE).cast("long").alias("kind"), (F.col("sign") * F.coalesce("available", F.lit(0))).cast("long").alias("sign"))
    deltas = hits.union(totals).mapInArrow(summed, MATCHES)
    stream = near(deltas).groupBy("near").applyInPandasWithState(counted, "kind long, n_listings long, n_units long", STATE, "update", GroupStateTimeout.NoTimeout)
    rows = followed(stream, lambda batch: batch.groupBy("kind").agg(F.sum("n_listings").alias("n_listings"), F.sum("n_units").alias("n_units")))
    counts = rows.groupBy("kind").agg(F.sum("n_listings").alias("n_listings"), F.sum("n_units").alias("n_units")).join(kinds.select("kind", "key"), "kind").drop("kind")
    result = asked.select("request_id", "key").join(counts, "key", "left")
    return result.select("request_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_listings", "n_units")])
