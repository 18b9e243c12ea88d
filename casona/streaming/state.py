"""Users' state and rates kept by Structured Streaming."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from casona.functions.labels import FALLBACK_RATE
from casona.functions.storage import checkpoint_folder
from casona.sources.fx import valid_rates


#: Keys of state to which pairs of a user and a listing are dealt, as each key costs a call.
BUCKETS = 65_536


def toggled(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Whether pairs are favorites, when that changes.  State: for each pair whether it is, and the events that may come again, with their times."""
    pairs = {(user, listing): (odd, seen) for user, listing, odd, seen in json.loads(state.get[0])} if state.exists else {}
    before: dict[tuple, bool] = {}
    mark, text = state.getCurrentWatermarkMs(), lambda x: x if isinstance(x, str) else None  # a missing text may be none or not a number
    if not state.hasTimedOut:
        for frame in frames:
            for user, listing, event, at in zip(*(frame[c].tolist() for c in ("user_id", "listing_id", "event_id", "at")), strict=True):
                pair = text(user), text(listing)
                odd, seen = pairs.get(pair, (False, {}))
                before.setdefault(pair, odd)
                if event not in seen:
                    seen[event], odd = at, not odd
                pairs[pair] = odd, seen
    held = [(*pair, odd, {event: at for event, at in seen.items() if at > mark}) for pair, (odd, seen) in pairs.items()]
    held = [x for x in held if x[2] or x[3]]
    if held:
        state.update((json.dumps(held),))
        if any(x[3] for x in held):
            state.setTimeoutTimestamp(min(at for x in held for at in x[3].values()))
    elif state.exists:
        state.remove()
    changed = [(*pair, pairs[pair][0]) for pair, odd in before.items() if pairs[pair][0] != odd]
    if changed:
        yield pd.DataFrame(changed, columns=["user_id", "listing_id", "favorite"])


def favorite_changes(toggles: DataFrame, late: str = "30 days") -> DataFrame:
    """``(user_id, listing_id, favorite)`` of a stream of toggles, whenever it changes; an event that repeats counts once.

    What is kept: the pairs that are favorites, and the events of the last
    ``late``, within which one may come late or again; what comes later than that
    is left out.  A pair that is no favorite is forgotten when its last event is.
    """
    timed = toggles.where("event_id is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    # as texts, so that a missing or large number stays what it is
    events = timed.select(*[F.col(c).cast("string").alias(c) for c in ("user_id", "listing_id", "event_id")], "ts", F.unix_millis("ts").alias("at"))
    dealt = events.withColumn("bucket", F.pmod(F.xxhash64("user_id", "listing_id"), F.lit(BUCKETS)))
    rows = dealt.groupBy("bucket").applyInPandasWithState(toggled, "user_id string, listing_id string, favorite boolean", "body string", "update", GroupStateTimeout.EventTimeTimeout)
    return rows.select(*[F.col(c).cast(toggles.schema[c].dataType).alias(c) for c in ("user_id", "listing_id")], "favorite")


def last_choices(choices: DataFrame) -> DataFrame:
    """``(user_id, last)`` of a stream of currency choices."""
    return choices.groupBy("user_id").agg(F.max_by("currency", F.struct("ts", "event_id")).alias("last"))


def last_rates(payloads: DataFrame) -> DataFrame:
    """One row: the latest valid rate of a stream of payloads."""
    return valid_rates(payloads).agg(F.max_by(F.struct("rate", "updated_utc"), F.struct("ts", "event_id")).alias("x"))


def prices_at_rates(payloads: DataFrame, prices: DataFrame, folder: str | None = None) -> DataFrame:
    """``prices`` with ``rate``: that which holds once a stream of payloads is read, or the fallback if none was valid.

    The stream writes a row for each version of the rate and nothing else; prices
    are joined to the last one when they are read.  In a ``folder`` that is given
    a later call goes on with what came since.
    """
    versions = run_to_end(last_rates(payloads), [], folder)
    return prices.crossJoin(F.broadcast(versions.select(F.coalesce("x.rate", F.lit(FALLBACK_RATE)).alias("rate"))))


def run_to_end(stream: DataFrame, keys: list[str], folder: str | None = None, progress: list | None = None) -> DataFrame:
    """What an updating stream has for each key once all its input is read.

    Every micro-batch appends its changed rows to a table in the shared folder;
    the last of each key counts.  A batch that is written again, after a failure,
    replaces what it wrote before.  In a ``folder`` that is given a later call
    goes on with what came since.  ``progress`` gets what Spark says of each
    micro-batch, if it is given.
    """
    spark: SparkSession = stream.sparkSession
    folder = folder or f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    query = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if progress is not None:
        progress += query.recentProgress
    rows = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}, batch int").parquet(f"{folder}/rows")
    values = [c for c in stream.columns if c not in keys]
    if not keys:
        return rows.agg(F.max_by(F.struct(*values), "batch").alias("x")).select("x.*")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("x")).select(*keys, "x.*")
