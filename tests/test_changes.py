"""Streams of changed units: roll-ups and standing counts end as batches over what is left."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from casona.operators import requests as rq
from casona.operators import search, summary
from casona.streaming import changes as ch
from tests.test_requests import ASKED, random_requests

LISTINGS = "listing_id long, position long, project string, city string, property_type string"


@pytest.fixture(scope="module")
def history():
    """Changes in no order, some twice, some older than what is known, with removals of the least and the greatest."""
    rng = random.Random(6)
    rows, last = [], {}
    for listing in range(25):
        for unit in range(rng.randrange(1, 6)):
            for version in range(1, rng.randrange(2, 6)):
                values = (rng.choice(["Studio", "2BR", None]), rng.choice([0, 1, 2, None]), rng.choice([1.0, 2.0, None]), rng.choice([None, float("nan"), *map(float, range(30))]), rng.choice([10.0, 20.5, None]), rng.choice([0, 1, 4]))
                gone = rng.random() < 0.25
                rows.append((listing, unit, version, gone, *values))
                last[listing, unit] = None if gone else (listing, unit, *values)
    rows += rng.sample(rows, 30) + [(None, 1, 1, False, None, None, None, None, None, 1), (1, None, 1, False, None, None, None, None, None, 1)]
    rng.shuffle(rows)
    return rows, [v for v in last.values() if v]


@pytest.fixture(scope="module")
def left(spark, history):
    return spark.createDataFrame(history[1], f"listing_id long, unit_seq int, {ch.KINDS}").cache()


@pytest.fixture(scope="module", params=[1, 40])
def log(spark, history, request, tmp_path_factory):
    """The log of the changes, in files of some rows that are read one or several at once; four listings and three units of each share a key of state."""
    sizes = ch.NEAR, ch.TOGETHER
    ch.NEAR, ch.TOGETHER = 4, 3
    folder = tmp_path_factory.mktemp("changes")
    size = 1 + len(history[0]) // 5
    for k in range(0, len(history[0]), size):
        spark.createDataFrame(history[0][k : k + size], ch.CHANGES).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    stream = spark.readStream.schema(ch.CHANGES).option("maxFilesPerTrigger", request.param).parquet(str(folder / "in"))
    yield ch.written_log(stream)
    ch.NEAR, ch.TOGETHER = sizes


def key(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


def test_log_adds_up_to_what_is_left(spark, log, left):
    rows = spark.read.schema(ch.LOG).parquet(f"{log}/rows")
    values = [c for c in rows.columns if c != "sign"]
    summed = rows.groupBy(*values).agg(F.sum("sign").alias("n")).where("n <> 0")
    assert key(summed.select(*values, "n")) == key(left.groupBy(*values).agg(F.count(F.lit(1)).alias("n")))


def test_rollups_equal_a_rebuild(spark, log, left):
    got = ch.rollups(ch.log_stream(spark, log, files=3))
    columns = ["listing_id", "min_price", "max_price", "min_bedrooms", "max_bedrooms", "min_size", "available"]
    assert key(got.select(columns)) == key(summary.unit_summary(left).select(columns))
    tabs = {(r["listing_id"], t) for r in got.collect() for t in r["tabs"].split(",") if t}
    assert tabs == {(r["listing_id"], f"{r['type']}:{r['available']}") for r in summary.unit_type_counts(left).where("type is not null").collect()}


def test_standing_counts_equal_a_batch(spark, log, left):
    listings = spark.createDataFrame([(k, k, f"Casa {k}%", "Lima, P" if k % 2 else "Roma, I", "Villa" if k % 3 else None) for k in range(30)], LISTINGS)
    requests = spark.createDataFrame(list(random_requests(random.Random(5), 80)), ASKED)
    got = ch.standing_counts(ch.log_stream(spark, log, files=3), requests, listings)
    assert key(got) == key(search.requests_matched(requests, listings, left))


@pytest.mark.parametrize("low, high", [(0, 0), (0, 15), (1, 16), (3, 700), (16, 31), (255, 4096), (0, 4095), (17, 17)])
def test_nodes_hold_each_place_once(spark, low, high):
    [nodes] = spark.range(1).select(rq.nodes_between(F.lit(low).cast("long"), F.lit(high).cast("long"), 4)).first()
    places = [p for n in nodes for p in range(n["node"] << 4 * n["level"], n["node"] + 1 << 4 * n["level"])]
    assert sorted(places) == list(range(low, high + 1)) and len(nodes) <= 120
    [up] = spark.range(1).select(rq.nodes_up_to(F.lit(high).cast("long"), 4)).first()
    assert sorted(p for n in up for p in range(n["node"] << 4 * n["level"], n["node"] + 1 << 4 * n["level"])) == list(range(high + 1))


class Held:
    """A state as Spark hands it to a function."""

    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value

    def remove(self):
        self.exists, self.get = False, None


def test_counts_of_a_key_of_many_listings_in_few_calls(spark):
    """Neighbours share a call, which works on columns; a count goes down as a listing's last unit goes."""
    assert ch.near(spark.range(4096).withColumnRenamed("id", "listing_id")).select("near").distinct().count() == 2
    state, frame = Held(), lambda *rows: iter([pd.DataFrame(rows, columns=ch.MATCH.names)])
    first = [x.values.tolist() for x in ch.counted((0,), frame((1, 7, 2), (1, ch.AVAILABLE, 5), (2, 7, 1), (2, ch.AVAILABLE, 3), (2, 8, 1)), state)]
    assert first == [[[7, 2, 8], [8, 1, 3]]]
    second = [x.values.tolist() for x in ch.counted((0,), frame((2, 7, -1), (1, 7, -1), (1, ch.AVAILABLE, 1)), state)]
    assert second == [[[7, -1, -2]]]
    list(ch.counted((0,), frame((1, 7, -1), (1, ch.AVAILABLE, -6), (2, 8, -1), (2, ch.AVAILABLE, -3)), state))
    assert not state.exists


def test_functions_of_state_get_numbers(spark):
    """Numbers go to functions of state as they are, beside a mask; what is missing and what is none stay apart, and the first of equal versions holds."""
    nan = float("nan")
    rows = spark.createDataFrame([(1, "1BR", 0, nan, None, 7.5, None), (2, None, None, None, nan, -0.0, 3), (3, "2BR", 4, 1.5, 2.5, None, 0)], f"listing_id long, {ch.KINDS}")
    masked = ch.masked(rows, ch.VALUES)
    assert dict(masked.dtypes) == {**dict(rows.dtypes), "missing": "int"} and masked.where("price is null or size is null or available is null").isEmpty()
    assert key(ch.unmasked(masked, ch.VALUES)) == key(rows)
    state, values = Held(), ["missing", *ch.VALUES]
    frame = lambda *rows: iter([pd.DataFrame(rows, columns=ch.UNIT.names).astype({"type": object})])
    unit = lambda version, removed, price, missing=0: (1, 1, version, removed, missing, "2BR", 2, 1.5, price, 9.0, 1)
    [log] = ch.latest((0,), frame(unit(2, False, nan), unit(2, False, 5.0), unit(1, False, 6.0)), state)
    assert log["sign"].tolist() == [1] and log["price"].isna().all()
    assert list(ch.latest((0,), frame(unit(3, False, nan), unit(1, True, 1.0)), state)) == []
    [log] = ch.latest((0,), frame(unit(4, False, 0.0, 8)), state)
    assert log["sign"].tolist() == [-1, 1] and log[values].iloc[1].tolist() == [8, "2BR", 2, 1.5, 0.0, 9.0, 1]
    [log] = ch.latest((0,), frame(unit(5, True, 0.0)), state)
    assert log["sign"].tolist() == [-1] and log["missing"].tolist() == [8]
