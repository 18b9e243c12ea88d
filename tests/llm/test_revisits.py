import random

import pytest
from pyspark.sql import functions as F

from casona.llm import queries, revisits

SCHEMA = "record_id long, url string, at long, kind string, headers map<string, string>, status string, response_id long"


def slow(rows, key=lambda u: u):
    out = []
    for rid, url, at, kind, head, *_ in rows:
        if kind != "revisit" or url is None or at is None:
            continue
        before = [r for r in rows if r[1] is not None and key(r[1]) == key(url) and r[3] == "response" and r[2] is not None and r[2] < at]
        if not before:
            out.append((rid, None, "orphan"))
            continue
        met = max(before, key=lambda r: (r[2], r[0]))
        status = "unvalidated"
        for field in ("etag", "last-modified"):
            mine, theirs = ((h or {}).get(field) for h in (head, met[4]))
            if mine is not None and theirs is not None:
                status = "resolved" if mine.removeprefix("W/") == theirs.removeprefix("W/") else "mismatch"
                break
        out.append((rid, met[0], status))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [1, 10, 3600])
def test_equals_brute_force(spark, bucket):
    rng = random.Random(bucket)
    rows = []
    for k in range(400):
        url = rng.choice(["http://hot.org/", "http://hot.org/", f"http://h.org/{rng.randrange(9)}", None])
        head = rng.choice([None, {}, {"etag": rng.choice(["a", "W/a", "b"])}, {"last-modified": rng.choice("xy")}, {"etag": "a", "last-modified": "x"}])
        rows.append((k, url, rng.choice([None, *range(60)]), rng.choice(["response", "revisit", None]), head, "s", 0))
    found = revisits.resolved(spark.createDataFrame(rows, SCHEMA), bucket).collect()
    assert sorted(((r["record_id"], r["response_id"], r["status"]) for r in found), key=repr) == slow(rows)


def test_headers(spark):
    rows = [
        (1, "http://a/", 1, "response", {"etag": "t", "content-length": "9", "cache-control": "old", "server": "s"}, None, None),
        (2, "https://A", 2, "revisit", {"etag": 'W/t', "content-length": "0", "cache-control": "new"}, None, None),
        (3, "http://a", 3, "revisit", {"etag": "u"}, None, None),
    ]
    found = {r["record_id"]: r for r in revisits.resolved(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[2]["headers"] == {"etag": "W/t", "content-length": "9", "cache-control": "new", "server": "s"}
    assert found[3]["status"] == "mismatch" and found[3]["headers"] == {"etag": "u"}


@pytest.mark.parametrize(
    "url, key",
    [
        ("HTTP://WWW.Ex.org:80/a/?b=2&a=1&utm_x=3#f", "ex.org/a?a=1&b=2"),
        ("https://ex.org/", "ex.org"),
        ("https://ex.org?ref=z", "ex.org"),
        ("no scheme#x", "no scheme#x"),
        ("https://ex.org/A%20b?x", "ex.org/A%20b?x"),
        (None, None),
    ],
)
def test_canonical_url(spark, url, key):
    assert spark.range(1).select(revisits.canonical_url(F.lit(url).cast("string"))).first()[0] == key


def test_repeats_and_empty(spark):
    rows = [(1, "http://a", 1, "response", None, "", 0)] * 2 + [(2, "http://a", 5, "revisit", None, "", 0)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    assert [(r["response_id"], r["status"], r["headers"]) for r in revisits.resolved(df).collect()] == [(1, "unvalidated", {})] * 2
    assert revisits.resolved(df.where("false")).count() == 0


def test_query(same_as_sql, spark, small):
    same_as_sql(queries.op6_warc_revisits, revisits.REVISITS_SQL)
    states = {r["status"] for r in queries.op6_warc_revisits(spark, small).select("status").distinct().collect()}
    assert {"resolved", "mismatch"} <= states
