"""WARC revisit records: what a not-modified answer stood for.

A revisit is joined as of its time to the latest earlier full response of its
canonical URL.  A URL's history is cut in time buckets, so that one that is
captured very often is spread over tasks: a bucket's last response is found by
an aggregation and carried on to the next buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Header fields that a not-modified answer does not replace (they describe the transfer or the stored body).
KEPT_FIELDS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "transfer-encoding")
#: Query parameters that only track; a name that starts with the first one, or is one of the others.
TRACKING_PREFIX, TRACKING = "utm_", ("ref", "gclid", "fbclid")
#: Seconds of a time bucket.
BUCKET = 3600


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a last slash, the query sorted and without tracking.

    The scheme and the fragment go.  A text without ``://`` stays as it is, a null too.
    """
    bare = F.regexp_replace(url, "#.*$", "")
    parts = [F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)[?]?(.*)$", k) for k in (1, 2, 3)]
    host = F.regexp_replace(F.regexp_replace(F.lower(parts[0]), r"^www[.]", ""), ":(80|443)$", "")
    names = F.filter(F.split(parts[2], "&"), lambda p: (p != "") & ~F.startswith(p, F.lit(TRACKING_PREFIX)) & ~F.regexp_extract(p, "^([^=]*)", 1).isin(*TRACKING))
    query = F.array_join(F.array_sort(names), "&")
    out = F.concat(host, F.regexp_replace(parts[1], "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), out).otherwise(url)


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored header fields, replaced by the fresh ones where a not-modified answer may do so."""
    new = F.map_filter(fresh, lambda k, _: ~k.isin(*KEPT_FIELDS))
    old = F.map_filter(stored, lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(new), k), F.lit(False)))
    return F.map_concat(old, new)


def resolved(records: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(record_id, url_key, at, response_id, status, headers)``, a row for each revisit of ``records``.

    ``records``: ``record_id``, ``url``, ``at`` (seconds), ``kind`` (``response``
    or ``revisit``), ``headers`` (map; field names in lower case).  A revisit
    meets the latest response of its canonical URL that is strictly earlier; of
    several at one time, the one with the largest id.  ``status``: ``resolved``
    if the validators agree (the entity tag, weakly; else the date of the last
    change), ``mismatch`` if they differ, ``unvalidated`` if the revisit has none
    that the response has too, ``orphan`` without an earlier response.  Headers
    are merged if it is resolved, else the revisit's own; null ones are empty.
    Rows with a null URL, time or kind take no part; revisits that repeat come
    back as often; an empty table gives no rows.
    """
    empty = F.expr("cast(map() as map<string, string>)")
    events = records.where("url is not null and at is not null and kind in ('response', 'revisit')").select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("at").cast("long").alias("at"), (F.col("kind") == "response").alias("full"), F.coalesce("headers", empty).alias("headers")
    )
    events = events.withColumn("bucket", F.floor(F.col("at") / bucket))
    seen = F.when(F.col("full"), F.struct("at", "record_id", "headers"))
    last = events.where("full").groupBy("url_key", "bucket").agg(F.max_by(F.struct("at", "record_id", "headers"), F.struct("at", "record_id")).alias("last"))
    buckets = events.select("url_key", "bucket").distinct().join(last, ["url_key", "bucket"], "left")
    earlier = W.partitionBy("url_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = buckets.select("url_key", "bucket", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    within = W.partitionBy("url_key", "bucket").orderBy("at", "full", "record_id").rowsBetween(W.unboundedPreceding, 0)
    met = events.withColumn("near", F.last(seen, ignorenulls=True).over(within)).where("not full").join(carried, ["url_key", "bucket"], "left")
    met = met.withColumn("response", F.coalesce("near", "carried"))
    stored = F.col("response.headers")

    def both(field: str) -> tuple[Column, Column]:
        return tuple(F.regexp_replace(F.try_element_at(h, F.lit(field)), "^W/", "") for h in (F.col("headers"), stored))

    (tag, old_tag), (date, old_date) = both("etag"), both("last-modified")
    status = (
        F.when(F.col("response").isNull(), "orphan")
        .when(tag.isNotNull() & old_tag.isNotNull(), F.when(tag == old_tag, "resolved").otherwise("mismatch"))
        .when(date.isNotNull() & old_date.isNotNull(), F.when(date == old_date, "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    out = met.withColumn("status", status)
    headers = F.when(F.col("status") == "resolved", merged_headers(stored, F.col("headers"))).otherwise(F.col("headers"))
    return out.select("record_id", "url_key", "at", F.col("response.record_id").alias("response_id"), "status", headers.alias("headers"))


def header_text(headers: Column) -> Column:
    """Header fields by name, ``name: value``, joined by ``; ``."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")


def captures(pages: DataFrame) -> DataFrame:
    """Records of a crawl that follow from ``pages``: for each page a full response, and a later revisit of its URL.

    The response is taken ``page_id`` minutes after the start; the revisit some
    hash-picked minutes later.  One revisit of seven has a stale tag, one of
    eleven only a date, and each says anew how long it is fresh.
    """
    pick = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.col("url")).cast("binary")), 1, 7), 16, 10).cast("long")
    tag, day = F.md5(F.col("html").cast("binary")), F.concat(F.lit("day "), (F.length("html") % 28).cast("string"))
    base = pages.select("page_id", "url", tag.alias("tag"), day.alias("day"), F.length("html").cast("string").alias("length"), pick.alias("pick"))
    response = F.create_map(F.lit("etag"), "tag", F.lit("last-modified"), "day", F.lit("content-length"), "length", F.lit("cache-control"), F.lit("max-age=60"), F.lit("server"), F.lit("origin"))
    stale = F.when(F.col("pick") % 7 == 0, "stale").otherwise(F.concat(F.lit("W/"), "tag"))
    age = F.concat(F.lit("max-age="), (F.col("pick") % 1000).cast("string"))
    dated = F.create_map(F.lit("last-modified"), "day", F.lit("content-length"), F.lit("0"), F.lit("cache-control"), age)
    tagged = F.create_map(F.lit("etag"), stale, F.lit("content-length"), F.lit("0"), F.lit("cache-control"), age)
    both = F.array(
        F.struct((F.col("page_id") * 2).alias("record_id"), (F.col("page_id") * 60).alias("at"), F.lit("response").alias("kind"), response.alias("headers")),
        F.struct((F.col("page_id") * 2 + 1).alias("record_id"), (F.col("page_id") * 60 + 60 * (F.col("pick") % 5000)).alias("at"), F.lit("revisit").alias("kind"), F.when(F.col("pick") % 11 == 0, dated).otherwise(tagged).alias("headers")),
    )
    return base.select("url", F.explode(both).alias("x")).select("url", "x.*")


#: The revisits of ``captures(pages)`` in SQL.
REVISITS_SQL = r"""
WITH b AS (
  SELECT page_id, url, md5(html) AS tag, 'day ' || CAST(length(html) % 28 AS VARCHAR) AS dat, CAST(length(html) AS VARCHAR) AS len,
         regexp_replace(url, '#.*$', '') AS bare
  FROM pages),
p AS (
  SELECT *, regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)[?]?(.*)$', 1) AS h,
         regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)[?]?(.*)$', 2) AS pa,
         regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)[?]?(.*)$', 3) AS q
  FROM b),
k AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_') AND regexp_extract(x, '^([^=]*)', 1) NOT IN ('ref', 'gclid', 'fbclid'))), '&') AS qs
  FROM p),
c AS (
  SELECT page_id, tag, dat, len, regexp_replace(regexp_replace(lower(h), '^www[.]', ''), ':(80|443)$', '') || regexp_replace(pa, '/+$', '') || CASE WHEN qs <> '' THEN '?' || qs ELSE '' END AS url_key, url,
         CAST('0x' || substr(md5(CAST(page_id AS VARCHAR) || '|' || url), 1, 7) AS BIGINT) AS pick
  FROM k),
r AS (
  SELECT c.*, page_id * 60 + 60 * (pick % 5000) AS "at" FROM c),
m AS (
  SELECT r.*, f.page_id AS fp, f.tag AS ftag, f.dat AS fdat, f.len AS flen,
         row_number() OVER (PARTITION BY r.page_id ORDER BY f.page_id DESC NULLS LAST) AS rn
  FROM r LEFT JOIN c f ON f.url_key = r.url_key AND f.page_id * 60 < r."at"),
s AS (
  SELECT *, CASE WHEN fp IS NULL THEN 'orphan' WHEN pick % 11 = 0 THEN CASE WHEN dat = fdat THEN 'resolved' ELSE 'mismatch' END
                 WHEN pick % 7 = 0 THEN 'mismatch' WHEN tag = ftag THEN 'resolved' ELSE 'mismatch' END AS status
  FROM m WHERE rn = 1)
SELECT page_id * 2 + 1 AS record_id, url_key, "at", fp * 2 AS response_id, status,
       CASE WHEN status = 'resolved' THEN
              'cache-control: max-age=' || CAST(pick % 1000 AS VARCHAR) || '; content-length: ' || flen
              || '; etag: ' || CASE WHEN pick % 11 = 0 THEN ftag ELSE 'W/' || tag END
              || '; last-modified: ' || fdat || '; server: origin'
            WHEN pick % 11 = 0 THEN 'cache-control: max-age=' || CAST(pick % 1000 AS VARCHAR) || '; content-length: 0; last-modified: ' || dat
            ELSE 'cache-control: max-age=' || CAST(pick % 1000 AS VARCHAR) || '; content-length: 0; etag: ' || CASE WHEN pick % 7 = 0 THEN 'stale' ELSE 'W/' || tag END END AS headers
FROM s
"""
