"""The registered queries of the listing library over the star-schema tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casona.functions import labels as lb
from casona.functions.storage import checkpoint_folder, removed
from casona.operators import detail, prep, search, summary, texts
from casona.operators import preferences as prefs
from casona.operators.requests import requests_counted
from casona.operators.search import ListingQuery
from casona.sources import catalogue as cat
from casona.sources import fx, layout
from casona.streaming import changes, state

USER = 42
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# What the oracle's queries start from: the mapping of casona.sources.catalogue in SQL.
L = """
l AS (
  SELECT o_orderkey AS listing_id, o_orderkey AS position, c_name || ' ' || c_mktsegment AS project,
         CASE WHEN c_acctbal > 0 THEN c_name END AS developer, n_name || ', ' || r_name AS city,
         18 + CAST(o_orderkey * 37 % 3500 AS DOUBLE) / 1000 AS lat, -90 + CAST(o_orderkey * 53 % 3500 AS DOUBLE) / 1000 AS lng,
         CASE WHEN o_orderstatus = 'F' THEN 'Ready to move in' ELSE strftime(o_orderdate, '%b %Y') END AS delivery_date,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Land' WHEN 'HOUSEHOLD' THEN 'Villa' ELSE 'Condo' END AS property_type,
         o_orderkey % 5 AS n_photos
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
U = """
u AS (
  SELECT l_orderkey AS listing_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS unit_seq,
         CASE WHEN l_linenumber = 7 THEN '' ELSE l_orderkey || '-' || l_linenumber END AS unit_label,
         ['Studio', '1BR', '2BR', '3BR', 'Land', '2BR', '4BR'][l_linenumber] AS type, [0, 1, 2, 3, 0, 2, 4][l_linenumber] AS bedrooms,
         CASE WHEN l_linenumber = 5 THEN 0 ELSE CAST([0, 1, 2, 3, 0, 2, 4][l_linenumber] AS DOUBLE) / 2 + 1 END AS bathrooms,
         l_extendedprice AS price, l_quantity AS size, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS available,
         CASE WHEN l_returnflag = 'R' THEN 'MXN' ELSE 'USD' END AS currency, l_linestatus AS raw_status
  FROM lineitem)"""
S = """
s AS (
  SELECT listing_id, min(price) AS min_price, max(price) AS max_price, min(bedrooms) AS min_bedrooms, max(bedrooms) AS max_bedrooms,
         min(size) AS min_size, CAST(sum(available) AS BIGINT) AS available FROM u GROUP BY listing_id)"""
FAV = """
fav AS (
  SELECT user_id, listing_id FROM (
    SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS listing_id FROM events WHERE event_type = 'click')
  GROUP BY user_id, listing_id HAVING count(*) % 2 = 1)"""
FX = """
p AS (
  SELECT event_id, ts, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type = 'purchase'),
f AS (
  SELECT coalesce(max(rate), 18.0) AS rate, max(updated_utc) AS updated_utc, count(*) > 0 AS is_live FROM (
    SELECT CAST(printf('%.2f', 16 + CAST(k AS DOUBLE) / 25) AS DOUBLE) AS rate, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_utc
    FROM p WHERE k % 5 <> 0 AND k % 7 <> 0 AND k % 11 <> 0 ORDER BY ts DESC, event_id DESC LIMIT 1))"""
DIM = """
dim AS (
  SELECT * FROM (VALUES ('Studio', 0, 'Studio'), ('1BR', 1, '1 Bed'), ('2BR', 2, '2 Bed'), ('3BR', 3, '3 Bed'), ('Land', 4, 'Land')) t(type, ord, label))"""
AMEN = """
a AS (SELECT listing_id, list(p_brand ORDER BY p_brand) AS amenities FROM (SELECT DISTINCT l_orderkey AS listing_id, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY listing_id)"""


def plain(x: str, decimals: int = 2) -> str:
    """A number as text with grouping and without trailing zeros."""
    return rf"regexp_replace(format('{{:,.{decimals}f}}', {x}), '\.?0+$', '')"


def usd(x: str) -> str:
    return f"'US $' || {plain(x)}"


def mxn(x: str) -> str:
    return f"'MX $' || format('{{:,}}', CAST(floor({x} * rate + 0.5) AS BIGINT))"


def query(name: str, *ctes: str, sql: str):
    """Registers a query and, over the named parts, its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        SQL[name] = (f"WITH {', '.join(ctes)} {sql}" if ctes else sql).strip()
        return f

    return register


def colours(key: str) -> str:
    """The banner's two colours by a key."""
    lists = [", ".join(f"'{pair[k]}'" for pair in lb.PALETTE) for k in (0, 1)]
    return f"[{lists[0]}][{key} % {len(lb.PALETTE)} + 1] AS colour_from, [{lists[1]}][{key} % {len(lb.PALETTE)} + 1] AS colour_to"


SEARCH_COLUMNS = ("listing_id", "project", "min_price", "available", "rank")


def found(spark: SparkSession, sf_dir: str, q: ListingQuery, favorites: DataFrame | None = None) -> DataFrame:
    listings, units = cat.listings(spark, sf_dir), cat.units(spark, sf_dir)
    return search.ranked(search.matched_summary(listings, units, q, favorites), q.sort).select(*SEARCH_COLUMNS)


def found_sql(listing: str = "true", unit: str = "true", order: str = "position", more: str = "") -> str:
    return f"""
SELECT l.listing_id, project, min_price, available, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank
FROM l JOIN s ON l.listing_id = s.listing_id WHERE {listing} AND l.listing_id IN (SELECT listing_id FROM u WHERE {unit}) {more}"""


@query("search_same_unit", L, U, S, sql=found_sql(unit="type = '2BR' AND price <= 20000", order="min_price, position"))
def search_same_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which listings have a unit of one type at or under a price, cheapest first, and how many units do they hold?"""
    return found(spark, sf_dir, ListingQuery(unit_type="2BR", max_price=20000, sort="price-asc"))


@query("search_bucketed", L, U, S, sql=found_sql(unit="type = '2BR' AND price <= 20000", order="min_price, position"))
def search_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on tables in buckets, which meet where they lie."""
    names = layout.write_bucketed(cat.listings(spark, sf_dir), cat.units(spark, sf_dir), f"{checkpoint_folder(spark)}/buckets-{uuid.uuid4().hex}", 16)
    listings, units = (spark.table(n) for n in names)
    q = ListingQuery(unit_type="2BR", max_price=20000, sort="price-asc")
    return search.ranked(search.matched_summary(listings, units, q), q.sort).select(*SEARCH_COLUMNS)


@query("search_clustered", L, U, sql="SELECT listing_id FROM l WHERE listing_id IN (SELECT listing_id FROM u WHERE type = '1BR' AND price >= 10000 AND price <= 12000)")
def search_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search of units that lie along a curve of type and price."""
    folder = f"{checkpoint_folder(spark)}/clustered-{uuid.uuid4().hex}"
    layout.write_clustered(cat.units(spark, sf_dir), folder)
    q = ListingQuery(unit_type="1BR", min_price=10000, max_price=12000)
    return search.matched(cat.listings(spark, sf_dir), spark.read.parquet(folder), q).select("listing_id")


@query("search_text", L, U, S, sql=found_sql(listing="(contains(lower(project), 'machin') OR contains(lower(city), 'machin'))"))
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir, ListingQuery(text="  MACHIN "))


@query("search_predicates", L, U, S, sql=found_sql("property_type = 'Villa' AND city LIKE '%, ASIA'", "bathrooms >= 1.5 AND price >= 10000 AND price <= 60000", "min_price DESC, position"))
def search_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, region, bathrooms and both price bounds, dearest first."""
    listings, units = cat.listings(spark, sf_dir).where(F.endswith(F.col("city"), F.lit(", ASIA"))), cat.units(spark, sf_dir)
    q = ListingQuery(property_type="Villa", min_bathrooms=1.5, min_price=10000, max_price=60000, sort="price-desc")
    return search.ranked(search.matched_summary(listings, units, q), q.sort).select(*SEARCH_COLUMNS)


@query("search_city", L, U, S, sql=found_sql("city = (SELECT min(n_name || ', ' || r_name) FROM nation JOIN region ON n_regionkey = r_regionkey)"))
def search_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city: the first in order."""
    n, r = cat.table(spark, sf_dir, "nation"), cat.table(spark, sf_dir, "region")
    first = n.join(r, n["n_regionkey"] == r["r_regionkey"]).agg(F.min(F.concat("n_name", F.lit(", "), "r_name"))).first()[0]
    return found(spark, sf_dir, ListingQuery(city=first))


@query("search_favorites", L, U, S, FAV, sql=found_sql(order="min_price, position", more=f"AND l.listing_id IN (SELECT listing_id FROM fav WHERE user_id = {USER})"))
def search_favorites(spark: SparkSession, sf_dir: str) -> DataFrame:
    favorites = prefs.favorites_from_toggles(cat.toggles(spark, sf_dir))
    return found(spark, sf_dir, ListingQuery(favorites_of=USER, sort="price-asc"), favorites)


@query("search_reset", L, U, S, sql=found_sql())
def search_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing asked: every listing that has units, in catalogue order."""
    return found(spark, sf_dir, ListingQuery())


@query("search_nested", L, U, sql="SELECT listing_id FROM l WHERE listing_id IN (SELECT listing_id FROM u WHERE type = '3BR' AND price <= 20000)")
def search_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search over units nested in their listing."""
    nested = cat.nested(cat.listings(spark, sf_dir), cat.units(spark, sf_dir))
    return search.matched_nested(nested, ListingQuery(unit_type="3BR", max_price=20000)).select("listing_id")


@query("visibility_flag", L, U, sql="SELECT listing_id, listing_id IN (SELECT listing_id FROM u WHERE type = '3BR' AND price <= 20000) AS visible FROM l")
def visibility_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings, units = cat.listings(spark, sf_dir), cat.units(spark, sf_dir)
    return search.visibility(listings, search.matched(listings, units, ListingQuery(unit_type="3BR", max_price=20000))).select("listing_id", "visible")


@query(
    "results_header", L, U, S,
    sql="""SELECT count(*) AS n_listings, CAST(coalesce(sum(available), 0) AS BIGINT) AS n_units,
       count(*) || CASE WHEN count(*) = 1 THEN ' Listing / ' ELSE ' Listings / ' END || CAST(coalesce(sum(available), 0) AS BIGINT) || ' Units matching your search' AS header
FROM s WHERE listing_id IN (SELECT listing_id FROM u WHERE type = '2BR' AND price <= 20000) AND listing_id IN (SELECT listing_id FROM l)""",
)
def results_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.header(search.matched_summary(cat.listings(spark, sf_dir), cat.units(spark, sf_dir), ListingQuery(unit_type="2BR", max_price=20000)))


@query("listing_summary", L, U, S, sql="SELECT l.listing_id, min_price, max_price, min_bedrooms, max_bedrooms, min_size, coalesce(available, 0) AS available FROM l LEFT JOIN s ON l.listing_id = s.listing_id")
def listing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.listing_summary(cat.listings(spark, sf_dir).select("listing_id"), cat.units(spark, sf_dir))


@query("unit_type_counts", U, sql="SELECT listing_id, type, CAST(sum(available) AS BIGINT) AS available FROM u GROUP BY ALL")
def unit_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.unit_type_counts(cat.units(spark, sf_dir))


@query(
    "unit_tabs_grouping_sets", U, DIM,
    sql="""SELECT listing_id, -1 AS ord, 'All' AS label, CAST(sum(available) AS BIGINT) AS available FROM u GROUP BY listing_id
UNION ALL SELECT listing_id, ord, label, CAST(sum(available) AS BIGINT) FROM u JOIN dim USING (type) GROUP BY listing_id, ord, label""",
)
def unit_tabs_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.unit_tabs(cat.units(spark, sf_dir))


BEDS = r"b AS (SELECT listing_id, regexp_replace(string_agg(label, ', ' ORDER BY ord), ',([^,]*)$', ' &\1') AS bed_summary FROM (SELECT DISTINCT listing_id, type FROM u) JOIN dim USING (type) GROUP BY listing_id)"


@query("bed_summary", U, DIM, BEDS, sql="SELECT * FROM b")
def bed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.bed_summary(cat.units(spark, sf_dir))


@query("distinct_cities", L, sql="SELECT DISTINCT city FROM l ORDER BY city")
def distinct_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.distinct_cities(cat.listings(spark, sf_dir))


@query(
    "text_labels", L,
    sql=r"""SELECT listing_id,
  CASE WHEN regexp_matches(delivery_date, '(?i)ready') THEN 'Now'
       WHEN regexp_matches(delivery_date, '([A-Za-z]+)\.?\s+(\d{4})') THEN substr(regexp_extract(delivery_date, '([A-Za-z]+)\.?\s+(\d{4})', 1), 1, 3) || ' ' || substr(regexp_extract(delivery_date, '([A-Za-z]+)\.?\s+(\d{4})', 2), 3, 2)
       ELSE delivery_date END AS delivery_label,
  upper(substr(split_part(project, ' ', 1), 1, 1) || substr(split_part(project, ' ', 2), 1, 1)) AS initials,
  trim(split_part(city, ',', 1)) AS city_part, trim(split_part(city, ',', 2)) AS state_part,
  """ + colours("listing_id") + """,
  coalesce(developer, 'Developer not confirmed') AS developer
FROM l""",
)
def text_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    city, state = lb.state_of(F.col("city"))
    colours = lb.palette(F.col("listing_id"))
    return cat.listings(spark, sf_dir).select(
        "listing_id",
        lb.short_delivery(F.col("delivery_date")).alias("delivery_label"),
        lb.initials(F.col("project")).alias("initials"),
        city.alias("city_part"),
        state.alias("state_part"),
        colours[0].alias("colour_from"),
        colours[1].alias("colour_to"),
        prep.developer_name(F.col("developer")).alias("developer"),
    )


BED_RANGE = "CASE WHEN property_type = 'Land' THEN 'Land' WHEN min_bedrooms = 0 AND max_bedrooms = 0 THEN 'Studio' WHEN min_bedrooms = max_bedrooms THEN max_bedrooms || ' Bed' ELSE CASE WHEN min_bedrooms = 0 THEN 'Studio' ELSE min_bedrooms || ' Bed' END || ' - ' || max_bedrooms || ' Bed' END"
SIZE_FROM = f"'From ' || {plain('min_size')} || 'm² / ' || replace({plain('floor(min_size * 10.7639 * 100 + 0.5) / 100')}, ',', '') || 'ft²'"


@query(
    "card_projection", L, U, S, FAV, AMEN,
    sql=rf"""SELECT l.listing_id, position, available || ' units available' AS header,
  upper(substr(split_part(project, ' ', 1), 1, 1) || substr(split_part(project, ' ', 2), 1, 1)) AS initials,
  CASE WHEN n_photos > 0 THEN 'https://lh3.googleusercontent.com/d/photo-' || l.listing_id || '-1=w500' END AS photo,
  {colours("l.listing_id")},
  property_type, l.listing_id IN (SELECT listing_id FROM fav WHERE user_id = {USER}) AS favorite, delivery_date, project,
  'From ' || {usd('min_price')} AS price, {BED_RANGE} AS beds, {SIZE_FROM} AS size, city || ', Mexico' AS address,
  array_to_string(amenities[1:4], '|') AS pills, greatest(len(amenities) - 4, 0) AS remaining,
  CASE WHEN len(amenities) > 4 THEN '+' || (len(amenities) - 4) || ' more amenities' ELSE '' END AS more_label
FROM l JOIN s ON l.listing_id = s.listing_id JOIN a ON a.listing_id = l.listing_id
WHERE l.listing_id IN (SELECT listing_id FROM u WHERE type = '1BR' AND price <= 40000)""",
)
def card_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cards of a search, with one user's favorites."""
    listings, units = cat.listings(spark, sf_dir), cat.units(spark, sf_dir)
    rows = search.matched_summary(listings, units, ListingQuery(unit_type="1BR", max_price=40000)).join(cat.amenities(spark, sf_dir), "listing_id", "left")
    favorites = prefs.favorites_from_toggles(cat.toggles(spark, sf_dir))
    return detail.cards(detail.with_favorite(rows, favorites, USER), fx.current_rate(cat.fx_payloads(spark, sf_dir)))


@query(
    "marker_popup", L, U, S, FX,
    sql=rf"""SELECT l.listing_id, lat, lng,
  CASE WHEN regexp_matches(delivery_date, '(?i)ready') THEN 'Now'
       WHEN regexp_matches(delivery_date, '([A-Za-z]+)\.?\s+(\d{{4}})') THEN substr(regexp_extract(delivery_date, '([A-Za-z]+)\.?\s+(\d{{4}})', 1), 1, 3) || ' ' || substr(regexp_extract(delivery_date, '([A-Za-z]+)\.?\s+(\d{{4}})', 2), 3, 2)
       ELSE delivery_date END AS label,
  project, CASE WHEN min_price = max_price THEN {mxn('min_price')} ELSE {mxn('min_price')} || ' – ' || {mxn('max_price')} END AS price,
  'detail.html?id=' || l.listing_id AS link
FROM l LEFT JOIN s ON l.listing_id = s.listing_id CROSS JOIN f""",
)
def marker_popup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All markers, with prices in MXN; listings without units have none."""
    rows = summary.listing_summary(cat.listings(spark, sf_dir), cat.units(spark, sf_dir))
    return detail.markers(rows, fx.current_rate(cat.fx_payloads(spark, sf_dir)), "MXN")


@query("unit_rows", U, sql="SELECT listing_id, CAST(unit_seq AS INTEGER) AS unit_seq, CASE WHEN unit_label = '' THEN type ELSE unit_label END AS label, type, bedrooms, bathrooms, size, price FROM u")
def unit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail.unit_rows(cat.units(spark, sf_dir))


UNIT_TABLE = f"""SELECT listing_id, CAST(unit_seq AS INTEGER) AS unit_seq, CASE WHEN unit_label = '' THEN type ELSE unit_label END AS label,
  CASE WHEN type = 'Land' THEN 'Land' WHEN bedrooms = 0 THEN 'Studio' ELSE CAST(bedrooms AS VARCHAR) END AS bed,
  CASE WHEN type = 'Land' THEN '—' ELSE {plain('bathrooms')} END AS bath, {plain('size')} || ' m²' AS size, @price AS price, 'Available' AS status
FROM u"""


@query("unit_table", U, sql=UNIT_TABLE.replace("@price", usd("price")))
def unit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail.unit_table(cat.units(spark, sf_dir), fx.current_rate(cat.fx_payloads(spark, sf_dir)))


@query("unit_table_by_type", U, FX, sql=UNIT_TABLE.replace("@price", mxn("price")) + " CROSS JOIN f WHERE type = '2BR'")
def unit_table_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail.unit_table(cat.units(spark, sf_dir), fx.current_rate(cat.fx_payloads(spark, sf_dir)), "2BR", "MXN")


@query(
    "facts", L, U, S, DIM, BEDS,
    sql="""SELECT l.listing_id, trim(split_part(city, ',', 1)) AS city_part, trim(split_part(city, ',', 2)) AS state_part, city || ', Mexico' AS city_line,
  coalesce(available, 0) || ' / ' || CAST(coalesce(available, 0) + floor(coalesce(available, 0) * 0.25 + 0.5) AS BIGINT) AS units_line,
  CAST(coalesce(available, 0) + floor(coalesce(available, 0) * 0.25 + 0.5) AS BIGINT) AS total_units_placeholder, property_type,
  coalesce(bed_summary, '') AS bed_summary, 'Available · Earliest Delivery: ' || delivery_date AS status_line, '✓ Phase 1: Delivery ' || delivery_date AS phase_line
FROM l LEFT JOIN s ON l.listing_id = s.listing_id LEFT JOIN b ON l.listing_id = b.listing_id""",
)
def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = cat.units(spark, sf_dir)
    return detail.facts(summary.listing_summary(cat.listings(spark, sf_dir), units), units)


@query("page_title", L, sql="SELECT listing_id, project || ' — Listings' AS title FROM l")
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.listings(spark, sf_dir).select("listing_id", lb.page_title(F.col("project"), "Listings").alias("title"))


@query(
    "gallery", L,
    sql="""SELECT listing_id, CASE WHEN n_photos > 0 THEN 'https://lh3.googleusercontent.com/d/photo-' || listing_id || '-1=w800' END AS main,
  CASE n_photos WHEN 0 THEN 'Exterior|Interior|Amenities' WHEN 1 THEN '' ELSE array_to_string([('photo-' || listing_id || '-' || k) FOR k IN range(2, n_photos + 1)], '|') END AS thumbs,
  CASE WHEN n_photos > 0 THEN '1 / ' || n_photos ELSE '' END AS counter
FROM l""",
)
def gallery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail.gallery(cat.listings(spark, sf_dir))


@query(
    "amenity_prefix", AMEN,
    sql="""SELECT listing_id, array_to_string(amenities[1:4], '|') AS few, greatest(len(amenities) - 4, 0) AS remaining,
  CASE WHEN len(amenities) > 4 THEN '+' || (len(amenities) - 4) || ' more amenities' ELSE '' END AS more_label,
  array_to_string(amenities, '|') AS all_of_them, CASE WHEN len(amenities) > 4 THEN 'Show less' ELSE '' END AS less_label
FROM a""",
)
def amenity_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cat.amenities(spark, sf_dir)
    few = detail.amenity_pills(rows).select("listing_id", F.array_join("shown", "|").alias("few"), "remaining", "more_label")
    every = detail.amenity_pills(rows, expanded=True).select("listing_id", F.array_join("shown", "|").alias("all_of_them"), F.col("more_label").alias("less_label"))
    return few.join(every, "listing_id")


ICONS = ", ".join(f"'{a}'" for a in lb.ICON_AMENITIES)


@query(
    "amenity_icons", AMEN,
    sql=f"""SELECT listing_id, CAST(k - 1 AS INTEGER) AS seq, amenities[k] AS amenity, list_contains([{ICONS}], amenities[k]) AS has_icon
FROM (SELECT listing_id, amenities, unnest(range(1, len(amenities) + 1)) AS k FROM (SELECT listing_id, list_concat([[{ICONS}][listing_id % {len(lb.ICON_AMENITIES)} + 1]], amenities) AS amenities FROM a))""",
)
def amenity_icons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listing's brands, and before them an amenity that has an icon, picked by its id, with whether there is one."""
    known = F.get(F.array(*[F.lit(a) for a in lb.ICON_AMENITIES]), (F.col("listing_id") % len(lb.ICON_AMENITIES)).cast("int"))
    return detail.amenity_icons(cat.amenities(spark, sf_dir).withColumn("amenities", F.concat(F.array(known), "amenities")))


@query(
    "listing_text", AMEN,
    sql="""SELECT o_orderkey AS listing_id, 'Offer ' || o_orderkey || ' of ' || c_name AS description, CAST(k - 1 AS INTEGER) AS seq, amenities[k] AS amenity
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT listing_id, amenities, unnest(range(1, len(amenities) + 1)) AS k FROM a) x ON x.listing_id = o_orderkey""",
)
def listing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail.listing_text(cat.listings(spark, sf_dir).join(cat.amenities(spark, sf_dir), "listing_id", "left"))


@query(
    "price_labels_usd_mxn", U, S, FX,
    sql=f"""SELECT listing_id, CASE WHEN min_price = max_price THEN {usd('min_price')} ELSE {usd('min_price')} || ' – ' || {usd('max_price')} END AS usd,
  CASE WHEN min_price = max_price THEN {mxn('min_price')} ELSE {mxn('min_price')} || ' – ' || {mxn('max_price')} END AS mxn FROM s CROSS JOIN f""",
)
def price_labels_usd_mxn(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = summary.unit_summary(cat.units(spark, sf_dir)).crossJoin(F.broadcast(fx.current_rate(cat.fx_payloads(spark, sf_dir))))
    label = lambda c: lb.price_range(F.col("min_price"), F.col("max_price"), F.col("rate"), F.lit(c))
    return x.select("listing_id", label("USD").alias("usd"), label("MXN").alias("mxn"))


FX_SQL = "SELECT rate, updated_utc, is_live, '1 USD = ' || printf('%.2f', rate) || ' MXN' || CASE WHEN is_live THEN ' (live)' ELSE ' (offline estimate)' END AS label FROM f"


@query("fx_latest_or_fallback", FX, sql=FX_SQL)
def fx_latest_or_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.current_rate(cat.fx_payloads(spark, sf_dir)).withColumn("label", lb.rate_label(F.col("rate"), F.col("is_live")))


@query("favorites_current", FAV, sql="SELECT * FROM fav")
def favorites_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefs.favorites_from_toggles(cat.toggles(spark, sf_dir))


@query("favorites_saved_and_loaded", FAV, sql="SELECT * FROM fav")
def favorites_saved_and_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from the texts that were written."""
    path = f"{checkpoint_folder(spark)}/favorites-{uuid.uuid4().hex}"
    prefs.save_favorites(cat.toggles(spark, sf_dir), path)
    return prefs.load_favorites(layout.read_version(spark, path))


@query("favorites_in_search", U, FAV, sql="SELECT user_id, CAST(count(h.listing_id) AS BIGINT) AS n_found FROM fav LEFT JOIN (SELECT DISTINCT listing_id FROM u WHERE type = '2BR' AND price <= 40000) h USING (listing_id) GROUP BY user_id")
def favorites_in_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of every user's favorites a search finds, by bitmaps."""
    found = search.matched(cat.listings(spark, sf_dir), cat.units(spark, sf_dir), ListingQuery(unit_type="2BR", max_price=40000))
    return prefs.favorites_found(found, prefs.favorite_bitmaps(prefs.favorites_from_toggles(cat.toggles(spark, sf_dir))))


def event_stream(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Events of a kind as they land, with their number ``k``."""
    events = spark.readStream.schema(cat.table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    return cat.numbered(events.where(F.col("event_type") == kind))


@query("fx_stream", FX, sql="SELECT rate, updated_utc FROM f")
def fx_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest valid rate of a stream of payloads."""
    return state.run_to_end(state.last_rates(cat.payloads_of(event_stream(spark, sf_dir, "purchase"))), []).select("x.rate", "x.updated_utc")


@query("fx_stream_prices", U, S, FX, sql=f"SELECT listing_id, rate, {mxn('min_price')} AS price FROM s CROSS JOIN f")
def fx_stream_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing's lowest price at the rate that a stream of payloads leaves."""
    prices = summary.unit_summary(cat.units(spark, sf_dir)).select("listing_id", "min_price")
    rows = state.prices_at_rates(cat.payloads_of(event_stream(spark, sf_dir, "purchase")), prices)
    return rows.select("listing_id", "rate", lb.price_mxn(F.col("min_price"), F.col("rate")).alias("price"))


@query("favorites_stream", FAV, sql="SELECT * FROM fav")
def favorites_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of events."""
    clicks = cat.toggles_of(event_stream(spark, sf_dir, "click"))
    return state.run_to_end(state.favorite_changes(clicks), ["user_id", "listing_id"]).where("favorite").select("user_id", "listing_id")


def log_of_changes(spark: SparkSession, sf_dir: str) -> str:
    """The log of a stream of changes of units, which land in files in no order, a third of them at a time."""
    folder = f"{checkpoint_folder(spark)}/landed-{uuid.uuid4().hex}"
    third = max(2, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 3))
    cat.unit_changes(spark, sf_dir).repartition(3 * third, F.xxhash64("listing_id", "unit_seq", "version")).write.parquet(folder)
    log = changes.written_log(spark.readStream.schema(changes.CHANGES).option("maxFilesPerTrigger", third).parquet(folder))
    removed(spark, folder)
    return log


#: What the changes leave.
LEFT = """
u AS (
  SELECT listing_id, unit_seq, type, bedrooms, bathrooms, CASE WHEN unit_seq = 2 THEN price + 7 WHEN listing_id % 3 = 0 THEN price + 1000 ELSE price END AS price, size,
         CASE WHEN unit_seq <> 2 AND listing_id % 3 = 0 THEN 2 ELSE available END AS available
  FROM u0 WHERE unit_seq <> 2 OR listing_id % 5 = 0)"""
U0 = U.replace("u AS (", "u0 AS (", 1)


@query(
    "rollup_stream", U0, LEFT, S,
    sql="""SELECT s.*, units, tabs FROM s JOIN (SELECT listing_id, count(*) AS units FROM u GROUP BY listing_id) USING (listing_id)
JOIN (SELECT listing_id, string_agg(type || ':' || n, ',' ORDER BY encode(type)) AS tabs FROM (SELECT listing_id, type, CAST(sum(available) AS BIGINT) AS n FROM u GROUP BY ALL) GROUP BY listing_id) USING (listing_id)""",
)
def rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing's roll-up, kept by deltas, after a stream of changes."""
    return changes.rollups(changes.log_stream(spark, log_of_changes(spark, sf_dir)))


CHOICES = """
c AS (
  SELECT user_id, ts, event_id, CASE CAST(json_extract(props, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'MXN' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency
  FROM events WHERE event_type = 'view')"""


@query("currency_current", CHOICES, sql="SELECT user_id, CASE WHEN currency = 'MXN' THEN 'MXN' ELSE 'USD' END AS currency FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM c) WHERE n = 1")
def currency_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefs.current_currency(cat.currency_choices(spark, sf_dir))


@query("currency_stream", CHOICES, sql="SELECT user_id, CASE WHEN currency = 'MXN' THEN 'MXN' ELSE 'USD' END AS currency FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM c) WHERE n = 1")
def currency_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = state.run_to_end(state.last_choices(cat.choices_of(event_stream(spark, sf_dir, "view"))), ["user_id"])
    return last.select("user_id", F.when(F.col("last") == "MXN", "MXN").otherwise("USD").alias("currency"))


@query(
    "currency_changes", CHOICES,
    sql="""SELECT event_id, user_id, currency FROM (
  SELECT *, coalesce(lag(currency) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'USD') AS before
  FROM (SELECT event_id, ts, user_id, CASE WHEN currency = 'MXN' THEN 'MXN' ELSE 'USD' END AS currency FROM c)) WHERE currency <> before""",
)
def currency_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefs.currency_changes(cat.currency_choices(spark, sf_dir)).select("event_id", "user_id", "currency")


@query(
    "id_lookup_found", L,
    sql="""SELECT request_id, id, project, project IS NOT NULL AS found FROM (
  SELECT page_id AS request_id, CASE page_id % 7 WHEN 0 THEN 0.0 WHEN 1 THEN NULL WHEN 2 THEN 0.0 WHEN 3 THEN CAST(page_id AS DOUBLE) ELSE CAST(page_id * 1000 AS DOUBLE) END AS id FROM pages)
LEFT JOIN l ON CAST(listing_id AS DOUBLE) = id""",
)
def id_lookup_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail.requested(cat.page_requests(spark, sf_dir), cat.listings(spark, sf_dir))


@query("prep_available_usd", U, sql="SELECT listing_id, unit_label, type, CASE WHEN currency = 'MXN' THEN floor(price / 18.0 + 0.5) ELSE price END AS price FROM u WHERE raw_status = 'O'")
def prep_available_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.available_units(cat.raw_units(spark, sf_dir)).select("listing_id", "unit_label", "type", "price")


MARKS = "m AS (SELECT r_name AS category, n_name AS name, 18 + CAST(n_nationkey * 7 % 35 AS DOUBLE) / 10 AS mlat, -90 + CAST(n_nationkey * 11 % 35 AS DOUBLE) / 10 AS mlng FROM nation JOIN region ON n_regionkey = r_regionkey)"
NEAREST = """
d AS (
  SELECT listing_id, category, name, 2 * 6371.0088 * asin(sqrt(least(pow(sin((radians(mlat) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(mlat)) * pow(sin(radians(mlng - lng) / 2), 2), 1.0))) AS km
  FROM l CROSS JOIN m),
g AS (SELECT listing_id, category, name, floor(km * 10 + 0.5) / 10 AS distance_km, row_number() OVER (PARTITION BY listing_id, category ORDER BY km, name) AS n FROM d)"""


@query("nearest_landmark", L, MARKS, NEAREST, sql="SELECT listing_id, category, name, distance_km FROM g WHERE n = 1")
def nearest_landmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.nearest_landmarks(cat.listings(spark, sf_dir), cat.landmarks(spark, sf_dir))


@query("nearest_landmark_grid", L, MARKS, NEAREST, sql="SELECT listing_id, category, name, distance_km FROM g WHERE n = 1")
def nearest_landmark_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.nearest_by_grid(cat.listings(spark, sf_dir), cat.landmarks(spark, sf_dir))


@query(
    "nearest_landmark_missing", L.replace("18 + CAST(o_orderkey * 37", "CASE WHEN o_orderkey % 11 <> 3 THEN 1 END * 18 + CAST(o_orderkey * 37"), MARKS, NEAREST,
    sql="SELECT listing_id, category, name, distance_km FROM g WHERE n = 1 AND listing_id % 11 <> 3",
)
def nearest_landmark_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some listings have no latitude: they are near nothing."""
    lat = F.when(F.col("listing_id") % 11 != 3, F.col("lat"))
    return prep.nearest_landmarks(cat.listings(spark, sf_dir).withColumn("lat", lat), cat.landmarks(spark, sf_dir))


@query("poi_rows", L, MARKS, NEAREST, sql=f"SELECT listing_id, CAST(row_number() OVER (PARTITION BY listing_id ORDER BY category) AS INTEGER) AS seq, category AS label, name, {plain('distance_km', 1)} || ' km' AS distance FROM g WHERE n = 1")
def poi_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest landmarks as the points of interest of a listing."""
    near = prep.nearest_landmarks(cat.listings(spark, sf_dir), cat.landmarks(spark, sf_dir))
    poi = near.groupBy("listing_id").agg(F.sort_array(F.collect_list(F.struct("category", "name", "distance_km"))).alias("p")).select("listing_id", F.posexplode("p").alias("seq", "p"))
    return detail.poi_rows(poi.select("listing_id", (F.col("seq") + 1).alias("seq"), F.col("p.category").alias("label"), "p.name", "p.distance_km"))


@query(
    "snapshot_diff", U,
    sql="""SELECT coalesce(a.listing_id, b.listing_id) AS listing_id, coalesce(a.unit_label, b.unit_label) AS unit_label,
  CASE WHEN a.listing_id IS NULL THEN 'added' WHEN b.listing_id IS NULL THEN 'removed' ELSE 'price-changed' END AS change, a.price AS old_price, b.price AS new_price
FROM (SELECT listing_id, listing_id || '/' || unit_seq AS unit_label, price FROM u WHERE unit_seq <> 3) a
FULL JOIN (SELECT listing_id, listing_id || '/' || unit_seq AS unit_label, CASE WHEN type = 'Studio' THEN price + 1000 ELSE price END AS price FROM u WHERE unit_seq <> 2) b
ON a.listing_id = b.listing_id AND a.unit_label = b.unit_label
WHERE a.listing_id IS NULL OR b.listing_id IS NULL OR a.price IS DISTINCT FROM b.price""",
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months of one price list: each listing's third unit is new, its second gone, and studios cost more."""
    units = cat.units(spark, sf_dir).withColumn("unit_label", F.concat(F.col("listing_id").cast("string"), F.lit("/"), F.col("unit_seq").cast("string")))
    dearer = F.when(F.col("type") == "Studio", F.col("price") + 1000).otherwise(F.col("price"))
    return prep.snapshot_diff(units.where("unit_seq <> 3"), units.where("unit_seq <> 2").withColumn("price", dearer))


@query(
    "snapshot_diff_digests", U,
    sql="""SELECT coalesce(a.listing_id, b.listing_id) AS listing_id, coalesce(a.unit_label, b.unit_label) AS unit_label,
  CASE WHEN a.listing_id IS NULL THEN 'added' WHEN b.listing_id IS NULL THEN 'removed' ELSE 'price-changed' END AS change, a.price AS old_price, b.price AS new_price
FROM (SELECT listing_id, listing_id || '/' || unit_seq AS unit_label, price FROM u WHERE listing_id % 1000 <> 7) a
FULL JOIN (SELECT listing_id, listing_id || '/' || unit_seq AS unit_label, CASE WHEN listing_id % 1000 = 33 THEN price + 1 ELSE price END AS price FROM u WHERE listing_id % 1000 <> 65) b
ON a.listing_id = b.listing_id AND a.unit_label = b.unit_label
WHERE a.listing_id IS NULL OR b.listing_id IS NULL OR a.price IS DISTINCT FROM b.price""",
)
def snapshot_diff_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months with few changes: what differs is found by digests of ranges, and only that is compared."""
    units = cat.units(spark, sf_dir).select("listing_id", F.concat(F.col("listing_id").cast("string"), F.lit("/"), F.col("unit_seq").cast("string")).alias("unit_label"), "price")
    key = F.col("listing_id") % 1000
    folder = f"{checkpoint_folder(spark)}/months-{uuid.uuid4().hex}"
    layout.write_digested(units.where(key != 7), f"{folder}/before")
    layout.write_digested(units.where(key != 65).withColumn("price", F.when(key == 33, F.col("price") + 1).otherwise(F.col("price"))), f"{folder}/after")
    return prep.snapshot_diff(*layout.changed_rows(spark, f"{folder}/before", f"{folder}/after"))


def search_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search for each nation: by its name, with bounds that follow from its key."""
    n = cat.table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    types = F.array(*[F.lit(t) for t in ("Studio", "1BR", "2BR", "3BR")])
    return n.select(
        key.cast("long").alias("request_id"),
        F.when(key % 3 == 0, F.concat(F.lit("  "), F.upper("n_name"))).alias("q"),
        F.when(key % 4 == 1, "Condo").alias("property_type"),
        F.lit(None).cast("string").alias("city"),
        F.when(key % 5 < 4, F.get(types, key % 5)).alias("unit_type"),
        F.when(key % 2 == 0, F.lit(1.5)).alias("min_bathrooms"),
        F.when(key % 7 == 0, F.lit(5000.0)).alias("min_price"),
        F.when(key % 6 != 0, (20000 + key * 1000).cast("double")).alias("max_price"),
    )


@query(
    "form_requests",
    sql="""SELECT c_custkey AS request_id, CAST(NULL AS VARCHAR) AS q, c_mktsegment AS property_type, CAST(NULL AS VARCHAR) AS city, CASE WHEN c_custkey % 2 = 0 THEN '2BR' END AS unit_type,
  CASE c_custkey % 4 WHEN 0 THEN CAST(1.5 AS DOUBLE) WHEN 3 THEN 0.5 END AS min_bathrooms, CAST(NULL AS DOUBLE) AS min_price, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS DOUBLE) WHEN 1 THEN CAST(c_custkey AS DOUBLE) * 1000 END AS max_price
FROM customer""",
)
def form_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of the texts of forms, one for each customer; some texts are empty or no number."""
    key = F.col("c_custkey")
    text = key.cast("string")
    forms = cat.table(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        F.lit("").alias("q"),
        F.col("c_mktsegment").alias("property_type"),
        F.lit("").alias("city"),
        F.when(key % 2 == 0, "2BR").otherwise("").alias("unit_type"),
        F.when(key % 4 == 0, " 1.5 ").when(key % 4 == 1, "").when(key % 4 == 2, "two").otherwise(".5").alias("min_bathrooms"),
        F.lit("NaN").alias("min_price"),
        F.when(key % 3 == 0, text).when(key % 3 == 1, F.concat(text, F.lit("e3"))).otherwise(F.concat(text, F.lit(" USD"))).alias("max_price"),
    )
    return search.requests_of_forms(forms)


@query(
    "multi_request_counts", L, U, S,
    sql="""SELECT CAST(n_nationkey AS BIGINT) AS request_id, count(l.listing_id) AS n_listings, CAST(coalesce(sum(s.available), 0) AS BIGINT) AS n_units
FROM nation LEFT JOIN (
  SELECT DISTINCT k.n_nationkey AS r, u.listing_id FROM nation k JOIN u ON
    (k.n_nationkey % 5 = 4 OR u.type = ['Studio', '1BR', '2BR', '3BR'][k.n_nationkey % 5 + 1]) AND (k.n_nationkey % 2 <> 0 OR u.bathrooms >= 1.5)
    AND (k.n_nationkey % 7 <> 0 OR u.price >= 5000) AND (k.n_nationkey % 6 = 0 OR u.price <= 20000 + k.n_nationkey * 1000)) h ON h.r = n_nationkey
LEFT JOIN l ON l.listing_id = h.listing_id AND (n_nationkey % 3 <> 0 OR contains(lower(l.project), lower(n_name)) OR contains(lower(l.city), lower(n_name))) AND (n_nationkey % 4 <> 1 OR l.property_type = 'Condo')
LEFT JOIN s ON s.listing_id = l.listing_id GROUP BY n_nationkey""",
)
def multi_request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.requests_matched(search_requests(spark, sf_dir), cat.listings(spark, sf_dir), cat.units(spark, sf_dir))


@query("standing_request_counts", L, U0, LEFT, S, sql=SQL["multi_request_counts"].removeprefix(f"WITH {L}, {U}, {S}"))
def standing_request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests, whose counts follow a stream of changes."""
    log = changes.log_stream(spark, log_of_changes(spark, sf_dir))
    return changes.standing_counts(log, search_requests(spark, sf_dir), cat.listings(spark, sf_dir))


@query("multi_request_index", sql=SQL["multi_request_counts"])
def multi_request_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests by the index of what they ask for."""
    return requests_counted(search_requests(spark, sf_dir), cat.listings(spark, sf_dir), cat.units(spark, sf_dir))


#: Bounds of prices that follow from a customer: some have one bound, some none, some an empty range.
PRICE_REQUESTS = """
r AS (
  SELECT c_custkey AS request_id, CASE WHEN c_custkey % 10 <> 3 THEN floor(abs(c_acctbal) * 9) END AS low,
         CASE WHEN c_custkey % 10 < 8 THEN floor(abs(c_acctbal) * 9) + c_custkey % 7 * 300 - 100 END AS high FROM customer)"""


@query(
    "price_request_counts", L, U, S, PRICE_REQUESTS,
    sql="""SELECT CAST(r.request_id AS BIGINT) AS request_id, count(s.listing_id) AS n_listings, CAST(coalesce(sum(s.available), 0) AS BIGINT) AS n_units
FROM r LEFT JOIN (SELECT DISTINCT request_id, listing_id FROM r JOIN u ON price >= coalesce(low, -1) AND price <= coalesce(high, 1e12)) h ON h.request_id = r.request_id
LEFT JOIN s ON s.listing_id = h.listing_id AND s.listing_id IN (SELECT listing_id FROM l) GROUP BY r.request_id""",
)
def price_request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search for each customer that asks for a range of prices alone."""
    key, low = F.col("c_custkey"), F.floor(F.abs("c_acctbal") * 9).cast("double")
    text = F.lit(None).cast("string")
    requests = cat.table(spark, sf_dir, "customer").select(
        key.cast("long").alias("request_id"),
        *[text.alias(c) for c in search.ASKED[:4]],
        F.lit(None).cast("double").alias("min_bathrooms"),
        F.when(key % 10 != 3, low).alias("min_price"),
        F.when(key % 10 < 8, low + key % 7 * 300 - 100).alias("max_price"),
    )
    return requests_counted(requests, cat.listings(spark, sf_dir), cat.units(spark, sf_dir))


def text_index(spark: SparkSession, sf_dir: str) -> str:
    """The folder of an index of all listings' texts."""
    folder = f"{checkpoint_folder(spark)}/grams-{uuid.uuid4().hex}"
    texts.write_index(cat.listings(spark, sf_dir), folder)
    return folder


@query("search_text_index", L, U, S, sql=found_sql(listing="(contains(lower(project), 'er#000000') OR contains(lower(city), 'er#000000'))"))
def search_text_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text search through the index of grams."""
    listings = texts.matched_text(cat.listings(spark, sf_dir), text_index(spark, sf_dir), " er#000000 ")
    return search.ranked(search.matched_summary(listings, cat.units(spark, sf_dir), ListingQuery()), "newest").select(*SEARCH_COLUMNS)


TEXTS = """
t AS (
  SELECT DISTINCT q FROM (
    SELECT lower(n_name) AS q FROM nation UNION ALL SELECT substr(lower(n_name), 1, 2) FROM nation UNION ALL SELECT substr(lower(n_name), 2, 1) FROM nation
    UNION ALL SELECT '%' UNION ALL SELECT '_' UNION ALL SELECT '#' UNION ALL SELECT right(lower(c_name), 7) FROM customer))"""


@query("search_many_texts", L, TEXTS, sql="SELECT q, count(*) AS n_listings FROM t JOIN l ON contains(lower(project), q) OR contains(lower(city), q) GROUP BY q")
def search_many_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many listings have each of many texts: names of nations, their beginnings and letters, ends of customers' names, signs."""
    name, customer = F.lower("n_name"), F.lower("c_name")
    asked = cat.table(spark, sf_dir, "nation").select(F.explode(F.array(name, F.substring(name, 1, 2), F.substring(name, 2, 1), F.lit("%"), F.lit("_"), F.lit("#"))).alias("q"))
    asked = asked.union(cat.table(spark, sf_dir, "customer").select(F.right(customer, F.lit(7))))
    return texts.texts_counted(cat.listings(spark, sf_dir), text_index(spark, sf_dir), asked)
