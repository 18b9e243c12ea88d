"""Merkle manifest of a table by time-forward processing.

Every node of a tree has a label, its level and its place, and labels ascend
from the leaves to the root.  A priority queue in the order of the labels holds
the digests that children have sent to their parents; the node whose label is
least takes its messages, and sends its own digest on.  A second sweep, in the
reversed order, sends each node's proof suffix, the siblings from its level up
to the root, down to its children.

The queue is an external one.  Trees are cut into blocks of ``HEIGHT`` levels
and ``2 ** HEIGHT`` nodes; messages between blocks go through Spark's sorted
shuffle, and only those within one block are in a task's memory.  So a tree of
any size takes a few rounds, and no task, nor the driver, has a whole level.

There is a tree for each group of rows, and one over the groups' roots.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.functions.ranks import numbered
from casona.llm.shared import stored

#: Levels of a block.
HEIGHT = 10
#: Bits of a place in a node's label.
PLACE_BITS = 48
#: Hexadecimal digits of a digest.
DIGITS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined_digest(children: list[str]) -> str:
    """The digest of a run of digests, as hex text."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """The digest of a row: each value as its length in bytes, a colon and its text, or a dash if it is null."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def placed(leaves: DataFrame, group: str, keys: list[Column]) -> tuple[DataFrame, int]:
    """``leaves`` with ``tree``, ``place``, ``n``: the number of their group, their place in it, the group's rows; and how many groups there are.

    Rows are sorted over ranges, and a row is known by its range and place
    there; groups are numbered in the same order.
    """
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = [F.asc_nulls_first(group), *keys]
    ordered = stored(leaves.repartitionByRange(parts, *at).sortWithinPartitions(*at).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # a row for each range
    starts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("k"), F.min("at").alias("first")).select("part", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    everywhere = ordered.withColumn("part", part).join(F.broadcast(stored(starts)), "part").withColumn("at", F.col("at") + F.col("shift")).drop("part", "shift")
    groups = everywhere.groupBy(F.col(group).alias("g")).agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    groups = stored(numbered(groups, [F.col("start")], "tree").withColumn("tree", F.col("tree") - 1))
    rows = everywhere.join(groups, F.col(group).eqNullSafe(F.col("g"))).withColumn("place", F.col("at") - F.col("start"))
    return rows.drop("at", "start", "g"), groups.count()


def block_height(n: int) -> int:
    """Levels that a block has in a tree of which ``n`` nodes are left."""
    return min(HEIGHT, (n - 1).bit_length())


def swept_up(digests: list[str], first: int, n: int) -> dict[tuple[int, int], str]:
    """The digest of every node ``(level, place)`` of a block whose lowest nodes are ``digests``, from place ``first`` on."""
    height, nodes = block_height(n), {}
    queue = [(first + k, 0, x) for k, x in enumerate(digests)]  # label of the node that takes it, place of the sender, digest
    while queue:
        label, _, message = heapq.heappop(queue)
        messages = [message]
        while queue and queue[0][0] == label:
            messages.append(heapq.heappop(queue)[2])
        level, place = label >> PLACE_BITS, label & ((1 << PLACE_BITS) - 1)
        nodes[level, place] = joined_digest(messages) if level else message
        if level < height:
            heapq.heappush(queue, (level + 1 << PLACE_BITS | place >> 1, place, nodes[level, place]))
    return nodes


def swept_down(nodes: dict[tuple[int, int], str], top: tuple[int, int], suffix: str) -> dict[int, str]:
    """The proof suffix of each lowest node by its place, as the siblings' digests one after the other."""
    found, queue = {}, [(-(top[0] << PLACE_BITS | top[1]), suffix)]
    while queue:
        label, suffix = heapq.heappop(queue)
        level, place = -label >> PLACE_BITS, -label & ((1 << PLACE_BITS) - 1)
        if not level:
            found[place] = suffix
            continue
        for child in (2 * place, 2 * place + 1):
            if (level - 1, child) in nodes:
                heapq.heappush(queue, (-(level - 1 << PLACE_BITS | child), nodes.get((level - 1, child ^ 1), "") + suffix))
    return found


def folded(digest: str, siblings: str, places: list[tuple[int, int]]) -> str:
    """The root that a digest and its siblings give; ``places``: its place and the number of nodes, in each tree on the way."""
    at = 0
    for place, n in places:
        while n > 1:
            alone = not place & 1 and place + 1 == n
            other = siblings[at : at + DIGITS]
            digest = joined_digest([digest] if alone else [other, digest] if place & 1 else [digest, other])
            at += 0 if alone else DIGITS
            place, n = place >> 1, n + 1 >> 1
    return digest


def in_order(rows: pa.Table, *more: str) -> tuple[list[int], ...]:
    rows = rows.sort_by("place")
    return tuple(rows.column(c).to_pylist() for c in ("place", "n", "digest", *more))


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """Layers ``(tree, place, n, digest)`` of all trees, ``HEIGHT`` levels apart, of which ``nodes`` are the lowest; in the last each tree has one node."""

    def top(key: tuple, rows: pa.Table) -> pa.Table:
        places, n, digests = in_order(rows)
        height = block_height(n[0])
        found = swept_up(digests, places[0], n[0])[height, places[0] >> height]
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int64()), "place": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([(n[0] - 1 >> HEIGHT) + 1], pa.int64()), "digest": [found]})

    layers = [nodes]
    left = nodes.agg(F.max("n")).first()[0]
    while left > 1:
        blocks = layers[-1].select("tree", F.shiftright("place", HEIGHT).alias("block"), "place", "n", "digest")
        layers.append(stored(blocks.groupBy("tree", "block").applyInArrow(top, "tree long, place long, n long, digest string")))
        left = (left - 1 >> HEIGHT) + 1
    return layers


def descended(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``(tree, place, suffix)`` of a layer's nodes from those of the next layer above."""

    def down(rows: pa.Table, top: pa.Table) -> pa.Table:
        places, n, digests = in_order(rows)
        height = block_height(n[0])
        found = swept_down(swept_up(digests, places[0], n[0]), (height, places[0] >> height), top.column("suffix")[0].as_py())
        return pa.table({"tree": pa.array([rows.column("tree")[0].as_py()] * len(places), pa.int64()), "place": pa.array(places, pa.int64()), "suffix": [found[p] for p in places]})

    blocks = nodes.select("tree", F.shiftright("place", HEIGHT).alias("block"), "place", "n", "digest")
    tops = above.select(F.col("tree").alias("tree_"), F.col("place").alias("block_"), "suffix")
    return stored(blocks.groupBy("tree", "block").cogroup(tops.groupBy("tree_", "block_")).applyInArrow(down, "tree long, place long, suffix string"))


def suffixes(layers: list[DataFrame], top: DataFrame, lowest: int) -> DataFrame:
    """``(tree, place, suffix)`` of the nodes of layer ``lowest``, from those of the trees' roots."""
    for layer in reversed(layers[lowest:-1]):
        top = descended(layer, top)
    return top


def proofs(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang", changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``(key, leaf, subroot, root, siblings, folded_root)`` of every row: its proof, and the root that it gives.

    A row's leaf is made of ``fields``; leaves of a group ascend by ``key``
    (nulls first, equal keys by digest), groups by name (null first, bytewise).
    Of several nodes each two that follow one another become one, a last one
    alone does so by itself.  ``siblings`` are the digests that the proof needs,
    from the leaf up, one after the other.  Where ``where`` holds the proof is
    folded from the row with the fields ``changed`` instead, from the row itself
    elsewhere.  Repeated rows are leaves of their own; other columns don't
    matter; an empty table has no rows and no root.
    """
    own = [F.col(c) for c in fields]
    other = leaf_digest([(changed or {}).get(c, F.col(c)) for c in fields])
    claimed = F.when(F.lit(False) if where is None else where, other)
    # digests as bytes: half as wide
    leaves = stored(docs.select(F.col(key).alias("key"), F.col(group).alias("group"), F.unhex(leaf_digest(own)).alias("leaf"), F.unhex(claimed).alias("claimed")))
    schema = f"key {docs.schema[key].dataType.simpleString()}, leaf string, subroot string, root string, siblings string, folded_root string"
    if leaves.isEmpty():
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    rows, groups = placed(leaves, "group", [F.asc_nulls_first("key"), F.asc("leaf")])
    rows = rows.withColumn("digest", F.lower(F.hex("leaf")))
    layers = climbed(rows.select("tree", "place", "n", "digest"))
    subroots = layers[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(groups).cast("long").alias("n"), "digest")
    upper = climbed(subroots)
    root = upper[-1].first()["digest"]
    at_top = suffixes(upper, upper[-1].select("tree", "place", F.lit("").alias("suffix")), 0)
    tops = layers[-1].join(at_top.select(F.col("place").alias("tree"), "suffix"), "tree").select("tree", "place", "suffix", F.col("digest").alias("subroot"))
    # the layer of the leaves' blocks; a layer of leaves alone is its own top
    last = layers[1:] or layers
    below = suffixes(last, tops.select("tree", "place", "suffix"), 0).join(tops.select("tree", "subroot"), "tree")
    single = len(layers) == 1

    def prove(rows: pa.Table, top: pa.Table) -> pa.Table:
        places, n, digests, keys, claims = in_order(rows, "key", "claimed")
        height, tree = (0 if single else block_height(n[0])), rows.column("tree")[0].as_py()
        found = swept_down(swept_up(digests, places[0], n[0]), (height, places[0] >> height), top.column("suffix")[0].as_py())
        siblings = [found[p] for p in places]
        starts = [d if c is None else c.hex() for d, c in zip(digests, claims, strict=True)]
        roots = [folded(d, s, [(p, n[0]), (tree, groups)]) for d, s, p in zip(starts, siblings, places, strict=True)]
        subroot = top.column("subroot")[0].as_py()
        return pa.table({"key": pa.array(keys, rows.schema.field("key").type), "leaf": digests, "subroot": [subroot] * len(keys), "root": [root] * len(keys), "siblings": siblings, "folded_root": roots})

    blocks = rows.select("tree", F.shiftright("place", 0 if single else HEIGHT).alias("block"), "place", "n", "digest", "key", "claimed")
    tops = below.select(F.col("tree").alias("tree_"), F.col("place").alias("block_"), "suffix", "subroot")
    return blocks.groupBy("tree", "block").cogroup(tops.groupBy("tree_", "block_")).applyInArrow(prove, schema).withColumnRenamed("key", key)


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of ``documents``, a tree for each language.

    Rows whose id (in decimal) has a checksum that 7 divides are tampered with:
    their ``n_chars`` is one more, a null stays; so does a row without an id.
    """
    changed = {"n_chars": F.col("n_chars") + 1}
    where = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    found = proofs(docs, changed=changed, where=F.coalesce(where, F.lit(False)))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def parent_sql(name: str, source: str) -> str:
    """All levels of the trees of ``source (tree, place, n, digest)`` as a recursive table."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, place, n, digest FROM {source}
  UNION ALL
  SELECT tree, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name} WHERE n > 1 GROUP BY tree, level, place // 2, n)"""


#: The same rows in SQL: trees level by level; checksums bit by bit.
MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail FROM documents),
bytes AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS t FROM (SELECT DISTINCT doc_id FROM d WHERE doc_id IS NOT NULL)),
crc AS (
  SELECT doc_id, t, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM bytes
  UNION ALL
  SELECT doc_id, t, k + 1, CASE WHEN k % 9 = 0 THEN xor(c, CAST(ascii(t[k // 9 + 1]) AS BIGINT)) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc WHERE k < 9 * length(t)),
tampered AS (SELECT doc_id FROM crc WHERE k = 9 * length(t) AND (4294967295 - c) % 7 = 0),
h AS (
  SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') || tail) AS other FROM d),
leaves AS (
  SELECT h.*, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY h.doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n,
         CASE WHEN t.doc_id IS NULL THEN leaf ELSE other END AS claimed FROM h LEFT JOIN tampered t ON t.doc_id = h.doc_id),
low AS (SELECT tree, place, n, leaf AS digest FROM leaves),{parent_sql("nodes", "low")},
subroots AS (SELECT tree, digest AS subroot FROM nodes WHERE n = 1),
top AS (SELECT 0 AS tree, tree AS place, (SELECT count(*) FROM subroots) AS n, subroot AS digest FROM subroots),{parent_sql("upper_nodes", "top")},
root AS (SELECT digest AS root FROM upper_nodes WHERE n = 1),
every AS (
  SELECT 0 AS stage, tree, level, place, n, digest FROM nodes UNION ALL SELECT 1, tree, level, place, n, digest FROM upper_nodes),
walk AS (
  SELECT tree AS own_tree, place AS own_place, 0 AS stage, tree, 0 AS level, place, n, claimed AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT w.own_tree, w.own_place, CASE WHEN w.n = 1 THEN 1 ELSE w.stage END, CASE WHEN w.n = 1 THEN 0 ELSE w.tree END, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
         CASE WHEN w.n = 1 THEN w.tree ELSE w.place // 2 END, CASE WHEN w.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (w.n + 1) // 2 END,
         CASE WHEN w.n = 1 THEN w.folded WHEN s.digest IS NULL THEN sha256(w.folded) WHEN w.place % 2 = 1 THEN sha256(s.digest || w.folded) ELSE sha256(w.folded || s.digest) END,
         w.proof || CASE WHEN w.n = 1 THEN '' ELSE coalesce(s.digest, '') END
  FROM walk w LEFT JOIN every s ON s.stage = w.stage AND s.tree = w.tree AND s.level = w.level AND s.place = xor(w.place, 1)
  WHERE w.n > 1 OR w.stage = 0),
done AS (SELECT own_tree, own_place, folded, proof FROM walk WHERE stage = 1 AND n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves JOIN done ON own_tree = tree AND own_place = place JOIN subroots USING (tree) CROSS JOIN root
"""
