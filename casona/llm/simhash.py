"""SimHash near-duplicates: fingerprints, and a self-join of their binary trie.

The trie is never stored.  A node is a run of sorted fingerprints that agree on
their first bits; a pair of nodes carries the number of bits in which it
differs so far.  Pairs are taken down together, bit by bit, and dropped as soon
as they exceed the error budget of their depth.

Budget.  Cut the 64 bits in ``max_bits + 1`` blocks.  If two fingerprints
differ in at most ``max_bits`` bits, some rotation of the blocks has, for every
l, at most ``floor(l * max_bits / (max_bits + 1))`` differing bits in its first
l blocks (a cyclic sequence whose sum isn't positive has a rotation without a
positive prefix sum).  So one trie for each rotation, with the budget growing
block by block, finds every link, and the first block must agree exactly: it
is the key by which the work is dealt out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.llm.shared import checkpointed, connected_components, stored, text_pieces

SEED = 42
ONES = np.uint64(0x0101010101010101)
#: Rows of one pair of nodes that one task takes; larger pairs are taken further down first.
PAIR_ROWS = 1024
#: Rows that one call of the traversal gets, on average.
TASK_ROWS = 4096
#: Bits by which a pair of nodes that is too large is taken down.
STEP = 6
#: Pairs of fingerprints below which a pair of nodes is compared directly.
DIRECT = 64
#: Pairs of nodes held at once.
FRONTIER = 1 << 18
#: From here on, numbers of fingerprints without an id; ids are less.
NO_ID = 1 << 62


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the uint64 ``hashes`` have each bit, the lowest bit first."""
    h = np.concatenate([hashes, np.zeros(-len(hashes) % 255, np.uint64)]).reshape(-1, 255)
    out = np.empty((8, 8), np.int64)
    for bit in range(8):  # each byte of the sum counts up to 255
        lanes = ((h >> np.uint64(bit)) & ONES).sum(axis=1, dtype=np.uint64)
        out[:, bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.ravel()


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The SimHash of a UTF-8 text, unsigned; 0 without words."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, n, digest = b" ".join(words), len(words), xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    pairs = zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[i:j], SEED) for i, j in pairs], np.uint64)
    bits = 2 * bit_counts(hashes) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(doc_id, fingerprint)``, a row for each row of ``docs``; the fingerprint is a signed long.

    A null text counts as an empty one (fingerprint 0).  Whole texts are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (x for b in batches for x in text_pieces(b, 1)):
            values = np.array([fingerprint(x, shingle) for x in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, fingerprint long")


def widths(max_bits: int) -> list[int]:
    """Bits of each block, the wider ones first."""
    n = max_bits + 1
    return [64 // n + (i < 64 % n) for i in range(n)]


def budgets(max_bits: int) -> np.ndarray:
    """``[rotation, depth]``: differing bits that a pair of nodes may have at a depth."""
    w, out = widths(max_bits), np.zeros((max_bits + 1, 65), np.int64)
    for r in range(max_bits + 1):
        out[r, 1:] = np.repeat((np.arange(max_bits + 1) + 1) * max_bits // (max_bits + 1), w[r:] + w[:r])
    return out


def rotated(value: Column, by: int) -> Column:
    return value if not by else F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by))


def children(rows: DataFrame, max_bits: int) -> DataFrame:
    """The pairs of nodes ``STEP`` bits further down: a fingerprint goes to its own child and to those that differ within the budget."""
    limits = F.array(*[F.array(*[F.lit(int(x)) for x in row]) for row in budgets(max_bits)])
    masks = F.array(*[F.lit(m) for m in sorted(range(1 << STEP), key=int.bit_count) if m.bit_count() <= max_bits])
    return (
        rows.withColumn("step", F.least(F.lit(STEP), 64 - F.col("depth")))
        .withColumn("mask", F.explode(masks))
        .where("mask < shiftleft(1, step)")
        .withColumn("depth", F.col("depth") + F.col("step"))
        .withColumn("err", F.col("err") + F.bit_count("mask"))
        .where(F.col("err") <= F.get(F.get(limits, F.col("rot")), F.col("depth")))
        .withColumn("own", F.expr("shiftrightunsigned(fp, 64 - depth)"))
        .withColumn("bits", F.expr("own & (shiftleft(1L, step) - 1)"))
        .withColumn("other", F.expr("shiftleft(case side when 1 then b when 2 then a else a end, step) | (bits ^ mask)"))
        .withColumn("side", F.expr("case when a <> b then side when mask = 0 then 0 when own < other then 1 else 2 end"))
        .select("rot", "depth", F.expr("if(side = 2, other, own)").alias("a"), F.expr("if(side = 2, own, other)").alias("b"), "err", "side", "fp", "node")
    )


def node_pairs(prints: DataFrame, n: int, max_bits: int) -> DataFrame:
    """Rows ``(rot, depth, a, b, err, side, fp, node)`` of the pairs of nodes of ``n`` fingerprints, none over ``PAIR_ROWS`` rows.

    At first each node is paired with itself at the depth of its first block,
    and taken down so far that the pairs of evenly spread fingerprints fit.  What
    still has too many rows is taken further down.  The fingerprints are
    distinct, so this ends.  Pairs with an empty side go.
    """
    w, key = widths(max_bits), ["rot", "depth", "a", "b"]
    turns = [
        F.struct(F.lit(r).alias("rot"), F.lit(w[r]).alias("depth"), rotated(F.col("fp"), sum(w[:r])).alias("fp"))
        for r in range(max_bits + 1)
    ]
    work = (
        prints.select("node", F.explode(F.array(*turns)).alias("x"))
        .select("x.*", "node")
        .withColumn("a", F.expr("shiftrightunsigned(fp, 64 - depth)"))
        .select("rot", "depth", "a", F.col("a").alias("b"), F.lit(0).alias("err"), F.lit(0).alias("side"), "fp", "node")
    )
    for _ in range(w[-1], max(1, n // PAIR_ROWS).bit_length(), STEP):
        work = children(work, max_bits)
    done: DataFrame | None = None
    while True:
        sizes = work.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("side").alias("low"), F.max("side").alias("high"))
        sizes = checkpointed(sizes.where("n > 1 and (a = b or low <> high)").select(*key, "n"))
        rows = work.join(sizes, key)
        small = rows.where(F.col("n") <= PAIR_ROWS).drop("n")
        done = small if done is None else done.union(small)
        if sizes.where(F.col("n") > PAIR_ROWS).isEmpty():
            return done
        work = checkpointed(children(rows.where(F.col("n") > PAIR_ROWS).drop("n"), max_bits))


def trie_links(rot: np.ndarray, depth: np.ndarray, a: np.ndarray, b: np.ndarray, err: np.ndarray, side: np.ndarray, fp: np.ndarray, node: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within the given pairs of nodes: the ``node`` of each fingerprint and of its root."""
    order = np.lexsort((fp, side, b, a, depth, rot))
    rot, depth, a, b, err, side, fp, node = (x[order] for x in (rot, depth, a, b, err, side, fp, node))
    turn = np.cumsum([0, *widths(max_bits)])[:-1].astype(np.uint64)[rot]
    original = np.where(turn == 0, fp, (fp >> turn) | (fp << ((np.uint64(64) - turn) & np.uint64(63))))
    nodes, first_at, index = np.unique(original, return_index=True, return_inverse=True)
    parent, allowed = np.arange(len(nodes)), budgets(max_bits)
    new = np.ones(len(fp), bool)
    new[1:] = (rot[1:] != rot[:-1]) | (depth[1:] != depth[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(fp))
    ones = np.concatenate([[0], np.cumsum(side == 2)])
    own = a[lo] == b[lo]
    mid = hi - (ones[hi] - ones[lo])
    first = np.stack([lo, np.where(own, hi, mid), np.where(own, lo, mid), hi, err[lo], depth[lo], rot[lo]])
    counts: dict[int, np.ndarray] = {}

    def unite(u: np.ndarray, v: np.ndarray) -> None:
        nonlocal parent
        while len(u):
            pu, pv = parent[u], parent[v]
            low = np.minimum(pu, pv)
            np.minimum.at(parent, pu, low)
            np.minimum.at(parent, pv, low)
            while (up := parent[parent]) is not None and (up != parent).any():
                parent = up
            keep = parent[u] != parent[v]
            u, v = u[keep], v[keep]

    def compare(pairs: np.ndarray) -> None:
        """Leaves: every fingerprint of one side against every one of the other."""
        na, nb = pairs[1] - pairs[0], pairs[3] - pairs[2]
        total = na * nb
        which = np.repeat(np.arange(pairs.shape[1]), total)
        k = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
        i, j = pairs[0][which] + k // nb[which], pairs[2][which] + k % nb[which]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        unite(index[i[near]], index[j[near]])

    stack = [first[:, k : k + FRONTIER] for k in range(0, first.shape[1], FRONTIER)]
    while stack:
        now = stack.pop()
        if not now.shape[1]:
            continue
        direct = ((now[1] - now[0]) * (now[3] - now[2]) <= DIRECT) | (now[5] >= 64)
        compare(now[:, direct])
        now = now[:, ~direct]
        out = []
        for level in np.unique(now[5]).tolist():
            at = now[:, now[5] == level]
            if level not in counts:
                counts[level] = np.concatenate([[0], np.cumsum((fp >> np.uint64(63 - level)) & np.uint64(1)).astype(np.int64)])
            c = counts[level]
            amid, bmid = at[1] - (c[at[1]] - c[at[0]]), at[3] - (c[at[3]] - c[at[2]])
            same = (at[0] == at[2]) & (at[1] == at[3])
            for x, y, differs in (((at[0], amid), (at[2], bmid), 0), ((amid, at[1]), (bmid, at[3]), 0), ((at[0], amid), (bmid, at[3]), 1), ((amid, at[1]), (at[2], bmid), 1)):
                child = np.stack([*x, *y, at[4] + differs, at[5] + 1, at[6]])
                keep = (child[1] > child[0]) & (child[3] > child[2]) & (child[4] <= allowed[child[6], child[5]])
                if len(out) % 4 == 3:
                    keep &= ~same  # the mirror image of the third
                out.append(child[:, keep])
        if out:
            joined = np.concatenate(out, axis=1)
            stack += [joined[:, k : k + FRONTIER] for k in range(0, joined.shape[1], FRONTIER)]
    moved, nodes = parent != np.arange(len(nodes)), node[first_at]
    return nodes[moved], nodes[parent[moved]]


def near_links(prints: DataFrame, max_bits: int = 4, n: int | None = None) -> DataFrame:
    """``(a, b)`` links of ``prints`` ``(fp, node)``, distinct longs and what stands for each, that join all within ``max_bits`` bits.

    ``n``: about how many there are, if it is known; it only decides how deep the work starts.
    Not every pair: a spanning forest of the links that each task found, from
    which the same components follow.
    """
    n = n or prints.count()
    pairs = node_pairs(prints.select("fp", "node"), n, max_bits)
    buckets = max(1, n * (max_bits + 1) // TASK_ROWS)

    def run(group: pa.Table) -> pa.Table:
        cols = [group.column(k).to_numpy() for k in ("rot", "depth", "a", "b", "err", "side", "fp", "node")]
        u, v = trie_links(*cols[:6], cols[6].astype(np.int64).view(np.uint64), cols[7], max_bits)
        return pa.table({"a": pa.array(u), "b": pa.array(v)})

    dealt = pairs.withColumn("bucket", F.pmod(F.xxhash64("rot", "depth", "a", "b"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 4, shingle: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row for each row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id``
    is the smallest id that links reach, the row's own included.  Equal texts
    share a fingerprint and are expanded into no pairs.  Null and wordless texts
    have fingerprint 0 and link like any other; rows that repeat come back as
    often; a null id is never the smallest (a component of null ids has null).
    Ids from 2**62 on are an error.  Other columns of ``docs`` are not read; an
    empty table gives no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle))
    # a fingerprint is known by its least id, so that the least node of a component is its id; ids of none come after all others
    distinct = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct.select("fp", F.coalesce("least", F.monotonically_increasing_id() + NO_ID).alias("node")))
    if not prints.where(F.col("doc_id") >= NO_ID).isEmpty():
        raise ValueError(f"ids must be less than {NO_ID}")
    roots = connected_components(near_links(distinct, max_bits))
    # written, so that the join deals out both sides anew and a very common fingerprint can be split over tasks
    found = stored(distinct.join(roots, "node", "left").select(F.col("fp").alias("fingerprint"), F.coalesce("root", "node").alias("root")))
    component = F.when(F.col("root") < NO_ID, F.col("root")).alias("component_id")
    return prints.join(found, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), component)


# The wide setting.  Of texts that are 0.8 similar about one bit in seven differs.  The
# trie would need 11 bits of four fingerprints, and its rows are too many for the
# disk (README), so that here bands of MinHashes find the candidates.

#: Words of a shingle, and least similarity (Jaccard) of shingle sets.
WORDS, SIMILAR = 5, 0.8
#: Bands, and MinHashes that must agree in one: all but 2 of 100,000 pairs of a similarity of 0.8 are expected to share a band.
BANDS, DEEP = 36, 6
#: Texts of a block that are all compared with each other; in larger ones all meet so many pivots first, in so many rounds at most.
BLOCK_TEXTS, PIVOTS, ROUNDS = 16, 8, 3
#: Texts of a large block that meet the pivots in one task, on average.
PART_TEXTS = 1024
#: Bytes of sets of shingles of small blocks that are compared in one task, on average.
TASK_BYTES = 1 << 25


def shingle_set(text: bytes | None, shingle: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending; one for all its words if they are fewer."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    pairs = zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.unique(np.array([digest(joined[i:j], SEED) for i, j in pairs], np.uint64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shingles that both sets have for each that one has; 1 for two empty sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def band_hashers() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and summands of the MinHashes."""
    rng = np.random.default_rng(SEED)
    return tuple(rng.integers(0, 2**63, BANDS * DEEP, dtype=np.uint64).astype(np.uint32)[:, None] | np.uint32(1) for _ in range(2))


def band_keys(hashes: np.ndarray, by: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """A key for each band of MinHashes of a set of shingles."""
    least, short = np.full(BANDS * DEEP, 2**32 - 1, np.uint32), (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for k in range(0, len(short), 1024):
        least = np.minimum(least, (by * short[k : k + 1024] + plus).min(axis=1))
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, DEEP))], np.uint64).view(np.int64)


def wide_prints(rows: DataFrame, key: str, text_col: str) -> DataFrame:
    """``(row, d1, d2, bits, bands)``: a 128-bit digest of the words of each text; the SimHash and ``band_keys`` of its set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, plus = band_hashers()
        for batch, texts in (x for b in batches for x in text_pieces(b, 1)):
            digests, values, keys = [], np.zeros(batch.num_rows, np.uint64), []
            for k, text in enumerate(texts):
                text = text or b""
                digests.append(xxhash.xxh3_128_digest(b" ".join(text.lower().split())))
                hashes = shingle_set(text)
                keys.append(band_keys(hashes, by, plus))
                if len(hashes):
                    values[k] = np.packbits(2 * bit_counts(hashes) > len(hashes), bitorder="little").view("<u8")[0]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            arrays = [batch.column(0), *[pa.array(halves[:, j].copy()) for j in (0, 1)], pa.array(values.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "d1", "d2", "bits", "bands"])

    schema = "row long, d1 long, d2 long, bits long, bands array<long>"
    return rows.select(F.col(key).alias("row"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``(node, shingles)`` of texts ``(node, text)``: ``shingle_set`` as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in (x for b in batches for x in text_pieces(b, 1)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t).tobytes() for t in found], pa.binary())], names=["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles binary")


def block_pairs(blocks: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``(a, b)`` links between the texts ``(root, node)`` of each small block, enough to join all that are ``least`` similar.

    A set of shingles is moved once, to the task of its block; blocks are dealt
    by hash to tasks of about ``TASK_BYTES``, so that what a task holds doesn't
    grow with the table.
    """
    size = sets.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0
    whole = blocks.select("root", "node").join(sets, "node").withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(1 + size // TASK_BYTES)))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("root", "ascending"), ("node", "ascending")])
        root, nodes, shingles = (group.column(c) for c in ("root", "node", "shingles"))
        edges = np.flatnonzero(np.concatenate([[True], np.diff(root.to_numpy()) != 0, [True]]))
        out: list[tuple[int, int]] = []
        for first, end in itertools.pairwise(edges.tolist()):
            found = [np.frombuffer(x.as_buffer(), np.uint64) for x in shingles[first:end]]
            of = list(range(len(found)))
            for j, k in itertools.combinations(of.copy(), 2):
                if of[j] != of[k] and similarity(found[j], found[k]) >= least:
                    out.append((first + j, first + k))
                    of = [of[j] if x == of[k] else x for x in of]
        ends = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({c: nodes.take(pa.array(ends[:, k])) for k, c in enumerate("ab")})

    return whole.groupBy("bucket").applyInArrow(run, "a long, b long")


def in_parts(per_root: DataFrame) -> DataFrame:
    """Rows of a large block ``(root, n, ...)`` once for each ``part`` in which its texts are dealt out."""
    return per_root.withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / PART_TEXTS).cast("int") - 1)))


def pivots_of(texts: DataFrame) -> DataFrame:
    """``PIVOTS`` texts of each block ``(root, n, part, node, bits)``: half those nearest to what most of its SimHashes have, half picked by hash.

    If all are copies of one text with changes of their own, it is the former.
    """
    ones = texts.groupBy("root").agg(F.first("n").alias("n"), *[F.sum(F.expr(f"2 * (shiftrightunsigned(bits, {b}) & 1L) - 1")).alias(f"b{b}") for b in range(64)])
    most = ones.select("root", "n", reduce(lambda x, y: x.bitwiseOR(y), [F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")) for b in range(64)]).alias("most"))
    off = texts.join(in_parts(checkpointed(most)).drop("n"), ["root", "part"]).withColumn("off", F.bit_count(F.col("bits").bitwiseXOR(F.col("most")))).drop("most")
    off = checkpointed(off.withColumn("turn", F.xxhash64("node")))
    # a window's limit on the place acts before the shuffle too
    ranked = [off.withColumn("place", F.row_number().over(W.partitionBy("root").orderBy(*by))).where(F.col("place") <= PIVOTS // 2) for by in (("off", "turn"), ("turn",))]
    return checkpointed(ranked[0].union(ranked[1]).select("root", "n", "node").dropDuplicates(["node"]))


def trie_edges(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """``(a, b)`` links of the texts ``(node, bits)``: of those with the same SimHash, and of SimHashes within ``max_bits`` bits by the trie."""
    prints = checkpointed(nodes.groupBy(F.col("bits").alias("fp")).agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("n")))
    equal = nodes.join(prints.where("n > 1").select(F.col("fp").alias("bits"), F.col("node").alias("b")), "bits").select(F.col("node").alias("a"), "b").where("a <> b")
    return equal.union(near_links(prints.select("fp", "node"), max_bits))


def similar_links(nodes: DataFrame, rows: DataFrame, key: str, text_col: str, least: float) -> DataFrame:
    """``(a, b)`` links of the texts ``(node, bits, bands)`` that are ``least`` similar, enough to join them.

    Blocks are what the trie's links of SimHashes join (``near_links``), and what
    shared keys of bands, for texts whose SimHashes lie farther apart; a link is
    confirmed by the texts.
    In a block of up to ``BLOCK_TEXTS`` texts all pairs are compared.  In a larger
    one all are compared with pivots, and what isn't in the largest component
    then with pivots of its own, in some rounds; what is still outside is
    compared with all outside its own component.  Either way a block ends in the
    components that all its pairs would give: its size decides the work alone.
    """
    keys = nodes.select("node", F.explode("bands").alias("key"))
    # written, so that the join deals out both sides anew and a very common key can be split over tasks
    shared = checkpointed(keys.groupBy("key").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    edges = keys.join(shared, "key").select(F.col("node").alias("a"), F.col("rep").alias("b")).where("a <> b").union(trie_edges(nodes))
    left = checkpointed(connected_components(edges).join(nodes, "node").select("root", "node", "bits"))
    sizes = checkpointed(left.groupBy("root").agg(F.count(F.lit(1)).alias("n")))
    # from here on only the shingles of the texts of blocks are moved
    texts = rows.select(F.col(key).alias("node"), F.col(text_col).cast("binary").alias("text")).join(left.select("node"), "node", "left_semi")
    sets = checkpointed(shingle_sets(texts))
    found = checkpointed(block_pairs(left.join(sizes.where(F.col("n") <= BLOCK_TEXTS), "root"), sets, least))
    many = sizes.where(F.col("n") > BLOCK_TEXTS)
    if many.isEmpty():
        return found
    large = checkpointed(left.join(many, "root").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("n") / PART_TEXTS)).cast("int")))
    links, outside, before = None, large, 0
    for turn in range(ROUNDS):
        alone = lambda x: x.withColumn("component", F.col("node"))
        new = checkpointed(block_links(alone(pivots_of(outside)), alone(outside), sets, least))
        links = new if links is None else links.union(new)
        components = connected_components(links).withColumnRenamed("root", "component")
        labelled = checkpointed(large.join(components, "node", "left").withColumn("component", F.coalesce("component", "node")))
        counts = labelled.groupBy("root", "component").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n"))
        top = checkpointed(counts.groupBy("root").agg(F.max_by("component", F.struct("k", "component")).alias("top"), F.first("n").alias("n")))
        remaining = checkpointed(labelled.join(in_parts(top).drop("n"), ["root", "part"]).where("component <> top"))
        left_over = remaining.count()
        if not left_over or (turn and 2 * left_over > before):
            break
        outside, before = remaining.drop("component", "top"), left_over
    if not left_over:
        return found.union(links)
    return found.union(links).union(checkpointed(block_links(remaining, labelled, sets, least)))


def block_links(remaining: DataFrame, labelled: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``(a, b)`` links between the texts ``remaining`` of large blocks and all ``labelled`` ones of other components.

    Parts of a block meet slices of what remains of it, about ``PART_TEXTS`` of
    either in one call, which counts common shingles and returns a link at most
    for each text and component.
    """
    slices = checkpointed(remaining.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / PART_TEXTS).cast("int").alias("slices")))
    left = remaining.select("root", "n", "node", "component").join(F.broadcast(slices) if slices.count() <= 10_000 else slices, "root").join(sets, "node")
    left = in_parts(left.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")))
    right = labelled.select("root", "part", "node", "component").join(F.broadcast(slices) if slices.count() <= 10_000 else slices, "root").join(sets, "node")
    right = right.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    key, columns = ["root", "part", "slice"], ["node", "component", "shingles"]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        nodes, of = b.column("node_b").to_numpy(), b.column("component_b").to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in b.column("shingles_b").to_pylist()]
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *found])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(found)), sizes)[order]
        for node, component, shingles in zip(*(a.column(f"{c}_a").to_pylist() for c in columns), strict=True):
            own = np.frombuffer(shingles, np.uint64)
            low, high = np.searchsorted(flat, own), np.searchsorted(flat, own, side="right")
            n = high - low
            both = np.bincount(owner[np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))], minlength=len(found))
            near = np.flatnonzero((both >= least * (len(own) + sizes - both)) & (of != component))
            out += [(node, int(nodes[near[k]])) for k in np.unique(of[near], return_index=True)[1]]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    # names of their own, as both sides come from the same tables
    sides = [x.select(*[F.col(c).alias(f"{c}{side}") for c in (*key, *columns)]).groupBy(*[f"{c}{side}" for c in key]) for side, x in (("_a", left), ("_b", right))]
    return sides[0].cogroup(sides[1]).applyInArrow(run, "a long, b long")


def similar_rows(rows: DataFrame, key: str, text_col: str = "text", least: float = SIMILAR) -> DataFrame:
    """``(row, component)``: for each row of ``rows`` by its unique long ``key`` the least key that links reach.

    Texts link if their sets of ``WORDS``-word shingles are ``least`` similar.
    Texts of the same words are one from the start; so are those without words.
    """
    prints = checkpointed(wide_prints(rows, key, text_col))
    least_row = prints.groupBy("d1", "d2").agg(F.min("row").alias("node"))
    texts = checkpointed(least_row.join(prints.select(F.col("row").alias("node"), "bits", "bands"), "node"))
    roots = connected_components(similar_links(texts.select("node", "bits", "bands"), rows, key, text_col, least))
    rooted = texts.select("d1", "d2", "node").join(roots, "node", "left").select("d1", "d2", F.coalesce("root", "node").alias("component"))
    # written, so that the join deals out both sides anew and a very common text can be split over tasks
    return prints.select("row", "d1", "d2").join(checkpointed(rooted), ["d1", "d2"]).select("row", "component")
