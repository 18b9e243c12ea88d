"""Benchmark decontamination by a distributed positional inverted index.

The index of the training documents is a stored table.  Each row of it is a
block of documents with the posting lists (token offsets within the block) of
every term that occurs there; a term is known by its 64-bit digest, so that an
index serves any benchmark.  The windows of the benchmark are looked up in each
block: their terms' lists, shifted by the terms' offsets, are intersected from
the rarest term on, for all windows at once.  Nothing is shuffled to find
matches, and a passage that very many documents hold costs as much in each.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casona.llm.shared import checkpoint_folder, checkpointed, text_pieces

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 bytes in lower case
PHRASE = 10
SEED = 42
#: Tokens of a block, at least; a block ends with the document that exceeds them.
BLOCK_TOKENS = 1 << 19
#: Tokens of a lot of benchmark items, on average: what the driver and a task hold at once.
LOT_TOKENS = 1_000_000
#: Occurrences of windows that are followed at once.
FOLLOWED = 1 << 20
INDEX = "block long, doc_ids array<long>, starts binary, terms binary, ends binary, postings binary"
FOUND = "block long, place int, doc_id long, n_words long, hits array<int>, items array<long>, near array<struct<item: bigint, place: int>>"
Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def words(text: bytes | None) -> list[bytes]:
    return WORD.findall((text or b"").lower())


def term_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, SEED)


class Block:
    """Documents as posting lists: ``keys``, ascending, has term times ``span`` and offset of every token.

    ``starts``: offset of each document and the end of the last; ``terms``:
    digests that occur, ascending; ``ends``: where the list of each ends;
    ``postings``: offsets, ascending in each list.  Documents are two tokens
    apart, so that no phrase crosses from one to the next.
    """

    def __init__(self, starts: np.ndarray, terms: np.ndarray, ends: np.ndarray, postings: np.ndarray):
        self.starts, self.terms, self.ends, self.postings = starts, terms, ends, postings
        self.firsts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        self.span = int(starts[-1]) + 1
        self.keys = np.repeat(np.arange(len(terms)), np.diff(ends, prepend=0)) * self.span + postings

    @staticmethod
    def of(documents: list[list[bytes]]) -> Block:
        known: dict[bytes, int] = {}
        lengths = np.array([len(d) for d in documents], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 2)])
        tokens = np.fromiter((known.setdefault(w, len(known)) for d in documents for w in d), np.int64, int(lengths.sum()))
        at = np.arange(len(tokens)) + np.repeat(2 * np.arange(len(lengths)), lengths)
        digests = np.array([term_of(w) for w in known], np.uint64)
        terms, which = np.unique(digests, return_inverse=True)
        own = which[tokens] if len(tokens) else tokens
        return Block(starts, terms, np.cumsum(np.bincount(own, minlength=len(terms))), at[np.argsort(own, kind="stable")])

    def numbers(self, digests: np.ndarray) -> np.ndarray:
        """Places of the digests among the block's terms; -1 where a term doesn't occur."""
        if not len(self.terms):
            return np.full(digests.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, digests), len(self.terms) - 1)
        return np.where(self.terms[at] == digests, at, -1)

    def document(self, offsets: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, offsets, side="right") - 1

    def occurrences(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of a list of terms: pairs of its places and the offsets of each term there, some at once."""
        counts = self.ends[numbers] - self.firsts[numbers]
        lot = np.cumsum(counts) // FOLLOWED
        for k in np.unique(lot):
            which = np.flatnonzero(lot == k)
            n = counts[which]
            own = np.repeat(which, n)
            yield own, self.postings[np.repeat(self.firsts[numbers[which]], n) + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)]

    def holds(self, numbers: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a term occurs at an offset from ``low`` to ``high``."""
        base = numbers * self.span
        return np.searchsorted(self.keys, base + low) < np.searchsorted(self.keys, base + high, side="right")

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """``(window, offset)`` of every occurrence of a window."""
        live, numbers, order = windows.within(self)
        out = []
        for own, offset in self.occurrences(numbers[np.arange(len(live)), order[:, 0]] if len(live) else live):
            start = offset - order[own, 0]
            for k in range(1, numbers.shape[1]):
                at = order[own, k]
                term = numbers[own, at]
                fits = (term < 0) | self.holds(np.maximum(term, 0), np.maximum(start, 0) + at, np.maximum(start, 0) + at) & (start >= 0)
                own, start = own[fits], start[fits]
            keep = start >= 0
            out.append(np.stack([live[own[keep]], start[keep]]))
        both = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return both[0], both[1]

    def proximities(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """``(window, offset)`` of the anchor of a window wherever all its terms lie at most ``reach`` tokens away in the same document."""
        live, numbers, order = windows.within(self)
        if not len(live):
            return live, live

        def around(own: np.ndarray, middle: np.ndarray, within: np.ndarray) -> np.ndarray:
            """Which of the offsets have every term of their window so near."""
            left = np.arange(len(own))
            for k in range(numbers.shape[1]):
                o, m = own[left], middle[left]
                term, doc = numbers[o, order[o, k]], self.document(m)
                low, high = np.maximum(m - within[o], self.starts[doc]), np.minimum(m + within[o], self.starts[doc + 1] - 1)
                left = left[(term < 0) | self.holds(np.maximum(term, 0), low, high)]
            return left

        far = windows.reach[live]
        some = np.zeros(len(live), bool)
        for own, offset in self.occurrences(numbers[np.arange(len(live)), order[:, 0]]):  # the rarest term: as all lie around the anchor
            some[own[around(own, offset, 2 * far)]] = True
        chosen, out = np.flatnonzero(some), [np.zeros((2, 0), np.int64)]
        for own, offset in self.occurrences(numbers[chosen, windows.anchor[live[chosen]]]):
            left = around(chosen[own], offset, far)
            out.append(np.stack([live[chosen[own[left]]], offset[left]]))
        return tuple(np.concatenate(out, axis=1))


def reach(n: int) -> int:
    """How many words from its anchor the terms of a window of ``n`` may lie in a proximity match: its length and half as much again."""
    return n - 1 + n // 2


def anchor(window: tuple[bytes, ...]) -> int:
    """The place in a window at which its proximity matches are placed: its longest term, the last in order of bytes of equal ones."""
    return max(range(len(window)), key=lambda k: (len(window[k]), window[k]))


class Windows:
    """Windows of ``n`` words of benchmark items, and one of all words of each shorter item, with the items of each."""

    def __init__(self, items: list[tuple[int, bytes]], n: int):
        of: dict[tuple[bytes, ...], set[int]] = {}
        for item, text in items:
            tokens = words(text)
            for k in range(max(1, len(tokens) - n + 1) if tokens else 0):
                of.setdefault(tuple(tokens[k : k + n]), set()).add(item)
        self.length = np.array([len(w) for w in of], np.int64)
        widest = int(self.length.max(initial=1))
        known = {w: term_of(w) for w in {w for window in of for w in window}}
        digests = np.zeros((len(of), widest), np.uint64)
        for k, window in enumerate(of):
            digests[k, : len(window)] = [known[w] for w in window]
        self.terms, which = np.unique(digests, return_inverse=True)
        self.which = which.reshape(digests.shape).astype(np.int32)
        self.filled = np.arange(widest) < self.length[:, None]
        self.anchor = np.array([anchor(w) for w in of], np.int64)
        self.reach = np.array([reach(len(w)) for w in of], np.int64)
        self.owners = np.concatenate([np.zeros(0, np.int64), *(np.array(sorted(x), np.int64) for x in of.values())])
        self.owner_ends = np.cumsum([0, *(len(x) for x in of.values())])

    def within(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows whose terms all occur in a block; their terms' numbers there, -1 beyond a window's end; places from the rarest term to the commonest, then those."""
        if not len(self.which):
            return np.zeros(0, np.int64), np.zeros((0, 1), np.int64), np.zeros((0, 1), np.int64)
        known = block.numbers(self.terms)
        live = np.flatnonzero(((known >= 0)[self.which] | ~self.filled).all(axis=1))
        numbers = np.where(self.filled[live], known[self.which[live]], -1)
        counts = np.where(numbers >= 0, (block.ends - block.firsts)[numbers] if len(block.ends) else 0, np.iinfo(np.int64).max)
        return live, numbers, np.argsort(counts, axis=1, kind="stable")

    def of_items(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``window`` its items: places among ``window``, and items."""
        n = self.owner_ends[window + 1] - self.owner_ends[window]
        own = np.repeat(np.arange(len(window)), n)
        return own, self.owners[self.owner_ends[window][own] + np.arange(len(own)) - (np.cumsum(n) - n)[own]]


def blocks(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[list[pa.RecordBatch], Block]]:
    """Blocks of rows, with the rows themselves."""
    rows, documents, size = [], [], 0
    for batch in batches:
        for piece, texts in text_pieces(batch, text_at):
            for text in texts:
                documents.append(words(text))
                size += len(documents[-1]) + 2
            rows.append(piece)
            if size >= BLOCK_TOKENS:
                yield rows, Block.of(documents)
                rows, documents, size = [], [], 0
    if rows:
        yield rows, Block.of(documents)


def as_bytes(values: np.ndarray, kind: type) -> bytes:
    return values.astype(kind).tobytes()


def make_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the index of batches of ids and texts; ``block`` numbers them."""
    number = TaskContext.get().partitionId() << 33
    for rows, block in blocks(batches, 1):
        ids = pa.chunked_array([r.column(0) for r in rows]).to_pylist()
        row = [[number], [ids], [as_bytes(block.starts, np.int64)], [as_bytes(block.terms, np.uint64)], [as_bytes(block.ends, np.int64)], [as_bytes(block.postings, np.int32)]]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["block", "doc_ids", "starts", "terms", "ends", "postings"])
        number += 1


def runs(block: Block, window: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the runs of tokens inside the given windows, in turn, and the document of each; no run crosses documents."""
    edge = np.zeros(block.span + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length[window], -1)
    hit = (np.cumsum(edge) > 0).astype(np.int8)
    turns = np.flatnonzero(np.diff(hit, prepend=0, append=0))
    return turns, block.document(turns)


def lookup(windows: Windows, every: bool) -> Batches:
    """Finds ``(block, place, doc_id, n_words, hits, items, near)`` in rows of the index, for ``every`` document or for those with a match.

    ``place``: of the document in its block.  ``hits``: runs ``[from, to)`` of
    word places inside an occurrence of a window, flattened; ``items``: those
    with an occurring window, ascending.  ``near``: proximity matches ``(item,
    place)``, in order: word places of a window's ``anchor`` with all its terms,
    in any order and with other words between, at most ``reach`` words away in
    the same document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                block = Block(*(np.frombuffer(row[c], kind).astype(to) for c, kind, to in (("starts", np.int64, np.int64), ("terms", np.uint64, np.uint64), ("ends", np.int64, np.int64), ("postings", np.int32, np.int64))))
                yield searched(row["block"], row["doc_ids"], block)

    def searched(number: int, ids: list, block: Block) -> pa.RecordBatch:
        starts, n = block.starts, len(ids)
        window, at = block.phrases(windows)
        turns, run_doc = runs(block, window, at, windows.length)
        own, item = windows.of_items(window)
        pairs = np.unique(np.stack([block.document(at)[own], item]), axis=1)
        close, middle = block.proximities(windows)
        own, item = windows.of_items(close)
        doc = block.document(middle)[own]
        near = np.unique(np.stack([doc, item, middle[own] - starts[doc]]), axis=1)
        bounds = [np.searchsorted(x, np.arange(n + 1)).astype(np.int32) for x in (run_doc, pairs[0], near[0])]
        keep = np.arange(n) if every else np.flatnonzero((np.diff(bounds[1]) > 0) | (np.diff(bounds[2]) > 0))
        lists = [pa.array((turns - starts[run_doc]).astype(np.int32)), pa.array(pairs[1]), pa.StructArray.from_arrays([pa.array(near[1]), pa.array(near[2].astype(np.int32))], names=["item", "place"])]
        arrays = [pa.array(np.full(n, number, np.int64)), pa.array(np.arange(n, dtype=np.int32)), pa.array(ids, pa.int64()), pa.array(np.diff(starts) - 2), *[pa.ListArray.from_arrays(pa.array(b), x) for b, x in zip(bounds, lists, strict=True)]]
        return pa.RecordBatch.from_arrays([a.take(pa.array(keep)) for a in arrays], names=["block", "place", "doc_id", "n_words", "hits", "items", "near"])

    return run


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of whole ``docs``, written to ``path`` as Parquet, to be searched now and again."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    texts.mapInArrow(make_index, INDEX).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def lots(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, bytes]]]:
    """The items in lots of about ``LOT_TOKENS`` tokens, one after the other; there is one at least.

    Items with a null id or text are left out.  An item is in the lot that its
    hash says.
    """
    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("binary").alias("text")).where("item is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text") / 4)).first()[0] or 0  # tokens are at most that many, but for very short ones
    n = max(1, -(-int(size) // LOT_TOKENS))
    for lot in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == lot)
        yield [(r["item"], bytes(r["text"])) for r in part.toLocalIterator()]


def matches(index: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", n: int = PHRASE) -> DataFrame:
    """``(doc_id, n_words, hits, items, near)``, a row for each document of a stored index; see ``lookup``.

    A benchmark is looked up lot by lot, each with the whole index, and what a
    document has in several lots is brought together by its place in the index,
    so that the number of lots changes nothing and documents that share an id, or
    have none, stay apart.  Items that repeat an id count as one.
    """
    found: DataFrame | None = None
    several = False
    for items in lots(benchmark, item_col, item_text_col):
        if found is not None:  # the driver holds one lot at a time
            found, several = checkpointed(found), True
        part = index.mapInArrow(lookup(Windows(items, n), every=found is None), FOUND)
        found = part if found is None else found.union(part)
    if several:
        covered = F.expr("flatten(transform(sequence(0, size(hits) - 2, 2), k -> sequence(hits[k], hits[k + 1] - 1)))")
        places = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.size("hits") > 0, covered)))))
        several_lists = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near")]
        merged = found.groupBy("block", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), places.alias("places"), *several_lists)
        firsts, lasts = (F.expr(f"filter(places, (p, k) -> not (get(places, k {sign} 1) <=> p {sign} 1))") for sign in "-+")
        bounds = F.flatten(F.zip_with(firsts, lasts, lambda a, b: F.array(a, b + 1)))
        found = merged.withColumn("hits", bounds)
    return found.select("doc_id", "n_words", "hits", "items", "near")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = PHRASE) -> DataFrame:
    """``(doc_id, n_words, hits, items, near)``, a row for each row of ``docs``: their index, stored in the checkpoint folder, searched for the benchmark.

    A null text has no words and no hits; so has every document if the benchmark
    is empty or its texts are.  Rows of ``docs`` that share an id, or have none,
    have a row each.  Items with a null id or text take no part.
    """
    path = f"{checkpoint_folder(docs.sparkSession)}/postings-{uuid.uuid4().hex}"
    return matches(build_index(docs, path, id_col, text_col), benchmark, item_col, item_text_col, n)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = PHRASE) -> DataFrame:
    """The rows of ``docs`` without a phrase match, each judged by itself, whatever its id.

    Every block of the index is searched where it is made, beside its rows, so
    that no text is moved.  Rows with a null text stay; other columns are kept
    as they are.
    """
    at = docs.columns.index(text_col)
    for items in lots(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(keeper(Windows(items, n), at), docs.schema)
    return docs


def keeper(windows: Windows, text_at: int) -> Batches:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in blocks(batches, text_at):
            keep = np.ones(len(block.starts) - 1, bool)
            keep[block.document(block.phrases(windows)[1])] = False
            first = 0
            for piece in rows:
                yield piece.filter(pa.array(keep[first : first + piece.num_rows]))
                first += piece.num_rows

    return run


def digest(found: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of what ``contamination`` found."""
    n_hit = F.expr("cast(aggregate(transform(hits, (x, k) -> if(k % 2 = 0, -x, x)), 0, (a, x) -> a + x) as bigint)")
    listed = F.array_join(F.sort_array(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


#: The same rows in SQL, by a join of hashed windows.
DECONTAMINATION_SQL = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bg AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, k, k + n - 1), ' ') AS g
  FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS k FROM bw WHERE len(ws) > 0)),
dg AS (
  SELECT doc_id, n, k, array_to_string(list_slice(ws, k, k + n - 1), ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k
        FROM dw CROSS JOIN (SELECT DISTINCT n FROM bg) WHERE len(ws) >= n)),
m AS (SELECT dg.doc_id, dg.k, dg.n, bg.item_id FROM dg JOIN bg ON dg.n = bg.n AND dg.g = bg.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM m)) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h ON dw.doc_id = h.doc_id LEFT JOIN i ON dw.doc_id = i.doc_id
"""
