"""Vectors compressed to codes of their parts, by dictionaries of the values of each dimension.

Vectors of whole numbers are stored in blocks of rows.  A block has, for each
dimension, a dictionary of the distinct numbers that occur there, and for each
row the number's place in it.  To compare a block with a codebook, the squared
differences of every dictionary value to all entries are tabulated; the distance
of a row's part to all entries is then gathered from these tables by the row's
dictionary codes, and added up over the part's dimensions.  A square is worked
out once for each distinct number and entry, however many rows have it.

Codebooks are improved in rounds.  Tasks return sums and counts of what they
assigned, as many as a codebook has numbers; Spark adds them up, and only
codebooks, whose size is that of ``entries`` vectors, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casona.llm.shared import stored

#: Rows of a block at most, and its numbers.
BLOCK_ROWS, BLOCK_NUMBERS = 4_096, 1 << 22
#: Numbers from here on don't fit.
LARGEST = 2.0**62


@dataclass
class Codebooks:
    """``entries[part, entry, position]``: whole numbers."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of all numbers as decimals, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and has finite components alone."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(False)))


def whole(flat: np.ndarray, scale: int) -> np.ndarray:
    """Components times ``scale``, rounded down."""
    numbers = np.floor(flat.astype(np.float64) * scale)
    if numbers.size and np.abs(numbers).max() >= LARGEST:
        raise ValueError("a component times the scale is 2**62 or more")
    return numbers.astype(np.int64)


def narrow(codes: np.ndarray, values: int) -> bytes:
    return codes.astype(np.uint8 if values <= 1 << 8 else np.uint16 if values <= 1 << 16 else np.uint32).tobytes()


def widened(codes: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(codes, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(codes) // rows])


def encoded(rows: DataFrame, dim: int, scale: int) -> DataFrame:
    """Blocks ``(n, ids, labels, dictionaries, codes)`` of rows ``(id, label, v)``; the last two have an element for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, dim)))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                piece = batch.slice(first, step)
                n, ids, labels, v = piece.num_rows, piece.column(0), piece.column(1), piece.column(2)
                if (lengths := set(v.value_lengths().to_pylist())) != {dim}:
                    raise ValueError(f"vectors of {sorted(lengths)} components among those of {dim}")
                numbers = whole(v.flatten().to_numpy(zero_copy_only=False), scale).reshape(n, dim)
                found = [np.unique(numbers[:, d], return_inverse=True) for d in range(dim)]
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                bytes_of = lambda xs: one(pa.array(xs, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int32()), one(ids), one(labels), bytes_of([values.tobytes() for values, _ in found]), bytes_of([narrow(codes, len(values)) for values, codes in found])],
                    names=["n", "ids", "labels", "dictionaries", "codes"],
                )

    types = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    return rows.select("id", "label", "v").mapInArrow(run, f"n int, ids array<{types[0]}>, labels array<{types[1]}>, dictionaries array<binary>, codes array<binary>")


def nearest(dictionaries: list[np.ndarray], codes: list[np.ndarray], rows: int, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part's codebook ``(part, row)``, the first of several, and its squared distance."""
    parts, entries, width = books.shape
    ends = [int(x) for a in (books, *dictionaries) if a.size for x in (a.min(), a.max())] or [0]
    most = (max(ends) - min(ends)) ** 2 * max(1, width)
    # beyond what machine integers hold Python's go on, exact but slow
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    found, distances = np.zeros((parts, rows), np.int64), np.zeros((parts, rows), object if kind is object else np.int64)
    for part in range(parts):
        total = np.zeros((rows, entries), kind)
        for position in range(width):
            d = part * width + position
            values = dictionaries[d].astype(object) if kind is object else dictionaries[d]
            table = ((values[:, None] - books[part, :, position][None, :]) ** 2).astype(kind)
            total += table.take(codes[d], axis=0)
        found[part] = total.argmin(axis=1)
        distances[part] = np.take_along_axis(total, found[part][:, None], axis=1)[:, 0]
    return found, distances


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[np.ndarray], list[np.ndarray]]]:
    """Each block of a table of blocks: itself, its rows, its dictionaries and codes."""
    for batch in batches:
        for k in range(batch.num_rows):
            block = batch.slice(k, 1)
            n = block.column("n")[0].as_py()
            yield block, n, [np.frombuffer(x, np.int64) for x in block.column("dictionaries")[0].as_py()], [widened(x, n) for x in block.column("codes")[0].as_py()]


def improved(file: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the means, rounded down, of the parts that are nearest to them; an entry without one stays."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, width, entries), object), np.zeros((parts, entries), np.int64)
        for _, n, dictionaries, codes in blocks_of(batches):
            found, _ = nearest(dictionaries, codes, n, books)
            for part in range(parts):
                own = found[part]
                counts[part] += np.bincount(own, minlength=entries)
                for position in range(width):
                    # how often each dictionary value went to each entry: the sums are exact
                    values = dictionaries[d := part * width + position]
                    pairs, times = np.unique(own * len(values) + codes[d], return_counts=True)
                    share = values[pairs % len(values)].astype(object) * times
                    np.add.at(sums[part, position], pairs // len(values), share)
        part, entry = np.nonzero(counts)
        if width:
            flat = [(p * width + at, e, sums[p, at, e], counts[p, e]) for p, e in zip(part.tolist(), entry.tolist(), strict=True) for at in range(width)]
            d, e, total, count = zip(*flat, strict=True) if flat else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(e, pa.int32()), pa.array([str(x) for x in total], pa.string()), pa.array(count, pa.int64())], names=["d", "entry", "total", "k"])

    partial = file.select("n", "dictionaries", "codes").mapInArrow(run, "d int, entry int, total string, k long")
    rows = partial.groupBy("d", "entry").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("k").alias("k")).collect()  # a row for each number of the codebooks
    better = books.copy()
    for r in rows:
        better[r["d"] // width, r["entry"], r["d"] % width] = int(r["total"]) // r["k"]
    return better


def coded(file: DataFrame, books: np.ndarray) -> DataFrame:
    """``(id, label, code, error)`` of every row: its parts' entries as hex digits, two each, and the squared distances' sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, n, dictionaries, codes in blocks_of(batches):
            found, distances = nearest(dictionaries, codes, n, books)
            text = found.T.astype(np.uint8).tobytes().hex()
            size = 2 * len(found)
            errors = [int(x) for x in distances.sum(axis=0)]
            if max(errors) >= 2**63:
                raise ValueError("an error is 2**63 or more")
            yield pa.RecordBatch.from_arrays([block.column("ids").flatten(), block.column("labels").flatten(), pa.array([text[k * size : (k + 1) * size] for k in range(n)], pa.string()), pa.array(errors, pa.int64())], names=["id", "label", "code", "error"])

    element = lambda c: file.schema[c].dataType.elementType.simpleString()
    return file.select("n", "ids", "labels", "dictionaries", "codes").mapInArrow(run, f"id {element('ids')}, label {element('labels')}, code string, error long")


def compressed(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks] | None:
    """Codes ``(id, label, code, error)`` of all vectors with finite components, and their codebooks; nothing if there is none.

    Components count as whole numbers, ``scale`` times themselves rounded down.
    Codebooks start with the parts of the rows with the ``entries`` smallest ids
    (at most 256; nulls last, equal ids by vector; fewer rows give fewer
    entries).  Rows that repeat are rows of their own.  Vectors must have one
    length that ``parts`` divides; others are an error, as is a number of 2**62
    or more.  Vectors without components have codes of zeros.
    """
    kept = usable(vectors, vector_col).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    first = kept.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    if not first:
        return None
    lengths = {len(r["v"]) for r in first}
    if len(lengths) > 1 or next(iter(lengths)) % parts:
        raise ValueError(f"vectors of {sorted(lengths)} components can't be cut into {parts} equal parts")
    dim = lengths.pop()
    start = whole(np.array([r["v"] for r in first], np.float64), scale).reshape(len(first), parts, dim // parts)
    books = start.transpose(1, 0, 2).copy()
    file = stored(encoded(kept, dim, scale))
    for _ in range(rounds):
        books = improved(file, books)
    return coded(file, books), Codebooks(books)


def digest(vectors: DataFrame) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``: ``label_error`` is the error of all rows of a label, nulls together; an empty table gives no rows."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    found = compressed(vectors)
    if found is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    rows, books = stored(found[0]), found[1]
    # stored: the join deals out both sides anew, so that a label with very many rows can be split over tasks
    labels = stored(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    joined = rows.join(labels, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def round_sql(k: int) -> str:
    """Assignment ``a{k}`` to the entries ``b{k}``."""
    return f"""
d{k} AS (SELECT e.vec_id, e.part, b.entry, sum((e.x - b.x) * (e.x - b.x)) AS distance FROM e JOIN b{k} b ON b.d = e.d GROUP BY ALL),
a{k} AS (SELECT vec_id, part, entry, distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY distance, entry) AS n FROM d{k}) WHERE n = 1)"""


def better_sql(k: int) -> str:
    """Entries ``b{k + 1}`` from the assignment ``a{k}``."""
    return f"""
b{k + 1} AS (
  SELECT b.entry, b.part, b.d, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT a.entry, e.d, CAST(floor(CAST(sum(e.x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM a{k} a JOIN e ON e.vec_id = a.vec_id AND e.part = a.part GROUP BY ALL) m
  ON m.entry = b.entry AND m.d = b.d)"""


#: The same rows in SQL, where ids are unique.
CODES_SQL = f"""
WITH v AS (
  SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, q, unnest(range(1, len(q) + 1)) AS d FROM v),
e AS (SELECT vec_id, d, CAST(floor((d - 1) / (len(q) / 16)) AS INTEGER) AS part, q[d] AS x FROM u),
o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v),
b0 AS (SELECT entry, part, d, x FROM e JOIN o USING (vec_id) WHERE entry < 64),{round_sql(0)},{better_sql(0)},{round_sql(1)},{better_sql(1)},{round_sql(2)},
f AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, d)) FROM b2) AS codebooks_sha256
FROM f JOIN v USING (vec_id)
"""
