"""Exact top-k inner products with a vector-approximation file.

The file is a stored table with a byte for each component of a vector: the cell
in which it lies, of 32 cells between the component's least and greatest value.  Beside
it lie the exact components, in the smallest kind of whole number that holds them.
Queries meet the cells in pairs of blocks, and each score is bounded from both
sides.  Exact vectors of the block are then read in the order of the bounds: first those
of the best upper bounds of each query, then only those whose upper bound reaches
the least exact score of these, after which the best of the block are certain.  Where
both bounds of a score are the same, as with cells that are one number wide,
nothing is read.  Of each pair of blocks only the best of each query come out, so
that neither a task nor a table holds more, however little the bounds tell apart.

Of rows with one and the same vector the first ``k + 1`` by id can be among the
results and the others can't, so that only these are candidates, and a very
common vector is no more of them than a rare one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.llm.shared import stored

#: Vectors and queries of a block, on average; fewer of more than so many components, and fewer queries with more than so many results.
BLOCK, QUERY_BLOCK, USUAL = 65_536, 4_096, 64
#: Bits of a cell.
BITS = 5
#: Scores that are bounded at once.
AT_ONCE = 1 << 22
#: Scores must be below this to be whole numbers of 64 bits.
LARGEST = 2**63
FOUND = "query long, query_id long, row long, id long, score long, read long"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, is_query: Column) -> DataFrame:
    """``(row, id, v, dim, asks)``: components times ``scale``, rounded down, as doubles; rows without an id, a vector or a finite component are left out."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform(vector_col, lambda x: x.cast("double") * scale)
    usable = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(False))
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    # Spark's floor gives a long, which a large double leaves; an own floor of those stays a double and is refused later
    floor = F.transform("v", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", floor.alias("v"), F.size("v").alias("dim"), "asks")


@dataclass
class Cells:
    """Component d of a vector lies in ``low[d] + cell * width[d]`` and up to ``width[d] - 1`` above."""

    low: np.ndarray
    width: np.ndarray
    high: np.ndarray

    @staticmethod
    def over(least: list[float], most: list[float], bits: int = BITS) -> Cells:
        low, high = np.array(least, np.int64), np.array(most, np.int64)
        return Cells(low, (high - low) // (1 << bits) + 1, high)

    @property
    def largest(self) -> int:
        """No component is farther from 0."""
        return max(int(np.abs(self.low).max(initial=0)), int(np.abs(self.high).max(initial=0)))

    @property
    def kind(self) -> type:
        """The smallest kind of whole number that holds all components."""
        return next(kind for kind in (np.int8, np.int16, np.int32, np.int64) if self.largest <= np.iinfo(kind).max)

    def of(self, exact: np.ndarray) -> np.ndarray:
        return ((exact.astype(np.int64) - self.low) // self.width).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of whole queries: weights of the cells, and what to add to the weighted sum for a lower and an upper bound of the score.

        Weights have the smallest kind of number in which all sums are exact.
        """
        most = max(int(x) for x in (np.abs(queries).max(initial=0), np.abs(self.low).max(initial=0), self.width.max(initial=0)))
        if most * most * 4 * max(1, len(self.low)) >= LARGEST:  # Python's numbers, exact but slow
            queries, low, width = queries.astype(object), self.low.astype(object), self.width.astype(object)
        else:
            low, width = self.low, self.width
        base, room, weights = queries @ low, width - 1, queries * width
        largest = 256 * int(np.abs(weights).sum(axis=1).max(initial=0))
        return weights.astype(object if weights.dtype == object else summed_in(largest)), base + np.minimum(queries, 0) @ room, base + np.maximum(queries, 0) @ room


def summed_in(largest: int) -> type:
    """A kind of number in which whole numbers up to ``largest`` are exact, the fastest."""
    return np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1 if len(flat.flatten()) else 0)


def byte_matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), -1 if joined else 0)


def extremes(vectors: DataFrame) -> dict[int, Cells]:
    """Cells for the vectors of each length, from the least and greatest of every component."""
    rows = vectors.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at").agg(F.min("x").alias("least"), F.max("x").alias("most"))
    found: dict[int, list] = {}
    for r in rows.orderBy("dim", "at").collect():  # a row for each component
        found.setdefault(r["dim"], []).append((r["least"], r["most"]))
    for dim, ends in found.items():
        largest = sum(max(int(a) ** 2, int(b) ** 2) for a, b in ends)
        if largest >= LARGEST:
            raise ValueError(f"scores of vectors of {dim} components may need {largest.bit_length()} bits; only those below 2**63 are whole numbers of 64 bits")
    return {dim: Cells.over([int(a) for a, _ in ends], [int(b) for _, b in ends]) for dim, ends in found.items()}


def approximations(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """The vector-approximation file ``(row, id, dim, cells, exact)``."""

    def run(batches):
        for batch in batches:
            out, exact = [b""] * batch.num_rows, [b""] * batch.num_rows
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim:
                    numbers = matrix(pa.chunked_array([batch.column(3).take(pa.array(at))]))
                    for k, row, own in zip(at.tolist(), cells[dim].of(numbers), numbers.astype(cells[dim].kind), strict=True):
                        out[k], exact[k] = row.tobytes(), own.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary()), pa.array(exact, pa.binary())], names=["row", "id", "dim", "cells", "exact"])

    return vectors.select("row", "id", "dim", "v").mapInArrow(run, "row long, id long, dim int, cells binary, exact binary")


def reached_by(sums: np.ndarray, most: int) -> np.ndarray:
    """For each row of ``sums`` a number that ``most`` of its elements or some more reach: the ``most``-th of the maxima of pieces; with fewer elements, the least."""
    n = sums.shape[1]
    if n <= most:
        return sums.min(axis=1)
    width = max(1, n // (8 * most))
    pieces = n // width
    maxima = sums[:, : pieces * width].reshape(len(sums), pieces, width).max(axis=2)
    return np.partition(maxima, pieces - most, axis=1)[:, pieces - most]


def certain(total: np.ndarray, low: int, high: int, reached: int, exact: np.ndarray, query: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of a query and a block: places of its ``most`` best vectors (ties go to the smaller place), their scores, and how many exact vectors were read.

    A score is ``total + low`` at least and ``total + high`` at most; ``most``
    totals reach ``reached``, unless there are fewer.
    """
    score = lambda at: (exact[at].astype(query.dtype) @ query).astype(np.int64)
    first = np.flatnonzero(total >= reached)
    first = first[np.argsort(-total[first], kind="stable")[:most]]
    if low == high:
        sums = total[first]
        return first, ((sums if sums.dtype == object else sums.astype(np.int64)) + low).astype(np.int64), 0
    scores = score(first)
    open_ones = total >= int(scores.min()) - int(high)
    open_ones[first] = False
    rest = np.flatnonzero(open_ones)
    at, scores = np.concatenate([first, rest]), np.concatenate([scores, score(rest)])
    best = np.lexsort((at, -scores))[:most]
    return at[best], scores[best], len(at)


def best_of_blocks(queries: DataFrame, file: DataFrame, cells: dict[int, Cells], most: int, blocks: int, query_blocks: int) -> DataFrame:
    """``FOUND``: for each query the ``most`` best rows of each block of the file, but its own; ``read``: how many exact vectors that took, on one of these rows."""
    own = lambda n, c: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["g", "h", "dim"]
    left = queries.select("query", "query_id", "v", "dim", own(query_blocks, "query").alias("h"), all_of(blocks).alias("g"))
    right = file.select("row", "id", "cells", "exact", "dim", own(blocks, "row").alias("g"), all_of(query_blocks).alias("h"))

    def run(asked: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if asked.num_rows and candidates.num_rows:
            asks, names, q = asked.column("query").to_numpy(), asked.column("query_id").to_numpy(), matrix(asked.column("v")).astype(np.int64)
            rows, ids = candidates.column("row").to_numpy(), candidates.column("id").to_numpy()
            order = np.lexsort((rows, ids))  # so that places settle ties
            rows, ids, dim = rows[order], ids[order], q.shape[1]
            own_cells = cells[dim] if dim else Cells.over([], [])
            scan, exact = (byte_matrix(candidates.column(c), kind)[order] for c, kind in (("cells", np.uint8), ("exact", own_cells.kind)))
            weights, low, high = own_cells.bounds(q)
            scan, numbers = scan.T.astype(weights.dtype), q.astype(summed_in(own_cells.largest**2 * dim))
            step = max(1, AT_ONCE // len(rows))
            for first in range(0, len(q), step):
                sums = weights[first : first + step] @ scan
                for i, (total, reached) in enumerate(zip(sums, reached_by(sums, most), strict=True), first):
                    at, scores, read = certain(total, low[i], high[i], reached, exact, numbers[i], most)
                    other = rows[at] != asks[i]
                    at, scores, reads = at[other], scores[other], np.zeros(other.sum(), np.int64)
                    reads[:1] = read
                    out.append((np.full(len(at), asks[i]), np.full(len(at), names[i]), rows[at], ids[at], scores, reads))
        columns = [np.concatenate([x[j] for x in out]) if out else np.zeros(0, np.int64) for j in range(6)]
        return pa.table(columns, names=["query", "query_id", "row", "id", "score", "read"])

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, FOUND)


def parts(rows: DataFrame, block: int, results: int = 0) -> int:
    """Blocks of ``rows``, so many that those of no length are more than ``block`` of the usual number of components and of results."""
    return max((-(-r["count"] * max(USUAL, r["dim"], results) // (block * USUAL)) for r in rows.groupBy("dim").count().collect()), default=1)  # a row for each length


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, counted: list[int] | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``k`` best other rows, by integer inner product.

    Queries are the rows of ``vectors`` that ``is_query`` picks; candidates are
    all rows but the query's own.  Rows that repeat an id are queries and
    candidates of their own.  Ranks start at 1, ties go to the smaller id; with
    fewer than ``k`` candidates all come back.  Vectors that are null or hold a
    null or non-finite component take no part; vectors of another length than
    the query's are no candidates.  Where a score could reach 2**63 it is an
    error.  An empty table gives no rows.  ``counted`` gets how many exact
    vectors were read, if it is given.
    """
    rows = stored(whole_vectors(vectors, id_col, vector_col, scale, is_query))
    cells = extremes(rows)
    small = all(-(2**31) <= end < 2**31 for c in cells.values() for end in (*c.low, *(c.low + (c.width << BITS))))
    rows = rows.withColumn("v", F.col("v").cast("array<int>" if small else "array<bigint>"))
    # the first k + 1 of equal vectors; the window's limit acts before the shuffle too
    firsts = rows.withColumn("nth", F.row_number().over(W.partitionBy("v").orderBy("id", "row"))).where(F.col("nth") <= k + 1).drop("nth", "asks")
    file = stored(approximations(firsts, cells))
    asked = rows.where("asks").select(F.col("row").alias("query"), F.col("id").alias("query_id"), "v", "dim")
    found = stored(best_of_blocks(asked, file, cells, k + 1, parts(file, BLOCK), parts(asked, QUERY_BLOCK, min(k + 1, BLOCK))))
    if counted is not None:
        counted.append(found.agg(F.sum("read")).first()[0] or 0)
    by_score = W.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


#: The same rows in SQL, from all pairs.
TOP_K_SQL = r"""
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, q, unnest(range(1, len(q) + 1)) AS d FROM v),
c AS (SELECT vec_id, d, q[d] AS x FROM e),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM c a JOIN c b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
