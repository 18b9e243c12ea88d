"""Substring deduplication by hashed units: paragraphs, lines, or lines cut further at the ends of sentences.

Every unit is normalised and hashed, digests are grouped over the whole corpus,
the occurrence that comes first in order of (document id, row, unit) stays, and
all others are reported with their offsets in the original text, so that they
can be cut out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casona.llm.shared import stored, text_pieces

WHITE = " \t\r\n\x0b\x0c"
#: Where units end.  A sentence's end is one mark after a word, before white space, or a mark of a script without blanks.
UNIT_ENDS = {
    "paragraph": re.compile(r"\n[ \t\r\x0b\x0c]*\n\s*"),
    "line": re.compile(r"\n"),
    "sentence": re.compile(r"\n|(?<=[^ \t\r\n\x0b\x0c.!?])[.!?](?=[ \t\r\n\x0b\x0c])|[。！？｡]"),
}
#: Characters of scripts that put no blanks between words: each counts as a word.
UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
EDGES = WHITE + ".,;:!?\"'()[]。！？｡、，"
#: Words of a run of repeated units from which it is called a passage.
PASSAGE_WORDS = 20
UNITS = "row long, doc_id long, unit int, start int, stop int, words int, again boolean, h1 long, h2 long"


def units(text: str, unit: str = "sentence") -> Iterator[tuple[int, int, int, bytes]]:
    """``(start, stop, words, normalised)`` of the units of a text that have a word; offsets in characters.

    Normalised: lower case, white space runs as one blank, no punctuation at the
    ends.  A character of a script without blanks counts as a word.
    """
    at, unspaced = 0, not text.isascii() and UNSPACED.search(text) is not None
    ends = [m.end() for m in UNIT_ENDS[unit].finditer(text)]
    for end in [*ends, len(text)]:
        raw = text[at:end]
        words = raw.lower().strip(EDGES).encode("utf-8", "surrogatepass").split()
        if words:
            left = len(raw) - len(raw.lstrip(WHITE))
            n = sum(max(1, len(UNSPACED.findall(w.decode("utf-8", "surrogatepass")))) for w in words) if unspaced else len(words)
            yield at + left, at + len(raw.rstrip(WHITE)), n, b" ".join(words)
        at = end


def hashed_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", row_col: str | None = None) -> DataFrame:
    """The units of whole ``docs`` with 128-bit digests; ``again``: the text has the unit already.  Null texts have none.

    ``row``: ``row_col``, or a number made for each row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 33
        for piece, texts in (x for b in batches for x in text_pieces(b, 1, binary=False)):
            ids = piece.column(0).to_pylist()
            rows = piece.column(2).to_pylist() if row_col else range(made, made + len(texts))
            made += len(texts)
            kept: list[tuple[int, int | None]] = []
            counts: list[int] = []
            numbers: list[tuple[int, ...]] = []
            digests: list[bytes] = []
            for row, doc, text in zip(rows, ids, texts, strict=True):
                seen: set[bytes] = set()
                before = len(digests)
                for start, stop, n, normalised in units(text or "", unit):
                    digest = xxhash.xxh3_128_digest(normalised)
                    numbers.append((len(digests) - before, start, stop, n, digest in seen))
                    digests.append(digest)
                    seen.add(digest)
                kept.append((row, doc))
                counts.append(len(digests) - before)
            if digests:
                yield as_batch(kept, counts, numbers, digests)

    def as_batch(kept: list[tuple[int, int | None]], counts: list[int], numbers: list[tuple[int, ...]], digests: list[bytes]) -> pa.RecordBatch:
        of = pa.array(np.repeat(np.arange(len(counts)), counts))
        whole, halves = np.array(numbers, np.int32), np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        owner = [pa.array([k[j] for k in kept], pa.int64()).take(of) for j in (0, 1)]
        arrays = [*owner, *[pa.array(whole[:, k].copy()) for k in range(4)], pa.array(whole[:, 4] == 1), *[pa.array(halves[:, k].copy()) for k in (0, 1)]]
        return pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "unit", "start", "stop", "words", "again", "h1", "h2"])

    more = [F.col(row_col).cast("long").alias("row")] if row_col else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more).mapInArrow(run, UNITS)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = 0, unit_words: int = 0, row_col: str | None = None) -> DataFrame:
    """``(doc_id, start, stop, n_units, n_words, kept_doc_id, passage, row)``: what to remove, as character offsets ``[start, stop)``.

    A row is a run of consecutive units of a document none of which is the first
    of its kind in the corpus; all such units are reported.  ``kept_doc_id`` keeps
    the first of them.  ``passage``: the run has ``PASSAGE_WORDS`` words, so
    that it is hardly chance.  Rows without an id come last in the order; rows
    that share an id follow one another in the order of the table, and each is a
    document of its own.  A text that repeats itself loses its later occurrences;
    texts that are null, empty or without a word have no rows.

    ``min_words`` leaves in what lies in runs of fewer words, of which units of
    fewer than ``unit_words`` words don't count; neither is set by default.
    """
    keys = ["h1", "h2"]
    found = stored(hashed_units(docs, id_col, text_col, unit, row_col))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1")
    # written, so that the join deals out both sides anew and a very common unit can be split over tasks
    first = stored(first.select(*keys, F.col("first.row").alias("first_row"), F.col("first.doc_id").alias("kept_doc_id")))
    later = found.join(first, keys).where("again or row <> first_row").drop(*keys, "again", "first_row")
    # a text was whole in one task already, and its units take less room
    runs = later.withColumn("run", F.col("unit") - F.row_number().over(W.partitionBy("row").orderBy("unit")))
    spans = runs.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.count(F.lit(1)).cast("int").alias("n_units"), F.sum("words").cast("int").alias("n_words"),
        F.min_by("kept_doc_id", "unit").alias("kept_doc_id"), F.sum(F.when(F.col("words") >= unit_words, F.col("words")).otherwise(0)).alias("counted"),
    ).where(F.col("counted") >= min_words)
    return spans.select("doc_id", "start", "stop", "n_units", "n_words", "kept_doc_id", (F.col("n_words") >= PASSAGE_WORDS).alias("passage"), "row")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = 0, unit_words: int = 0) -> DataFrame:
    """``docs`` with the spans cut out of their texts; ``removed`` holds the spans in original offsets, in order."""
    columns = [c for c in docs.columns if c != "removed"]
    rows = stored(docs.select(*columns).withColumn("__row", F.monotonically_increasing_id()))
    spans = repeated_spans(rows, id_col, text_col, unit, min_words, unit_words, "__row")
    cuts = spans.groupBy(F.col("row").alias("__row")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("removed"))
    pieces = F.transform(F.sequence(F.lit(0), F.size("removed")), lambda k: F.substring(F.col(text_col), F.when(k == 0, 1).otherwise(F.get("removed", k - 1)["stop"] + 1), F.when(k == F.size("removed"), F.length(text_col)).otherwise(F.get("removed", k)["start"]) - F.when(k == 0, 0).otherwise(F.get("removed", k - 1)["stop"])))
    text = F.when(F.col("removed").isNull(), F.col(text_col)).otherwise(F.array_join(pieces, ""))
    empty = F.expr("cast(array() as array<struct<start: int, stop: int>>)")
    return rows.join(cuts, "__row", "left").select(*[text.alias(c) if c == text_col else F.col(c) for c in columns], F.coalesce("removed", empty).alias("removed"))


#: The spans of ``documents``, cut at sentences, in SQL: digests are the normalised units themselves.
REPEATS_SQL = r"""
WITH w AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS white),
m AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '([^ \t\r\n\x0b\x0c.!?][.!?])([ \t\r\n\x0b\x0c])', '\1' || chr(1) || '\2', 'g'), '(\n|[。！？｡])', '\1' || chr(1), 'g'), chr(1)) AS parts
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS k FROM m),
o AS (SELECT *, coalesce(sum(length(raw)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM p),
n AS (
  SELECT doc_id, k, off + length(raw) - length(ltrim(raw, white)) AS start, off + length(rtrim(raw, white)) AS stop,
         regexp_extract_all(trim(lower(raw), white || '.,;:!?"''()[]。！？｡、，'), '[^ \t\r\n\x0b\x0c]+') AS ws
  FROM o, w),
u AS (
  SELECT doc_id, start, stop, array_to_string(ws, ' ') AS unit, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS k,
         list_sum([greatest(1, len(regexp_extract_all(x, '[\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3005}-\x{3007}\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{ff66}-\x{ff9f}\x{20000}-\x{3ffff}]'))) FOR x IN ws]) AS words
  FROM n WHERE len(ws) > 0),
f AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, k) AS nth, first_value(doc_id) OVER (PARTITION BY unit ORDER BY doc_id, k) AS kept FROM u),
r AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM f WHERE nth > 1)
SELECT doc_id, CAST(min(start) AS INTEGER) AS start, CAST(max(stop) AS INTEGER) AS stop, CAST(count(*) AS INTEGER) AS n_units, CAST(sum(words) AS INTEGER) AS n_words,
       arg_min(kept, k) AS kept_doc_id, sum(words) >= 20 AS passage
FROM r GROUP BY doc_id, run
"""
