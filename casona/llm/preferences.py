"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions.

The longest common prefix of turns is rendered once; what follows it on either
side is a completion.  A mask says which characters of a completion are trained
on: what the assistant says, with the end mark of its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casona.llm.shared import stored

START, END, GAP = "<|im_start|>", "<|im_end|>", "\n"
ASSISTANT = "assistant"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + GAP))


def spans(turns: Column) -> Column:
    """``[from, to)`` in characters of the rendered turns, one for each turn of the assistant."""
    length = lambda t: F.length(rendered(t))
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, stop: int>>)").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        stop = acc["at"] + length(turn)
        span = F.struct((acc["at"] + F.length(turn["role"]) + len(START) + 1).alias("start"), (stop - len(GAP)).alias("stop"))
        grown = F.when(turn["role"] == ASSISTANT, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(stop.alias("at"), grown.alias("spans"))

    return F.aggregate(turns, zero, step)["spans"]


def conversations_of(turns: DataFrame, key: str) -> DataFrame:
    """``(key, turns)``: the turns of each conversation in order.  Rows that repeat count once; a null role or text is empty."""
    rows = turns.select(key, "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where(F.col(key).isNotNull() & F.col("turn").isNotNull())
    ordered = F.array_sort(F.array_distinct(F.collect_list(F.struct("turn", "role", "text"))))
    return rows.groupBy(key).agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def formatted(both: DataFrame, key: str) -> DataFrame:
    """``(key, prefix_turns, prompt, chosen, rejected, chosen_mask, rejected_mask, usable)`` of rows ``(key, good, bad)`` with the turns of either side."""
    same = F.zip_with("good", "bad", lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(same, F.lit(False))  # places beyond the shorter one differ
    both = both.withColumn("prefix_turns", F.when(differs > 0, differs - 1).otherwise(F.size("good")).cast("int"))
    rest = [F.slice(c, F.col("prefix_turns") + 1, F.greatest(F.size(c) - F.col("prefix_turns"), F.lit(0))) for c in ("good", "bad")]
    text = lambda turns: F.array_join(F.transform(turns, rendered), "")
    out = both.select(key, "prefix_turns", text(F.slice("good", F.lit(1), F.col("prefix_turns"))).alias("prompt"), *[x.alias(c) for x, c in zip(rest, ("good", "bad"), strict=True)])
    out = out.select(key, "prefix_turns", "prompt", text(F.col("good")).alias("chosen"), text(F.col("bad")).alias("rejected"), spans(F.col("good")).alias("chosen_mask"), spans(F.col("bad")).alias("rejected_mask"))
    return out.withColumn("usable", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0) & (F.col("chosen") != F.col("rejected")))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """``(key, prefix_turns, prompt, chosen, rejected, chosen_mask, rejected_mask, usable)`` of two tables of turns.

    Both have ``key``, ``turn``, ``role`` and ``text``; other columns are not
    read.  A row for each key that both have.  Turns are equal if role and text
    are.  ``usable``: the completions differ and each trains on something; equal
    conversations have the whole as prompt and empty completions.  A conversation
    is rendered as one text, so it must fit in a row; any number of conversations
    may be equal, as each is formatted by itself.
    """
    a = conversations_of(chosen, key).withColumnRenamed("turns", "good")
    b = conversations_of(rejected, key).withColumnRenamed("turns", "bad")
    return formatted(a.join(b, key), key)


def mask_text(mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")


def swapped_pairs(turns: DataFrame) -> DataFrame:
    """``preference_pairs`` of each conversation with a worse one: up to its last assistant turn, which says what the last one of the next id says instead.

    The next id is ``conv_id`` + 1; where it has no assistant turn, nothing is
    said.  A conversation without an assistant turn is its own rejected side.
    Of turns that share a number the assistant's, and of those the text that is
    greatest, is the last.  Turns are grouped once; only what each conversation
    says last goes to its neighbour.
    """
    grouped = stored(conversations_of(turns, "conv_id").withColumnRenamed("turns", "good"))
    spoken = lambda t: t["role"] == ASSISTANT
    last = F.aggregate(F.transform("good", lambda t, k: F.when(spoken(t), k + 1).otherwise(0)), F.lit(0), lambda a, x: F.greatest(a, x))
    rows = grouped.withColumn("last", last)
    said = rows.select((F.col("conv_id") - 1).alias("conv_id"), F.when(F.col("last") > 0, F.get("good", F.col("last") - 1)["text"]).alias("other"))
    swap = F.struct(F.lit(ASSISTANT).alias("role"), F.coalesce("other", F.lit("")).alias("text"))
    bad = F.when(F.col("last") == 0, F.col("good")).otherwise(F.concat(F.slice("good", F.lit(1), F.col("last") - 1), F.array(swap)))
    return formatted(rows.join(said, "conv_id", "left").select("conv_id", "good", bad.alias("bad")), "conv_id")


#: The pairs of ``swapped_pairs(conversations)`` in SQL.
PREFERENCES_SQL = r"""
WITH c AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM c),
l AS (SELECT conv_id, max(k) AS lst FROM g WHERE role = 'assistant' GROUP BY conv_id),
s AS (SELECT g.conv_id, g.text AS said FROM g JOIN l ON g.conv_id = l.conv_id AND g.k = l.lst),
h AS (
  SELECT g.conv_id, g.turn, g.role, CASE WHEN g.k = l.lst THEN coalesce(s.said, '') ELSE g.text END AS text, g.k
  FROM g LEFT JOIN l ON g.conv_id = l.conv_id LEFT JOIN s ON s.conv_id = g.conv_id + 1
  WHERE l.lst IS NULL OR g.k <= l.lst),
f AS (
  SELECT coalesce(g.conv_id, h.conv_id) AS conv_id, min(coalesce(g.k, h.k)) AS k
  FROM g FULL JOIN h ON g.conv_id = h.conv_id AND g.k = h.k
  WHERE g.k IS NULL OR h.k IS NULL OR g.role <> h.role OR g.text <> h.text GROUP BY 1),
p AS (SELECT n.conv_id, CAST(coalesce(f.k - 1, n.n) AS INTEGER) AS prefix_turns FROM (SELECT conv_id, count(*) AS n FROM g GROUP BY conv_id) n LEFT JOIN f ON n.conv_id = f.conv_id),
r AS (
  SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS t FROM (
    SELECT 'g' AS side, * FROM g UNION ALL SELECT 'h' AS side, * FROM h)),
o AS (
  SELECT r.*, p.prefix_turns, coalesce(sum(length(t)) OVER (PARTITION BY r.side, r.conv_id ORDER BY r.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM r JOIN p ON r.conv_id = p.conv_id WHERE r.k > p.prefix_turns),
m AS (
  SELECT conv_id, side, string_agg(t, '' ORDER BY k) AS body,
         string_agg(CASE WHEN role = 'assistant' THEN CAST(off + 22 AS VARCHAR) || '-' || CAST(off + length(t) - 1 AS VARCHAR) END, ',' ORDER BY k) AS mask
  FROM o GROUP BY conv_id, side),
q AS (SELECT r.conv_id, string_agg(t, '' ORDER BY k) AS prompt FROM r JOIN p ON r.conv_id = p.conv_id WHERE side = 'g' AND k <= prefix_turns GROUP BY r.conv_id)
SELECT p.conv_id, p.prefix_turns, coalesce(q.prompt, '') AS prompt, coalesce(x.body, '') AS chosen, coalesce(y.body, '') AS rejected,
       coalesce(x.mask, '') AS chosen_mask, coalesce(y.mask, '') AS rejected_mask,
       x.mask IS NOT NULL AND y.mask IS NOT NULL AND coalesce(x.body, '') <> coalesce(y.body, '') AS usable
FROM p LEFT JOIN q ON p.conv_id = q.conv_id
LEFT JOIN m x ON p.conv_id = x.conv_id AND x.side = 'g' LEFT JOIN m y ON p.conv_id = y.conv_id AND y.side = 'h'
"""
