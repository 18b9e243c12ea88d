"""Language identification by a byte convolutional network.

Filters of several widths run over the bytes of fixed-length windows, each
filter keeps its maximum over a window, and a softmax layer reads the maxima.
A document's score is the softmax of its windows' mean log probabilities,
weighted by the bytes in each.  The network is trained in numpy on the driver,
on a bounded sample, and applied to batches of windows in the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casona.llm.shared import text_pieces

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Windows that go through the filters at once, so that they stay in the cache.
BATCH = 32
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def byte_classes() -> np.ndarray:
    """Class of each byte: 0 fills windows up, then space, digit, punctuation, 26 letters, and each byte from 0x80."""
    out = np.full(256, 3, np.uint8)
    out[:33] = 1
    out[127] = 1
    out[48:58] = 2
    out[65:91] = out[97:123] = np.arange(4, 30)
    out[128:] = np.arange(30, 158)
    return out


CLASS_OF = byte_classes()
CLASSES = int(CLASS_OF.max()) + 1


def windows_of(text: bytes) -> np.ndarray:
    """Byte classes of a text, a row for each window; a row goes on for as many bytes as the widest filter needs."""
    n, more = max(1, -(-len(text) // WINDOW)), max(WIDTHS) - 1
    flat = np.zeros(n * WINDOW + more, np.uint8)
    flat[: len(text)] = CLASS_OF[np.frombuffer(text, np.uint8)]
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW + more)[::WINDOW]


@dataclass
class ByteCNN:
    """``taps[j]``: weights of the j-th byte under the filters that are wider than j, the widest filters first."""

    labels: list[str]
    taps: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(labels: list[str], seed: int) -> ByteCNN:
        rng, total = np.random.default_rng(seed), FILTERS * len(WIDTHS)
        reach = [FILTERS * sum(w > j for w in WIDTHS) for j in range(max(WIDTHS))]
        taps = [rng.normal(0, 0.3, (CLASSES, n)).astype(np.float32) for n in reach]
        return ByteCNN(labels, taps, np.zeros(total, np.float32), rng.normal(0, 0.1, (total, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32))

    def maps(self, rows: np.ndarray) -> np.ndarray:
        """``[window, position, filter]`` before pooling."""
        at = np.take(self.taps[0], rows[:, :WINDOW], axis=0)
        for j, tap in enumerate(self.taps[1:], 1):
            at[:, :, : tap.shape[1]] += np.take(tap, rows[:, j : j + WINDOW], axis=0)
        return at

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """``[window, label]``."""
        pooled = np.concatenate([self.maps(rows[k : k + BATCH]).max(axis=1) for k in range(0, len(rows), BATCH)])
        return log_softmax(np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The label of each text and its probability; ``und`` and 0 without a letter."""
        labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        for k, text in enumerate(texts):
            if not self.labels or not has_letter(text):
                continue
            rows = windows_of(text)
            bytes_in = np.minimum(WINDOW, len(text) - WINDOW * np.arange(len(rows)))
            mean = (self.log_probabilities(rows) * bytes_in[:, None]).sum(axis=0, dtype=np.float64) / len(text)
            chances = np.exp(mean - mean.max())
            best = int(chances.argmax())
            labels[k], scores[k] = self.labels[best], chances[best] / chances.sum()
        return labels, scores


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(c.isalpha() for c in text.decode("utf-8", "replace")))


def fit(texts: list[bytes], labels: list[str], steps: int = 500, rate: float = 0.02, seed: int = 42) -> ByteCNN:
    """Trained by Adam on the windows of the given texts, each label as often as any other."""
    names = sorted(set(labels))
    model, rng = ByteCNN.fresh(names, seed), np.random.default_rng(seed)
    if len(names) < 2:
        return model
    rows = [windows_of(t) for t in texts]
    y = np.repeat([names.index(x) for x in labels], [len(r) for r in rows])
    x = np.concatenate(rows)
    of = [np.flatnonzero(y == k) for k in range(len(names))]
    parameters = [*model.taps, model.bias, model.out, model.out_bias]
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(i, max(1, 64 // len(names))) for i in of])
        maps = model.maps(x[pick])
        at = maps.argmax(axis=1)
        pooled = np.take_along_axis(maps, at[:, None, :], axis=1)[:, 0] + model.bias
        hidden = np.maximum(pooled, 0)
        error = np.exp(log_softmax(hidden @ model.out + model.out_bias))
        error[np.arange(len(pick)), y[pick]] -= 1
        error /= len(pick)
        back = (error @ model.out.T) * (pooled > 0)
        slopes = [np.zeros_like(t) for t in model.taps]
        for j, slope in enumerate(slopes):
            n = slope.shape[1]
            byte = np.take_along_axis(x[pick], at[:, :n] + j, axis=1)
            np.add.at(slope, (byte, np.broadcast_to(np.arange(n), byte.shape)), back[:, :n])
        slopes += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
        pace = rate * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for p, g, m, v in zip(parameters, slopes, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id's text is divisible by 5 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", docs_per_label: int = 400, chars: int = 1024) -> ByteCNN:
    """A network for the labels of ``docs``.

    Learns from about ``docs_per_label`` documents of each label, picked by a
    hash of the id, and one passage of ``chars`` characters of each, which
    starts at a place picked by hash; this bounds what comes to the driver of
    each label.  Rows without an id, text or label, and rows of ``held_out``,
    are left out.  Every label is learned, so there must be a bounded number of them.
    """
    at = F.xxhash64(F.col(id_col), F.lit("sample"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"), at.alias("at"), held_out(id_col).alias("held")).where("id is not null and label is not null and not held")
    counts = rows.groupBy("label").count()  # of ids and labels alone
    share = F.broadcast(counts.select("label", F.least(F.lit(1.0), docs_per_label / F.col("count")).alias("share")))
    start = F.greatest(F.lit(0), F.length("text") - chars)
    passage = F.substring(F.col("text"), 1 + F.pmod(F.col("at"), start + 1).cast("int"), F.lit(chars))
    picked = rows.where("text is not null").join(share, "label").where(F.pmod("at", F.lit(1_000_003)) / F.lit(1_000_003) < F.col("share"))
    sample = picked.select("id", "label", passage.cast("binary").alias("text")).toPandas()
    if not len(sample):
        return ByteCNN.fresh([], 0)
    sample = sample[[has_letter(t) for t in sample["text"]]].sort_values(["id", "text"])
    return fit([bytes(t) for t in sample["text"]], list(sample["label"]))


def predict(docs: DataFrame, model: ByteCNN, text_col: str = "text", keep: list[str] | None = None, min_score: float | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if none are given), then ``lang_pred`` (a learned label or ``und``) and ``score`` (0 to 1), or what ``names`` calls them.

    Whole texts are read, long ones in many windows.  A null text or one without
    a letter is ``und`` with score 0, as is everything if no label was learned.
    Rows stay where they are; repeated rows get equal results; an empty table
    gives none.  Columns of ``docs`` that have these names already are replaced.
    With ``min_score``, rows that are ``und`` or score less are left out.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in names]
    rows = docs.select(*columns, *([] if text_col in columns else [text_col]))
    at = rows.columns.index(text_col)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (x for b in batches for x in text_pieces(b, at)):
            labels, scores = model.predict(texts)
            out = pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[*columns, *names])
            if min_score is not None:
                out = out.filter(pa.array((np.array(labels, object) != UNDETERMINED) & (scores >= min_score), pa.bool_()))
            yield out

    return rows.mapInArrow(run, ", ".join(x for x in (schema, f"`{names[0]}` string, `{names[1]}` double") if x))


def accuracy(found: pd.DataFrame) -> float:
    """Share of rows whose ``lang_pred`` is their ``lang``."""
    return float((found["lang_pred"] == found["lang"]).mean())
