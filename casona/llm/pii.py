"""Personal data in texts: patterns, and a skip-chain conditional random field that carries them on.

Patterns find the base spans.  What else has a digit or an at sign is a token
that may be personal data or not, and the field decides.  Its variables are the
tokens of a document, each outside or of one kind; those within a base span are
held at its kind.  Neighbours, with hardly anything in between, are joined as in
a chain.  Tokens that repeat or resemble one another, wherever they stand, are
joined by skip edges that share one potential, each occurrence to the one before
and to the first, so that there are at most two for each token and no occurrence
is more than two edges away from another.  Loopy message passing, a fixed number
of rounds over all edges at once, then makes a document agree on what a token is.

The weights are learned from the base spans of a bounded sample of passages.
What the patterns need (a check digit, a plus sign's place, the value of a part)
is no feature; half the passages' tokens are shown without features a second
time, so that the field learns how far to trust neighbours and repetitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casona.llm.shared import text_pieces

#: Kinds of spans, in their order; label k + 1 is kind k, label 0 is none.
KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
#: Passages that weights are learned from, and characters of each.
PASSAGES, PASSAGE_CHARS = 4_000, 4_096
#: Message passing rounds, the share of a message that stays, and how sure an added span must be.
ROUNDS, DAMPING, LEAST = 12, 0.3, 0.9
#: Steps of learning, their width, and the weight of the squared weights.
STEPS, RATE, DECAY = 200, 0.15, 2e-4
#: Characters that neighbours may have in between.
GAP = 3
#: Digits by which long numbers are told to be similar.
ALIKE = 7

# The patterns' own classes.  Starts that can't lead to another match than the one before are skipped
# and no repetition is taken back, so that texts of one long run take linear time; the matches are the same.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<![0-9A-Za-z._%+@()-])[A-Za-z._%+()-]*+[0-9@][0-9A-Za-z._%+@()-]*+")
ANY = re.compile(r"[0-9@]")
NOT_DIGITS = re.compile(r"[^0-9]+")
Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def small_parts(text: str) -> bool:
    """Whether each number between dots is at most 255."""
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts)


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """``(start, end, kind)`` that the patterns find, by start and kind."""
    if not ANY.search(text):
        return []
    found = [(s, e, 0) for s, e in emails(text)]
    found += [(m.start(), m.end(), 1) for m in IP.finditer(text) if small_parts(m.group())]
    digits = lambda m: NOT_DIGITS.sub("", m.group())
    found += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if m.end() - m.start() >= 12 and 12 <= len(d := digits(m)) <= 19 and luhn(d)]
    found += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda x: (x[0], x[2]))


#: Buckets of the features of a token: how many there are in each group, and where each group begins.
SIZES = (1, 13, 5, 4, 7, 3, 4, 4)
FIRST = np.cumsum((0, *SIZES))
FEATURES = int(FIRST[-1])


def bucket(n: int, ends: tuple[int, ...]) -> int:
    return sum(n >= e for e in ends)


def features(token: str, before: str) -> list[int]:
    """One number for each group: always, digits, dotted parts, at sign, signs among digits, letters, changes between letters and digits, the character before."""
    digits = NOT_DIGITS.sub("", token)
    letters = sum(c.isalpha() for c in token[:64])
    parts = token.strip(".").split(".")
    dotted = 0 if letters or not all(p.isdigit() and len(p) <= 3 for p in parts) else min(4, len(parts) - 1)
    name, at, host = token.partition("@")
    sign = 0 if not at else 1 if name and "." in host.strip(".") else 2 if name and host else 3
    marks = {c for c in token if not c.isalnum()}
    shape = 5 if letters else 0 if not marks else 1 if marks == {"-"} else 2 if marks & {"(", ")"} else 3 if "+" in marks else 4 if marks == {"."} else 6
    kinds = ["d" if c.isdigit() else "l" for c in token[:64] if c.isalnum()]
    changes = min(3, sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)))
    near = 0 if not before or before.isspace() else 1 if before in "\"'`" else 2 if before in "=:#/" else 3
    each = (0, bucket(len(digits), (1, 2, 3, 4, 5, 7, 8, 10, 12, 16, 20, 32)), dotted, sign, shape, bucket(letters, (1, 3)), changes, near)
    return [int(f) + k for f, k in zip(FIRST, each, strict=False)]


def key_of(token: str) -> str | None:
    """What tokens that repeat or resemble one another have in common: the last digits of a long number, else the letters and digits."""
    digits = NOT_DIGITS.sub("", token)
    if len(digits) >= ALIKE:
        return digits[-ALIKE:]
    bare = "".join(c for c in token.lower() if c.isalnum())
    return bare if len(bare) >= 4 else None


@dataclass
class Graph:
    """Tokens of documents and their edges; documents aren't joined."""

    at: list[tuple[int, int, int]]  # document, start and end of each token
    features: np.ndarray  # token, group
    base: np.ndarray  # label of the base span, or 0
    edges: np.ndarray  # a, b, 0 for a chain and 1 for a skip edge


def graph_of(texts: list[str], spans: list[list[Span]]) -> Graph:
    at, own, base, edges = [], [], [], []
    for n, (text, found) in enumerate(zip(texts, spans, strict=True)):
        first: dict[str, int] = {}
        last: dict[str, int] = {}
        seen: set[str] = set()
        end, k = None, 0
        by_end = sorted(found, key=lambda s: s[1])
        for m in TOKEN.finditer(text):
            i, token = len(at), m.group()
            while k < len(by_end) and by_end[k][1] <= m.start():
                k += 1
            over = min((s for s in by_end[k : k + len(KINDS) * 2] if s[0] < m.end()), default=None, key=lambda s: (s[0], s[2]))
            at.append((n, m.start(), m.end()))
            # what a token says of itself counts once in a document, however often it is repeated
            own.append([-1] * len(SIZES) if token in seen else features(token, text[m.start() - 1 : m.start()]))
            seen.add(token)
            base.append(0 if over is None else over[2] + 1)
            if end is not None and m.start() - end <= GAP:
                edges.append((i - 1, i, 0))
            end = m.end()
            if (key := key_of(token)) is not None:
                for j in {first.setdefault(key, i), last.get(key, i)} - {i}:
                    edges.append((j, i, 1))
                last[key] = i
    return Graph(at, np.array(own, np.int64).reshape(-1, len(SIZES)), np.array(base, np.int64), np.array(edges, np.int64).reshape(-1, 3))


#: Pairs of labels that share one skip potential: the same kind, none and a kind, two kinds.
SAME, OUT = np.eye(LABELS, dtype=bool), np.arange(LABELS) == 0
TIED = (SAME & ~OUT, ~SAME & (OUT | OUT[:, None]), ~SAME & ~OUT & ~OUT[:, None])


@dataclass
class Weights:
    """Potentials, as logarithms: ``node[feature, label]``, ``chain[left, right]``, ``skip[label, label]``."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @staticmethod
    def none() -> Weights:
        return Weights(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))


def normal(x: np.ndarray) -> np.ndarray:
    """Logarithms whose exponentials add up to one over the last axis."""
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def passed(nodes: np.ndarray, edges: np.ndarray, pairs: np.ndarray, rounds: int = ROUNDS, damping: float = DAMPING) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the marginals of nodes and of edges, after some rounds of messages over all edges.

    ``nodes[node, label]`` and ``pairs[kind of edge, label, label]`` are
    potentials.  Messages of one document don't depend on others in the batch.
    """
    a, b = edges[:, 0], edges[:, 1]
    between = pairs[edges[:, 2]]
    there, back = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))

    def beliefs() -> np.ndarray:
        x = nodes.copy()
        np.add.at(x, b, there)
        np.add.at(x, a, back)
        return x

    for _ in range(rounds if len(edges) else 0):
        x = beliefs()
        forward = normal(np.logaddexp.reduce((x[a] - back)[:, :, None] + between, axis=1))
        backward = normal(np.logaddexp.reduce((x[b] - there)[:, None, :] + between, axis=2))
        there, back = damping * there + (1 - damping) * forward, damping * back + (1 - damping) * backward
    x = beliefs()
    joint = (x[a] - back)[:, :, None] + between + (x[b] - there)[:, None, :]
    return normal(x), normal(joint.reshape(len(edges), LABELS * LABELS)).reshape(joint.shape)


def scores(own: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Each token's potentials; a feature of -1 is not shown."""
    padded = np.vstack([node, np.zeros(LABELS)])
    return padded[own].sum(axis=1)


def learned(texts: list[str], steps: int = STEPS) -> Weights:
    """Weights that make the base labels of ``texts`` likely."""
    g = graph_of(texts, [base_spans(t) for t in texts])
    w = Weights.none()
    if not len(g.base):
        return w
    # every passage twice, the second time without the features of about half its tokens
    hidden = g.features.copy()
    hidden[np.random.default_rng(11).random(len(hidden)) < 0.5, 1:] = -1
    own, gold = np.vstack([g.features, hidden]), np.concatenate([g.base, g.base])
    edges = np.vstack([g.edges, g.edges + np.array([len(g.base), len(g.base), 0])])
    shown, n = own >= 0, len(gold)
    params = [w.node, w.chain, w.skip]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    of_kind = [edges[:, 2] == k for k in (0, 1)]
    for step in range(1, steps + 1):
        single, pair = passed(scores(own, w.node), edges, np.stack([w.chain, w.skip]))
        off = -np.exp(single)
        off[np.arange(n), gold] += 1
        grads = [np.zeros_like(p) for p in params]
        np.add.at(grads[0], own[shown], np.repeat(off, shown.sum(axis=1), axis=0))
        difference = -np.exp(pair)
        np.add.at(difference, (np.arange(len(edges)), gold[edges[:, 0]], gold[edges[:, 1]]), 1)
        grads[1], grads[2] = (difference[k].sum(axis=0) for k in of_kind)
        for tied in TIED:
            grads[2][tied] = grads[2][tied].mean()
        for p, m, s, grad in zip(params, means, squares, grads, strict=True):
            grad = grad / n - DECAY * p
            m += 0.1 * (grad - m)
            s += 0.01 * (grad * grad - s)
            p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return w


def added_spans(g: Graph, w: Weights, texts: list[str], least: float = LEAST) -> list[list[Span]]:
    """Spans of tokens outside base spans that the field is ``least`` sure of; neighbours of one kind are one span."""
    found: list[list[Span]] = [[] for _ in texts]
    if not len(g.base):
        return found
    held = np.where((g.base[:, None] == 0) | (g.base[:, None] == np.arange(LABELS)), 0.0, -60.0)
    marginals, _ = passed(scores(g.features, w.node) + held, g.edges, np.stack([w.chain, w.skip]))
    best = marginals.argmax(axis=1)
    sure = (best > 0) & (g.base == 0) & (np.exp(marginals.max(axis=1)) >= least)
    before = -2
    for i in np.flatnonzero(sure).tolist():
        n, start, end = g.at[i]
        token = texts[n][start:end]
        start += len(token) - len(token.lstrip("._%-)"))
        end -= len(token) - len(token.rstrip("._%+-("))
        kind = int(best[i]) - 1
        if before == i - 1 and g.at[before][0] == n and start - g.at[before][2] <= GAP and found[n] and found[n][-1][2] == kind:
            found[n][-1] = (found[n][-1][0], end, kind)
        else:
            found[n].append((start, end, kind))
        before = i
    return found


def train(docs: DataFrame, passages: int = PASSAGES, chars: int = PASSAGE_CHARS, text_col: str = "text") -> Weights:
    """Weights from at most ``passages`` different texts with a digit or an at sign, ``chars`` characters of each from its first one on.

    Which texts, a hash decides.  Without any the weights are zero, and no span
    is added.
    """
    rows = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("text"))
    picked = rows.select("h").distinct().orderBy("h").limit(passages)
    start = F.greatest(F.regexp_instr("text", F.lit("[0-9@]")) - 64, F.lit(1))
    # at most ``passages`` numbers of eight bytes are broadcast
    texts = rows.join(F.broadcast(picked), "h").select("h", F.substr("text", start, F.lit(chars)).alias("passage")).groupBy("h").agg(F.first("passage").alias("passage"))
    return learned([r["passage"] for r in sorted(texts.collect(), key=lambda r: r["h"])])


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def found_in(docs: DataFrame, weights: Weights, keep: list[str], text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``keep`` and ``n_`` and each kind, ``base`` and ``spans``: how many base spans there are, and the texts of those and of all.

    Offsets count code points, the end is exclusive.  A null text has none.
    Each text is looked at whole where it is read; nothing is shuffled.
    """
    names = ["keep", *[f"n_{k}" for k in KINDS], "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in text_pieces(batch, 1, binary=False):
                whole = [t or "" for t in texts]
                base = [base_spans(t) for t in whole]
                more = added_spans(graph_of(whole, base), weights, whole, least)
                counts = [pa.array([sum(k == kind for _, _, k in spans) for spans in base], pa.int64()) for kind in range(len(KINDS))]
                every = [pa.array([span_text(b + m) for b, m in zip(base, more, strict=True)], pa.string())]
                yield pa.RecordBatch.from_arrays([piece.column(0), *counts, pa.array([span_text(b) for b in base], pa.string()), *every], names=names)

    rows = docs.select(F.struct(*keep).alias("keep"), F.col(text_col).cast("string").alias("text"))
    schema = f"keep {rows.schema['keep'].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string"
    return rows.mapInArrow(run, schema).select("keep.*", *names[1:])


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of ``documents``; the numbers are those of base spans."""
    found = found_in(docs, train(docs), ["doc_id"])
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")
