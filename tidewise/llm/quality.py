"""Quality of documents: a linear-chain conditional random field labels every line good or bad.

A line is described by shares of character classes, lengths, repeated words and the like, each cut into bins; a line's
evidence is the sum of the weights of its own bins and of those of the lines before and after it, and neighbouring labels
have weights too. Forward and backward passes give each line's probability of being good; their mean, weighted by the
lines' lengths, is the document's, which a logistic turns into a score.

Labels are known for documents only: a good document's lines are all good, of a bad one's at least one is not. ``train``
says how the lines of bad documents are told apart; given them, the field's likelihood has its usual gradient, what is
seen less what is expected.

Fitted on at most about ``TRAIN_GOOD`` and ``TRAIN_BAD`` labelled documents of at most ``TRAIN_LINES`` lines, drawn by a
hash of the id; ``HELD_SHARE`` of them set the logistic only. Every document's whole text is scored.

A line ends at a line feed; a null text counts as empty, an empty text is one empty line. Without labels of both kinds
there is no model and every score is 0.5. An id counts once in training, with its label if it has only one. Rows stay as
they are, repeated ones and other columns too, whatever their names; columns ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import PrefixHash, chunks, own_session, stored

TRAIN_GOOD, TRAIN_BAD, TRAIN_LINES = 3000, 1500, 400
HELD_SHARE = 0.25
THRESHOLD = 0.3
ROUNDS, RELABELLED, RATE, DECAY = 120, 2, 0.1, 1e-4

# Character classes and the ends of sentences.
SPACE, UPPER, LETTER, DIGIT, COMMON, SIGN = range(6)
COMMON_SIGNS = ".,;:!?'\"()-¡¿«»„“”‘’–"
ENDS = ".!?:;\"'”»"

#: Where the bins of each kind of feature begin; a share of nothing has a bin of its own.
SHARES = np.array([1e-9, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7])
LENGTHS = np.array([1, 8, 32, 128, 512, 2048, 8192], dtype=np.float64)
WORD_LENGTHS = np.array([1e-9, 2.5, 3.5, 4.5, 6, 8, 12])
BINS = 8
FEATURES = (
    "upper", "digit", "sign", "exclaimed", "repeated word", "word ends in a sign", "space", "length", "word length",
    "no sentence end", "begins small", "repeated line",
)
BLANK_BIN = BINS  # of a neighbour that is not there


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point of the basic plane; all beyond are signs."""
    out = np.full(1 << 16, SIGN, dtype=np.uint8)
    for point in range(1 << 16):
        kind = unicodedata.category(chr(point))
        if kind in ("Lu", "Lt"):
            out[point] = UPPER
        elif kind[0] in "LM":
            out[point] = LETTER
        elif kind[0] == "N":
            out[point] = DIGIT
        elif kind[0] == "Z" or chr(point).isspace():
            out[point] = SPACE
    out[[ord(c) for c in COMMON_SIGNS]] = COMMON
    return out


def lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin of each feature of every line, the lines' lengths, and how many lines each text has."""
    data = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = np.where(data < 1 << 16, _classes()[np.minimum(data, (1 << 16) - 1)], SIGN)
    stop = np.flatnonzero(data == 10)
    start = np.concatenate(([0], stop[:-1] + 1))
    length = stop - start
    size = np.maximum(length, 1)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    doc = np.searchsorted(np.cumsum(sizes), start, side="right")

    def total(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[stop] - sums[start]

    letters = np.maximum(total((kind == UPPER) | (kind == LETTER)), 1)
    inside = np.concatenate(([False], kind != SPACE, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edge[::2], edge[1::2]
    hashed = PrefixHash(data)
    word, line_of = hashed.slices(first, end), np.searchsorted(stop, first, side="left")
    words = np.bincount(line_of, minlength=len(stop))
    again = np.zeros(len(word), dtype=bool)
    again[1:] = (word[1:] == word[:-1]) & (line_of[1:] == line_of[:-1])

    def share(marked: np.ndarray) -> np.ndarray:
        return np.bincount(line_of[marked], minlength=len(stop)) / np.maximum(words, 1)

    last = np.full(len(stop), -1, dtype=np.int64)
    last[line_of] = end - 1
    closed = (last >= 0) & np.isin(data[last], np.array([ord(c) for c in ENDS], dtype=np.uint32))
    opening = np.full(len(stop), -1, dtype=np.int64)
    opening[line_of[::-1]] = first[::-1]
    small = (opening >= 0) & (kind[opening] == LETTER)
    # A line that its document has had before, blank ones aside.
    by_line = hashed.slices(start, stop)
    order = np.lexsort((by_line, doc))
    met = np.zeros(len(stop), dtype=bool)
    met[order[1:]] = (doc[order[1:]] == doc[order[:-1]]) & (by_line[order[1:]] == by_line[order[:-1]])
    columns = [
        np.searchsorted(SHARES, values, side="right")
        for values in (
            total(kind == UPPER) / letters, total(kind == DIGIT) / size, total(kind == SIGN) / size, total(data == ord("!")) / size,
            share(again), share((kind == SIGN)[end - 1]), total(kind == SPACE) / size,
        )
    ]
    columns.append(np.searchsorted(LENGTHS, length, side="right"))
    columns.append(np.searchsorted(WORD_LENGTHS, (total(kind != SPACE) / np.maximum(words, 1)), side="right"))
    columns += [~closed, small, met & (words > 0)]
    return np.stack(columns, axis=1).astype(np.uint8), length + 1, np.bincount(doc, minlength=len(texts))


def _neighbours(bins: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bins of the lines before and after, ``BLANK_BIN`` at the ends of documents."""
    ends = np.cumsum(counts)
    before, after = np.empty_like(bins), np.empty_like(bins)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[ends - counts], after[ends - 1] = BLANK_BIN, BLANK_BIN
    return before, after


@dataclass
class Field:
    """Weights of a bad line: by place (own, before, after), feature and bin; of pairs of labels; and the logistic."""

    weights: np.ndarray
    pairs: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def evidence(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        places = (bins, *_neighbours(bins, counts))
        at = np.arange(len(FEATURES))
        return np.clip(sum(w[at, b].sum(axis=1) for w, b in zip(self.weights, places)), -30.0, 30.0)

    def marginals(self, evidence: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each line's probability of being bad, each document's log Z, and its expected number of each pair of labels."""
        order = np.argsort(-counts, kind="stable")
        start, size = (np.cumsum(counts) - counts)[order], counts[order]
        node = np.stack((np.ones(len(evidence)), np.exp(evidence)), axis=1)
        step = np.exp(self.pairs)
        forward, backward = np.empty_like(node), np.ones_like(node)
        scale = np.ones(len(evidence))
        longest = int(size.max(initial=0))
        active = np.searchsorted(-size, -np.arange(longest), side="left").tolist()  # documents of more than t lines
        for t, n in enumerate(active):
            at = start[:n] + t
            state = node[at] if t == 0 else (forward[at - 1] @ step) * node[at]
            scale[at] = state.sum(axis=1)
            forward[at] = state / scale[at, None]
        pairs = np.zeros((len(counts), 2, 2))
        for t in range(longest - 1, 0, -1):
            at = start[: active[t]] + t
            ahead = node[at] * backward[at] / scale[at, None]
            pairs[order[: active[t]]] += forward[at - 1][:, :, None] * step[None] * ahead[:, None, :]
            backward[at - 1] = ahead @ step.T
        both = forward * backward
        z = np.add.reduceat(np.log(scale), np.cumsum(counts) - counts)
        return both[:, 1] / both.sum(axis=1), z, pairs

    def quality(self, bins: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The share of each document's text that is good, by the lines' probabilities."""
        bad, _, _ = self.marginals(self.evidence(bins, counts), counts)
        first = np.cumsum(counts) - counts
        return 1 - np.add.reduceat(bad * length, first) / np.add.reduceat(length.astype(np.float64), first)

    def scores(self, texts: list[str]) -> np.ndarray:
        return _logistic(self.slope * _logit(self.quality(*lines(texts))) + self.shift) if texts else np.zeros(0)


def _logit(share: np.ndarray) -> np.ndarray:
    kept = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(kept / (1 - kept))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gradient(
    field: Field, bins: np.ndarray, counts: np.ndarray, labels: np.ndarray, weight: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """The log-likelihood of the lines' ``labels`` (1: bad) by weighted documents; its gradient by ``weights`` and ``pairs``."""
    evidence = field.evidence(bins, counts)
    bad, z, pairs = field.marginals(evidence, counts)
    first = np.cumsum(counts) - counts
    inner = np.ones(len(labels), dtype=bool)
    inner[first] = False
    at, seen = np.flatnonzero(inner), np.zeros((len(labels), 2, 2))
    seen[at, labels[at - 1], labels[at]] = 1
    seen = np.add.reduceat(seen, first)
    value = np.add.reduceat(labels * evidence, first) + (seen * field.pairs).sum(axis=(1, 2)) - z
    by_line = np.repeat(weight, counts) * (labels - bad)
    by_weight = np.zeros_like(field.weights)
    at = np.arange(len(FEATURES)) * (BINS + 1)
    for place, held in enumerate((bins, *_neighbours(bins, counts))):
        flat = (held + at).ravel()
        by_weight[place] = np.bincount(flat, np.repeat(by_line, len(FEATURES)), at[-1] + BINS + 1).reshape(len(FEATURES), -1)
    by_pair = (weight[:, None, None] * (seen - pairs)).sum(axis=0)
    by_pair[0, 0] = 0.0  # two good lines weigh nothing: the other pairs are relative to them
    return float((weight * value).sum()), by_weight, by_pair


def _climb(field: Field, rounds: int, alone: bool, *data) -> None:
    """Gradient steps of adapted length; ``alone``: of the weights of a line's own bins only."""
    held = [(np.zeros_like(v), np.zeros_like(v)) for v in (field.weights, field.pairs)]
    for n in range(1, rounds + 1):
        _, *steps = gradient(field, *data)
        if alone:
            steps[0][1:], steps[1][:] = 0.0, 0.0
        for value, step, (mean, square) in zip((field.weights, field.pairs), steps, held):
            step -= DECAY * value
            mean += 0.1 * (step - mean)
            square += 0.01 * (step**2 - square)
            value += RATE * mean / (1 - 0.9**n) / (np.sqrt(square / (1 - 0.99**n)) + 1e-8)


def train(bins: np.ndarray, counts: np.ndarray, good: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Weights of the greatest likelihood, lines of both kinds of documents weighing the same.

    A line is first taken to be what its document is, and judged by its own bins alone: lines that both kinds have come
    out good. Then, ``RELABELLED`` times and by all weights, a bad document's lines are taken to be what the field so far
    finds likelier, and if that makes all of them good, its likeliest one stays bad.
    """
    field = Field(np.zeros((3, len(FEATURES), BINS + 1)), np.zeros((2, 2)))
    weight = np.where(good, 0.5 / max(1, counts[good].sum()), 0.5 / max(1, counts[~good].sum()))
    doubtful = np.repeat(~good, counts)
    _climb(field, rounds, True, bins, counts, doubtful.astype(np.int64), weight)
    for _ in range(RELABELLED):
        bad, _, _ = field.marginals(field.evidence(bins, counts), counts)
        most = np.repeat(np.maximum.reduceat(bad, np.cumsum(counts) - counts), counts)
        labels = doubtful & ((bad > 0.5) | (bad == most))
        _climb(field, rounds // 2, False, bins, counts, labels.astype(np.int64), weight)
    return field


def calibrate(x: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic by Newton steps, on targets drawn in a little from 0 and 1."""
    target = np.where(good, 1 - 1 / (good.sum() + 2), 1 / ((~good).sum() + 2))
    theta, columns = np.array([1.0, 0.0]), np.stack((x, np.ones(len(x))), axis=1)
    for _ in range(100):
        p = _logistic(columns @ theta)
        hessian = (columns * (p * (1 - p))[:, None]).T @ columns + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, columns.T @ (target - p) - 1e-2 * theta)
        theta = theta + step / max(1.0, 2 * np.abs(step).max())
    return max(float(theta[0]), 1e-3), float(theta[1])


def _line_rows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A training document's label, whether it is held back, and its lines' bins and lengths."""
    for batch in batches:
        for start, stop in chunks(pa.compute.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)):
            part = batch.slice(start, stop - start)
            bins, length, counts = lines(part.column(2).to_pylist())
            ends = np.cumsum(counts)
            kept = np.flatnonzero(counts <= most)
            cut = [slice(a, b) for a, b in zip((ends - counts)[kept].tolist(), ends[kept].tolist())]
            made = [pa.array([values[c].tobytes() for c in cut], pa.binary()) for values in (bins, length.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([part.column(i).take(pa.array(kept)) for i in (0, 1)] + made, names=["good", "held", "bins", "lengths"])


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
    train_good: int = TRAIN_GOOD, train_bad: int = TRAIN_BAD, train_lines: int = TRAIN_LINES,
) -> Field | None:
    """Learn from the documents of ``labels`` (id and a label of 1, good, or 0)."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.min(label).alias("good"), F.max(label).alias("most")).where("good = most")
    sizes = dict(known.groupBy("good").count().collect())
    if len(sizes) < 2:
        return None
    share = F.when(F.col("good") == 1, F.lit(train_good / sizes[1])).otherwise(F.lit(train_bad / sizes[0]))
    draw = F.xxhash64(F.lit("quality"), F.col("id")) / F.lit(2.0**64) + 0.5
    drawn = known.withColumn("draw", draw / F.least(share, F.lit(1.0))).where("draw < 1")
    chosen = stored(drawn.select("id", F.col("good").cast("int").alias("good"), (F.col("draw") < HELD_SHARE).alias("held")), "quality-drawn")
    rows = own_session(docs).select(F.col(id_column).alias("of"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = rows.join(chosen, rows["of"] == chosen["id"]).groupBy("id", "good", "held").agg(F.min("text").alias("text"))
    found = sample.select("good", "held", "text").mapInArrow(lambda it: _line_rows(it, train_lines), "good int, held boolean, bins binary, lengths binary")
    return _fitted(found.toPandas())


def _fitted(rows: pd.DataFrame) -> Field | None:
    def part(mask: np.ndarray):
        some = rows[mask]
        length = np.frombuffer(b"".join(some["lengths"]), np.int64)
        bins = np.frombuffer(b"".join(some["bins"]), np.uint8).reshape(-1, len(FEATURES))
        counts = np.array([len(x) // 8 for x in some["lengths"]], dtype=np.int64)
        return bins, length, counts, some["good"].to_numpy() == 1

    held = rows["held"].to_numpy(dtype=bool)
    bins, _, counts, good = part(~held)
    if not good.any() or good.all():
        return None
    field = train(bins, counts, good)
    bins, length, counts, good = part(held)
    if good.any() and not good.all():
        field.slope, field.shift = calibrate(_logit(field.quality(bins, length, counts)), good)
    return field


def score(docs: DataFrame, model: Field | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``threshold`` on)."""
    docs = own_session(docs)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(text).cast(pa.string())).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in chunks(sizes):
                part = batch.slice(i, j - i)
                texts = [t or "" for t in part.column(text).to_pylist()]
                values = field.scores(texts) if field is not None else np.full(len(texts), 0.5)
                made = [pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + made, names=[*kept, "score", "predicted"])

    return docs.select(*kept).mapInArrow(run, schema)
