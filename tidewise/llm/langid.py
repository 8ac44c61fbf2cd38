"""Language of whole texts by interpolated Kneser-Ney character models.

One model per language over characters (letters in lower case, every run of anything else is one blank). The highest
order counts occurrences, lower orders count distinct left neighbours, each order discounts by ``DISCOUNT`` and hands
the rest to the order below. The models of all languages lie side by side: per order one sorted array of n-gram hashes
with a row of log-probabilities, and one of context hashes with a row of log-back-off weights. A character looks up its
longest n-gram; where no language has seen it, the contexts' weights are added and the next shorter one is looked up.

The predicted language has the lowest cross-entropy per character. ``score`` is its share under a softmax of the
length-normalised entropies whose scale is chosen on rows set aside from training. ``rejected`` marks texts whose
best entropy lies above what the language's calibration rows show: mean plus ``REJECT`` standard errors for their
length plus ``MARGIN`` nats.

Null texts and texts without a letter are ``und`` with score 0 and rejected. With nothing to learn from, every text is.
Ties go to the alphabetically first language. Extra columns stay; columns named like results are replaced.

Fitting reads at most about ``TRAIN_ROWS`` rows per language, chosen by a hash of the id, and keeps the ``GRAMS`` most
frequent n-grams of a language; both bounds are parameters. Prediction reads every text whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import BASE, chunks, mix, own_session, stored
from .bpe import LETTER, _point_classes

ORDER = 5
DISCOUNT = 0.75
TRAIN_ROWS = 5_000
CALIBRATION_ROWS = 500
GRAMS = 60_000
REJECT, MARGIN = 6.0, 1.0
UNKNOWN = "und"


def plain_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with blanks between, as code points, and each one's text; ORDER blanks stand before a text."""
    pad = " " * ORDER
    joined = "".join(pad + t.lower() for t in texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
    lengths = np.array([ORDER + len(t.lower()) for t in texts])
    owner = np.append(np.repeat(np.arange(len(texts)), lengths), len(texts))
    points[_point_classes()[points] != LETTER] = 32
    return points, owner


def clean(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Drop repeated blanks inside texts; True marks the characters that are scored (not the padding)."""
    blank = points == 32
    begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    place = np.arange(len(points)) - np.repeat(begin, np.diff(np.append(begin, len(points))))
    keep = ~blank | np.concatenate(([True], ~blank[:-1])) | (place < ORDER)
    scored = (place >= ORDER) & keep
    return points[keep], owner[keep], scored[keep]


def gram_hashes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each position, for n = 0 .. order."""
    letters = mix(points.astype(np.uint64) + np.uint64(1))
    out, power = [np.zeros(len(points), dtype=np.uint64)], 1
    for n in range(order):
        shifted = np.concatenate((np.zeros(n, np.uint64), letters[: len(letters) - n]))
        out.append(out[-1] + shifted * np.uint64(power))
        power = power * BASE % (1 << 64)
    return out


class Hashes:
    """A sorted array of hashes; a table over their leading bits says where to begin to look."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        bits = max(4, len(keys).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def __len__(self) -> int:
        return len(self.keys) - 1

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each wanted hash is or would be, and whether it is there."""
        place = self.first[wanted >> self.shift]
        behind = np.flatnonzero(self.keys[place] < wanted)
        while len(behind):
            place[behind] += 1
            behind = behind[self.keys[place[behind]] < wanted[behind]]
        return place, (self.keys[place] == wanted) & (place < len(self))


@dataclass
class Model:
    languages: list[str]
    grams: list[Hashes]  # by order 1 .. n: sorted hashes
    values: list[np.ndarray]  # log-probabilities of each language
    contexts: list[Hashes]  # by order 0 .. n - 1: sorted hashes
    backs: list[np.ndarray]  # log-weights of each language
    floor: np.ndarray
    scale: float = 1.0
    typical: np.ndarray | None = None  # mean entropy, and the deviation of one character, of each language

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text in each language, and its number of scored letters."""
        points, owner, scored = clean(*plain_points(texts))
        order = len(self.grams)
        hashes = gram_hashes(points, order)
        at = np.flatnonzero(scored)
        total = np.zeros((len(at), len(self.languages)), dtype=np.float32)
        open_ = np.arange(len(at))
        for n in range(order, 0, -1):
            place, found = self.grams[n - 1].find(hashes[n][at[open_]])
            seen = open_[found]
            total[seen] += self.values[n - 1][place[found]]
            open_ = open_[~found]
            if not len(open_):
                break
            place, known = self.contexts[n - 1].find(hashes[n - 1][at[open_] - 1])
            total[open_[known]] += self.backs[n - 1][place[known]]
        total[open_] += self.floor
        whose = owner[at]
        count = np.bincount(whose, minlength=len(texts))[: len(texts)]
        sums = np.zeros((len(texts), total.shape[1]))
        begins = np.flatnonzero(np.concatenate((np.ones(min(1, len(whose)), bool), whose[1:] != whose[:-1])))
        if len(begins):
            sums[whose[begins]] = np.add.reduceat(total, begins, axis=0, dtype=np.float64)
        letters = np.bincount(whose[points[at] != 32], minlength=len(texts))[: len(texts)]
        return -sums / np.maximum(count, 1)[:, None], letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, entropy and rejection of each text."""
        entropy, letters = self.entropies([t or "" for t in texts])
        best = entropy.argmin(axis=1)
        rows = np.arange(len(texts))
        lowest = entropy[rows, best]
        share = 1.0 / np.exp(-self.scale * (entropy - lowest[:, None])).sum(axis=1)
        some = letters > 0
        mean, deviation = self.typical[best, 0], self.typical[best, 1]
        rejected = ~some | (lowest > mean + MARGIN + REJECT * deviation / np.sqrt(np.maximum(letters, 1)))
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
        return names, np.where(some, share, 0.0), np.where(some, lowest, np.nan), rejected


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of the highest order with their counts, by language."""
    for batch in batches:
        languages = batch.column(0).to_pylist()
        for language in sorted(set(languages)):
            mask = pa.compute.equal(batch.column(0), language)
            texts = batch.column(1).filter(mask)
            sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            for start, stop in chunks(sizes):
                points, _, scored = clean(*plain_points([t or "" for t in texts.slice(start, stop - start).to_pylist()]))
                hashed = gram_hashes(points, ORDER)[ORDER]
                at = np.flatnonzero(scored)
                if not len(at):
                    continue
                _, first, count = np.unique(hashed[at], return_index=True, return_counts=True)
                windows = np.lib.stride_tricks.sliding_window_view(points, ORDER)[at[first] - ORDER + 1]
                grams = np.ascontiguousarray(windows).view(f"<U{ORDER}").ravel().tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(grams)), pa.array(grams, pa.string()), pa.array(count, pa.int64())], names=["lang", "gram", "n"]
                )


def _key(letters: np.ndarray) -> np.ndarray:
    """Hashes of n-grams given as rows of code points, the same as ``gram_hashes`` gives."""
    mixed = mix(letters.astype(np.uint64) + np.uint64(1))
    width = letters.shape[1]
    powers = np.array([pow(BASE, width - 1 - i, 1 << 64) for i in range(width)], dtype=np.uint64)
    return (mixed * powers).sum(axis=1, dtype=np.uint64)


def _orders(grams: list[str], counts: np.ndarray) -> list[dict[str, np.ndarray]]:
    """One language: per order the n-gram hashes with context, suffix, discounted share; contexts with their weight."""
    letters = np.frombuffer("".join(grams).encode("utf-32-le"), dtype=np.uint32).reshape(-1, ORDER)
    out: list[dict[str, np.ndarray]] = []
    count = counts.astype(np.float64)
    for n in range(ORDER, 0, -1):
        context, inverse = np.unique(_key(letters[:, :-1]), return_inverse=True)
        total = np.bincount(inverse, weights=count)
        kinds = np.bincount(inverse)
        share = np.maximum(count - DISCOUNT, 0) / total[inverse]
        out.append(
            {
                "key": _key(letters), "suffix": _key(letters[:, 1:]), "context_of": context[inverse], "share": share,
                "context": context, "back": DISCOUNT * kinds / total,
            }
        )
        if n > 1:
            _, first, neighbours = np.unique(_key(letters[:, 1:]), return_index=True, return_counts=True)
            letters, count = letters[first, 1:], neighbours.astype(np.float64)
    return out[::-1]


def build(counts: pd.DataFrame) -> Model | None:
    """The models of all languages from rows (lang, gram, n)."""
    languages = sorted(counts["lang"].unique())
    if not languages:
        return None
    parts = [_orders(g["gram"].tolist(), g["n"].to_numpy()) for _, g in counts.groupby("lang", sort=True)]
    # Below single characters every language hands its rest to one even distribution.
    size = len(np.unique(np.concatenate([p[0]["key"] for p in parts]))) + 1
    below_keys, below = np.zeros(1, np.uint64), np.full((1, len(languages)), 1.0 / size)
    model = Model(languages, [], [], [], [], np.log(below[0]).astype(np.float32))
    for n in range(ORDER):
        keys, first = np.unique(np.concatenate([p[n]["key"] for p in parts]), return_index=True)
        suffix = np.concatenate([p[n]["suffix"] for p in parts])[first]
        context_of = np.concatenate([p[n]["context_of"] for p in parts])[first]
        contexts = np.unique(np.concatenate([p[n]["context"] for p in parts]))
        back, share = np.ones((len(contexts), len(parts))), np.zeros((len(keys), len(parts)))
        for i, part in enumerate(parts):
            back[np.searchsorted(contexts, part[n]["context"]), i] = part[n]["back"]
            share[np.searchsorted(keys, part[n]["key"]), i] = part[n]["share"]
        lower = below[np.searchsorted(below_keys, suffix)] if n else np.repeat(below, len(keys), axis=0)
        values = share + back[np.searchsorted(contexts, context_of)] * lower
        model.grams.append(Hashes(keys))
        model.values.append(np.log(values).astype(np.float32))
        model.contexts.append(Hashes(contexts))
        model.backs.append(np.log(back).astype(np.float32))
        below_keys, below = keys, values
    return model


def _entropy_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Of rows (lang, text) the language, the entropies in all languages, and the number of letters of the whole text."""
    for batch in batches:
        texts = batch.column(1).cast(pa.string())
        for start, stop in chunks(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)):
            entropy, letters = model.entropies([t or "" for t in texts.slice(start, stop - start).to_pylist()])
            lists = pa.array(list(entropy), pa.list_(pa.float64()))
            names = ["lang", "entropy", "letters"]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), lists, pa.array(letters, pa.int64())], names=names)


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Scale of the softmax by log-loss, and the entropies that are usual, on rows (lang, text) not trained on."""
    number = {name: i for i, name in enumerate(model.languages)}
    # Whole texts are judged in the tasks; the driver gets a few numbers of each of the bounded rows.
    shared = rows.sparkSession.sparkContext.broadcast(model)
    judged = rows.mapInArrow(lambda it: _entropy_rows(it, shared.value), "lang string, entropy array<double>, letters long").toPandas()
    shared.unpersist()
    judged = judged[judged["lang"].isin(number)]
    entropy = np.array(judged["entropy"].tolist(), dtype=np.float64).reshape(-1, len(model.languages))
    letters = judged["letters"].to_numpy(dtype=np.int64)
    truth = judged["lang"].map(number).to_numpy(dtype=np.int64)
    use = letters > 0
    entropy, truth, letters = entropy[use], truth[use], letters[use]
    model.typical = np.tile([math.log(len(model.grams[0]) + 1), 1.0], (len(model.languages), 1))
    if not len(truth):
        return
    shifted = entropy - entropy.min(axis=1, keepdims=True)
    losses = []
    for scale in (grid := [2.0**i for i in range(-1, 8)]):
        share = np.exp(-scale * shifted)
        share /= share.sum(axis=1, keepdims=True)
        losses.append(-np.log(np.maximum(share[np.arange(len(truth)), truth], 1e-9)).mean())
    model.scale = grid[int(np.argmin(losses))]
    for i in range(len(model.languages)):
        if len(own := entropy[truth == i, i]) > 1:
            spread = np.abs(own - np.median(own)) * np.sqrt(letters[truth == i])
            model.typical[i] = np.median(own), max(1.0, float(np.quantile(spread, 0.68)))


def fit(rows: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "lang", train_rows: int = TRAIN_ROWS) -> Model | None:
    """Learn from rows with a non-null label. A bounded share of each language is read, chosen by a hash of the id."""
    rows = own_session(rows)
    sizes = dict(rows.where(F.col(label).isNotNull()).groupBy(label).count().collect())
    if not sizes:
        return None
    draw = (F.xxhash64(F.lit("langid"), F.col(id_column)) / F.lit(2.0**64)) + 0.5
    limit = F.lit(None).cast("double")
    for name, size in sorted(sizes.items()):
        limit = F.when(F.col(label) == name, F.lit((train_rows + CALIBRATION_ROWS) / size)).otherwise(limit)
    held = F.lit(CALIBRATION_ROWS / (train_rows + CALIBRATION_ROWS))
    drawn = rows.select(F.col(label).alias("lang"), F.col(text).alias("text"), (draw / F.least(limit, F.lit(1.0))).alias("draw"))
    drawn = drawn.where("lang is not null and text is not null and draw < 1")
    calibration = drawn.where(F.col("draw") < held).select("lang", "text")
    training = drawn.where(F.col("draw") >= held).select("lang", "text")
    grams = training.mapInArrow(_gram_rows, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams = stored(grams, "langid-grams")
    counts = []
    for name in sorted(sizes):
        counts.append(grams.where(F.col("lang") == name).orderBy(F.desc("n"), "gram").limit(GRAMS).toPandas())
    model = build(pd.concat(counts))
    if model is not None:
        _calibrate(model, calibration)
    return model


RESULTS = [
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
]


def detect(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``entropy`` (null for ``und``) and ``rejected``; only the text is looked at."""
    docs = own_session(docs)
    names = [f.name for f in RESULTS]
    kept = [c for c in docs.columns if c not in names]
    schema = T.StructType([docs.schema[c] for c in kept] + RESULTS)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(text).cast(pa.string())).fill_null(0).to_numpy(zero_copy_only=False)
            for start, stop in chunks(sizes):
                part = batch.slice(start, stop - start)
                texts = part.column(text).to_pylist()
                if model is None:
                    some = len(texts)
                    found = [UNKNOWN] * some, np.zeros(some), np.full(some, np.nan), np.ones(some, dtype=bool)
                else:
                    found = model.predict(texts)
                made = [pa.array(found[0], pa.string()), pa.array(found[1]), pa.array(found[2], from_pandas=True), pa.array(found[3])]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + made, names=kept + names)

    return docs.select(*kept).mapInArrow(run, schema)
