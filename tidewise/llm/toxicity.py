"""Toxicity of whole texts: a support vector machine on a gapped string kernel with Nystroem landmarks.

Words are runs between white space, lower case, without signs; neighbouring single characters are read as one word, so
``i-d.i*o.t`` and ``i d i o t`` count as ``idiot``. The kernel of two words sums over common three-letter subsequences
within ``SPAN`` letters, each occurrence weighing ``DECAY`` to the letters it spans, divided by what the words' lengths
alone would give, to the power ``POWER``. A sentence is the sum of its words (sentences end at ``.!?`` before white space and at
line ends, and after ``SENTENCE`` words). Landmark words are those that tell toxic training documents from clean ones
most, and the most frequent clean ones; through them kernel values become features, on which a linear machine with
squared hinge loss is trained. As a sentence's features are sums over words, each word has one number, which is cached.

Training sentences: of a toxic document the one whose words stand out most, of a clean one that and its first. A
document's score is the logistic of its most toxic sentence, scaled on the training documents. Texts without a word
get the score of an empty sentence. With no rows of both labels to learn from, every score is 0. Extra columns stay.

Fitting reads about ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` labelled rows, chosen by a hash of the id; both bounds are
parameters. Scoring reads every text whole; only the text is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import PrefixHash, chunks, mix, own_session, stored
from .bpe import BLANK, LETTER, NUMBER, _point_classes

SPAN, DECAY = 5, 0.7
#: Of the normed kernel: above 1 it keeps chance likeness low, near 1 it lets inserted letters through.
POWER = 1.25
LETTERS = 64
SENTENCE = 32
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 160, 32
TRAIN_TOXIC, TRAIN_CLEAN = 3000, 6000
#: Words whose numbers a Python worker remembers; beyond it the cache starts anew.
CACHE = 1_000_000


@dataclass
class Words:
    """All words of some texts, as slices of ``letters``; ``sentence`` numbers run through the texts."""

    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    document: np.ndarray
    sentence: np.ndarray

    @property
    def hashes(self) -> np.ndarray:
        return mix(PrefixHash(self.letters).slices(self.start, self.end))


def words_of(texts: list[str]) -> Words:
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le"), dtype=np.uint32)
    kinds = _point_classes()[points]
    blank = kinds == BLANK
    follows = np.concatenate((blank[1:], [True]))
    ends = (points == 10) | (np.isin(points, [ord(c) for c in ".!?"]) & follows)
    kept = np.flatnonzero((kinds == LETTER) | (kinds == NUMBER))
    blanks, sentences = np.cumsum(blank)[kept], np.cumsum(ends)[kept]
    document = np.searchsorted(np.cumsum([len(t) + 1 for t in lowered]), kept, side="right")
    start = np.flatnonzero(np.concatenate((np.ones(min(1, len(kept)), bool), blanks[1:] != blanks[:-1])))
    size = np.diff(np.append(start, len(kept)))
    glued = np.zeros(len(start), dtype=bool)
    glued[1:] = (size[1:] == 1) & (size[:-1] == 1) & (document[start[1:]] == document[start[:-1]])
    start = start[~glued]
    end = np.append(start[1:], len(kept))[: len(start)]
    sentence = sentences[start]
    if len(start):
        first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
        rank = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
        sentence = np.cumsum(np.concatenate(([False], sentence[1:] != sentence[:-1])) | (rank % SENTENCE == 0)) - 1
    return Words(points[kept], start, end, document[start], sentence)


def _codes(letters: np.ndarray) -> np.ndarray:
    """Letters as small numbers: a-z and digits keep apart, others share the rest."""
    latin = (letters >= 97) & (letters <= 122)
    digit = (letters >= 48) & (letters <= 57)
    rest = 36 + mix(letters.astype(np.uint64)) % np.uint64(LETTERS - 36)
    return np.where(latin, letters - 97, np.where(digit, letters - 48 + 26, rest)).astype(np.int64)


def _subsequences(size: np.ndarray) -> Iterator[tuple[int, int, float]]:
    for last in range(2, SPAN):
        for middle in range(1, last):
            yield middle, last, DECAY ** (last + 1)


def _norms(size: np.ndarray) -> np.ndarray:
    """Root of the self-similarity of a word of that length without repeated subsequences."""
    total = sum(np.maximum(size - last, 0) * weight**2 for _, last, weight in _subsequences(size))
    return np.sqrt(np.maximum(total, 1e-12))


def _triples(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, subsequence number and weight of every subsequence occurrence of some words."""
    size = end - start
    word = np.repeat(np.arange(len(start)), size)
    place = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    left = np.repeat(end, size) - place
    whose, which, weights = [], [], []
    for middle, last, weight in _subsequences(size):
        at = np.flatnonzero(left > last)
        p = place[at]
        whose.append(word[at])
        which.append((codes[p] * LETTERS + codes[p + middle]) * LETTERS + codes[p + last])
        weights.append(np.full(len(at), weight, dtype=np.float32))
    return np.concatenate(whose), np.concatenate(which), np.concatenate(weights)


class Kernel:
    """Kernel values of words against fixed landmark words."""

    def __init__(self, landmarks: list[str]) -> None:
        points = np.frombuffer("".join(landmarks).encode("utf-32-le"), dtype=np.uint32)
        size = np.array([len(w) for w in landmarks], dtype=np.int64)
        end = np.cumsum(size)
        whose, which, weight = _triples(_codes(points), end - size, end)
        known, place = np.unique(which, return_inverse=True)
        self.row = np.full(LETTERS**3, -1, dtype=np.int32)
        self.row[known] = np.arange(len(known))
        self.table = np.zeros((len(known), len(landmarks)), dtype=np.float32)
        np.add.at(self.table, (place, whose), weight / _norms(size)[whose])

    def __call__(self, letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros((len(start), self.table.shape[1]), dtype=np.float32)
        whose, which, weight = _triples(_codes(letters), start, end)
        row = self.row[which]
        hit = np.flatnonzero(row >= 0)
        order = hit[np.argsort(whose[hit], kind="stable")]
        if len(order):
            scaled = weight[order] / _norms(end - start)[whose[order]].astype(np.float32)
            first = np.flatnonzero(np.concatenate(([True], whose[order][1:] != whose[order][:-1])))
            out[whose[order][first]] = np.add.reduceat(self.table[row[order]] * scaled[:, None], first, axis=0)
        return out**POWER


@dataclass
class Model:
    kernel: Kernel
    weight: np.ndarray  # of each landmark's kernel value
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    def word_values(self, words: Words) -> np.ndarray:
        """Each word's share in its sentence's decision."""
        distinct, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        out = np.empty(len(distinct), dtype=np.float32)
        out[~new] = self.value[place[~new]]
        at = np.flatnonzero(new)
        for i in range(0, len(at), 1 << 14):
            part = at[i : i + (1 << 14)]
            out[part] = self.kernel(words.letters, words.start[first[part]], words.end[first[part]]) @ self.weight
        if len(self.known) + len(at) > CACHE:
            self.known, self.value = distinct, out
        else:
            self.known = np.insert(self.known, place[new], distinct[new])
            self.value = np.insert(self.value, place[new], out[new])
        return out[inverse]

    def decisions(self, texts: list[str]) -> np.ndarray:
        """The decision value of each text's most toxic sentence."""
        words = words_of(texts)
        out = np.full(len(texts), self.offset)
        if len(words.start):
            first = np.flatnonzero(np.concatenate(([True], words.sentence[1:] != words.sentence[:-1])))
            sums = np.add.reduceat(self.word_values(words).astype(np.float64), first) + self.offset
            np.maximum.at(out, words.document[first], sums)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.decisions(texts) + self.shift, -60, 60)))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many clean and toxic documents of a chunk have each word."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        for i, j in chunks(sizes):
            toxic = batch.column(0).slice(i, j - i).to_numpy(zero_copy_only=False)
            words = words_of(batch.column(1).slice(i, j - i).to_pylist())
            hashes = words.hashes
            order = np.lexsort((hashes, words.document))
            h, d = hashes[order], words.document[order]
            once = order[np.concatenate((np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (d[1:] != d[:-1])))]
            _, first, inverse = np.unique(hashes[once], return_index=True, return_inverse=True)
            bad = np.bincount(inverse, weights=toxic[words.document[once]], minlength=len(first)).astype(np.int64)
            text = words.letters.tobytes().decode("utf-32-le")
            cut = zip(words.start[once[first]].tolist(), words.end[once[first]].tolist())
            names = [text[a:b] for a, b in cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(bad), pa.array(np.bincount(inverse) - bad)], names=["word", "toxic", "clean"]
            )


def _sentence_rows(batches: Iterator[pa.RecordBatch], kernel: Kernel, evidence: dict[str, float]) -> Iterator[pa.RecordBatch]:
    """Kernel sums of the training sentences: a document's most striking one, and a clean document's first."""
    points = np.frombuffer("".join(evidence).encode("utf-32-le"), dtype=np.uint32)
    size = np.array([len(w) for w in evidence], dtype=np.int64)
    hashes = mix(PrefixHash(points).slices(np.cumsum(size) - size, np.cumsum(size)))
    order = np.argsort(hashes)
    hashes, worth = hashes[order], np.array(list(evidence.values()))[order]
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        for i, j in chunks(sizes):
            toxic = batch.column(0).slice(i, j - i).to_numpy(zero_copy_only=False)
            words = words_of(batch.column(1).slice(i, j - i).to_pylist())
            if not len(words.start):
                continue
            mine = words.hashes
            place = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
            striking = np.where(hashes[place] == mine, worth[place], 0.0)
            first = np.flatnonzero(np.concatenate(([True], words.sentence[1:] != words.sentence[:-1])))
            sums, whose = np.add.reduceat(striking, first), words.document[first]
            ranked = np.lexsort((-sums, whose))
            best = ranked[np.concatenate(([True], whose[ranked][1:] != whose[ranked][:-1]))]
            opening = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
            chosen = np.unique(np.concatenate((best, opening[toxic[whose[opening]] == 0])))
            stop = np.append(first[1:], len(words.start))
            inside = np.concatenate([np.arange(first[s], stop[s]) for s in chosen.tolist()])
            begin = np.cumsum(stop[chosen] - first[chosen]) - (stop[chosen] - first[chosen])
            values = np.add.reduceat(kernel(words.letters, words.start[inside], words.end[inside]), begin, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic[whose[chosen]].astype(np.int32)), pa.array(list(values), pa.list_(pa.float32()))], names=["toxic", "sums"]
            )


def _train(features: np.ndarray, sign: np.ndarray, cost: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps on the rows inside the margin; the last weight is the offset."""
    x = np.column_stack((features, np.ones(len(features))))
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        inside = sign * (x @ w) < 1
        weighted = x[inside] * cost[inside, None]
        new = np.linalg.solve(weighted.T @ x[inside] + np.diag(keep), weighted.T @ sign[inside])
        done = np.allclose(new, w, atol=1e-6)
        # A half step once in a while keeps the active set from swinging.
        w = new if done else 0.25 * w + 0.75 * new
        if done:
            break
    return w


def _platt(value: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with smoothed targets."""
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    target = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.column_stack((value, np.ones(len(value)))), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        grad = x.T @ (p - target) + 1e-3 * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        w = w - step / max(1.0, np.abs(step).max())
    return max(float(w[0]), 1e-3), float(w[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
    train_toxic: int = TRAIN_TOXIC, train_clean: int = TRAIN_CLEAN,
) -> Model | None:
    """Learn from the documents of ``labels`` (id and a label of 0 or 1); about ``train_toxic`` and ``train_clean`` are read.

    The rows are drawn among the labels, so the two numbers bound what is sent to the tasks that read the texts.
    """
    docs = own_session(docs)
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("toxic"))
    sizes = dict(known.groupBy("toxic").count().collect())
    if len(sizes) < 2:
        return None
    share = F.when(F.col("toxic") == 1, F.lit(train_toxic / sizes[1])).otherwise(F.lit(train_clean / sizes[0]))
    draw = F.xxhash64(F.lit("toxicity"), F.col("_id")) / F.lit(2.0**64) + 0.5
    chosen = F.broadcast(known.where(draw < share))
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    drawn = rows.join(chosen, rows["id"] == chosen["_id"]).select("toxic", "text")
    sample = stored(drawn, "toxicity-sample")
    n = dict(sample.groupBy("toxic").count().collect())
    if len(n) < 2:
        return None
    counts = sample.mapInArrow(_word_rows, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    # Log-likelihood ratio of a word that is as frequent in toxic as in clean documents, signed: unlike a ratio over its
    # error it ranks words that are never in clean documents before those that copies have made frequent in both.
    both, share = F.col("a") + F.col("b"), n[1] / (n[1] + n[0])

    def part(seen: str, portion: float):
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / (both * portion))).otherwise(0.0)

    ratio = part("a", share) + part("b", 1 - share)
    ranked = stored(counts.withColumn("z", F.when(F.col("a") > both * share, ratio).otherwise(-ratio)), "toxicity-words")
    striking = ranked.where("length(word) >= 3 and a >= 3 and z > 0").orderBy(F.desc("z"), "word").limit(TOXIC_LANDMARKS).collect()
    usual = ranked.where("length(word) >= 3 and z <= 0").orderBy(F.desc("b"), "word").limit(CLEAN_LANDMARKS).collect()
    if not striking:
        return None
    landmarks = [r["word"] for r in [*striking, *usual]]
    kernel, evidence = Kernel(landmarks), {r["word"]: float(r["z"]) for r in striking}
    got = sample.mapInArrow(lambda it: _sentence_rows(it, kernel, evidence), "toxic int, sums array<float>").toPandas()
    size = np.array([len(w) for w in landmarks], dtype=np.int64)
    points = np.frombuffer("".join(landmarks).encode("utf-32-le"), dtype=np.uint32)
    own = kernel(points, np.cumsum(size) - size, np.cumsum(size)).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-3 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    sums = np.stack(got["sums"].to_numpy()).astype(np.float64)
    toxic = got["toxic"].to_numpy()
    if len(set(toxic.tolist())) < 2:
        return None
    cost = np.where(toxic == 1, len(toxic) / (2 * (toxic == 1).sum()), len(toxic) / (2 * (toxic == 0).sum()))
    w = _train(sums @ root, np.where(toxic == 1, 1.0, -1.0), cost)
    model = Model(kernel, (root @ w[:-1]).astype(np.float32), float(w[-1]))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in chunks(sizes):
                value = model.decisions(batch.column(1).slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(value)], names=["toxic", "value"])

    held = sample.mapInArrow(decide, "toxic int, value double").toPandas()
    model.slope, model.shift = _platt(held["value"].to_numpy(), held["toxic"].to_numpy())
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); columns of these names are replaced."""
    docs = own_session(docs)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(text).cast(pa.string())).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in chunks(sizes):
                part = batch.slice(i, j - i)
                texts = [t or "" for t in part.column(text).to_pylist()]
                values = model.scores(texts) if model is not None else np.zeros(len(texts))
                made = [pa.array(values), pa.array((values >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + made, names=[*kept, "score", "predicted"])

    return docs.select(*kept).mapInArrow(run, schema)
