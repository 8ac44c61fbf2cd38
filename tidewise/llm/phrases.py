"""Phrases that occur together more often than their parts apart: set-oriented mining over sorted occurrence relations.

Texts are lower-cased (A-Z only), split at ``PIECE_ENDS`` into pieces and those into words at blanks and tabs; everything
is counted per language. The relation of k-word occurrences, R(k), has a row (piece, position, phrase) for each, sorted by
piece and position:

1. R(1) is read off the texts and written, in blocks of ``BLOCK_BYTES`` of text. A block is a row: its dictionary, and the
   occurrences in order, a piece and a position folded into one place (neighbours in a piece are one apart, pieces more).
2. *Group-count.* Each block counts its own distinct phrases; their counts meet by phrase and are summed.
3. *Semi-join.* Phrases of ``least`` occurrences get a number, which goes back to the blocks that hold them; a block
   keeps the occurrences of numbered phrases only.
4. *Merge-join.* R(k + 1) pairs an occurrence in R(k) at place p with the one in R(1) at p + k, both in order, and is
   written; then step 2 again, up to ``LONGEST`` words. A key is the pair (phrase, word) of numbers, so counts are exact.

What meets in a task are distinct phrases of blocks, never the occurrences of one: a phrase in every document sends a
row for each block. The frequent phrases stay tables; cuts, containment and ranks are joins and aggregates of these.

A phrase's score is that of its worst cut, ``2 a / (l + r)`` in millionths, rounded down in exact decimals. Phrases that a
longer frequent one contains and nearly always comes with (``ABSORB`` percent) are dropped.

Null text counts as empty and gives no words, a null language as ``und``. Repeated rows count as often as they occur.
Long texts are cut at piece ends only. No words: no rows. Other columns of the documents do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import BASE, discard, mix, own_session, pieces, stored

# What ends a piece, what separates words, and the language of texts without one.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"
NO_LANGUAGE = "und"
SCALE = 2_000_000

LEAST = 30
LONGEST = 4
ABSORB = 80
TOP = 2000
#: Text of a block, text whose phrases' counts meet in one task, and counts that a task holds before it sends them on.
BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 4 << 20
HELD = 1 << 18
#: Blocks that go to Python at once.
BLOCK_ROWS = 1

WORD, BLANK, END = 0, 1, 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_KIND = np.array([END if c in PIECE_ENDS else BLANK if c in BLANKS else WORD for c in range(256)], dtype=np.uint8)

#: A block's count of one phrase, keyed by its first words and its last one, and the number that comes back.
COUNT = np.dtype([("pre", "<i8"), ("next", "<i8"), ("n", "<i4"), ("block", "<i8"), ("at", "<i4")])
NUMBER = np.dtype([("at", "<i4"), ("id", "<i8")])

OCCURRENCES = "block long, lang array<string>, word array<string>, n array<long>, places binary, words binary"
RELATION = "block long, places1 binary, words1 binary, ids1 binary, places binary, phrases binary, bucket int, counts binary"
GROUPS = "id long, pre long, next long, a long, block long, numbers binary"


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _pack_places(places: np.ndarray) -> bytes:
    """Ascending places by their steps, nearly all of which are alike."""
    return _pack(np.diff(places, prepend=0).astype("<i4"))


def _unpack_places(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, "<i4"), dtype=np.int64)


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts in order of block and place in it, byte by byte of each field: the upper bytes are mostly alike."""
    steps = counts.copy()
    steps["at"] = np.diff(counts["at"], prepend=0)
    return _pack(steps.view(np.uint8).reshape(len(counts), COUNT.itemsize).T)


def _unpack_counts(data: bytes) -> np.ndarray:
    planes = _unpack(data, "u1").reshape(COUNT.itemsize, -1)
    counts = planes.T.copy().view(COUNT).reshape(-1)
    counts["at"] = np.cumsum(counts["at"])
    return counts


def _parts(text: bytes, limit: int) -> Iterator[bytes]:
    """A text in parts of about ``limit`` bytes that end where pieces do."""
    if len(text) <= limit:
        yield text
        return
    ends = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8)] == END) + 1
    start = 0
    while start < len(text):
        beyond = np.searchsorted(ends, start + limit)
        stop = int(ends[beyond]) if beyond < len(ends) else len(text)
        yield text[start:stop]
        start = stop


def occurrences(texts: list[bytes], langs: list[str]) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (language, word) with their counts, and all words in order: places and numbers of distinct words."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    data = np.frombuffer(b"\n".join([*texts, b""]).translate(_LOWER), np.uint8)
    kind = _KIND[data]
    inside = np.concatenate(([False], kind == WORD, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(stop - start)))
    letters = pa.py_buffer(data[kind == WORD])
    words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), letters]).dictionary_encode()
    place = np.arange(len(start)) + np.cumsum(kind == END, dtype=np.int32)[start]
    names = {name: i for i, name in enumerate(dict.fromkeys(langs))}
    spoken = np.array([names[name] for name in langs], dtype=np.int64)
    lang = spoken[np.searchsorted(np.cumsum(sizes), start, side="right")]
    total = max(1, len(words.dictionary))
    found, number, count = np.unique(
        lang * total + words.indices.to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True
    )
    lang_of = pa.array(list(names), pa.string()).take(pa.array(found // total))
    return lang_of, words.dictionary.take(pa.array(found % total)).cast(pa.string()), count, place, number


def _scan(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """R(1), a row for each block."""
    texts, langs, size, block = [], [], 0, TaskContext.get().partitionId() << 32

    def row() -> pa.RecordBatch:
        lang, word, n, place, number = occurrences(texts, langs)
        bounds = pa.array([0, len(word)], pa.int32())
        columns = [pa.array([block], pa.int64())]
        columns += [pa.ListArray.from_arrays(bounds, values) for values in (lang, word, pa.array(n, pa.int64()))]
        columns += [pa.array([_pack_places(place)], pa.binary()), pa.array([_pack(number.astype("<i4"))], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "lang", "word", "n", "places", "words"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in _parts(text.as_buffer().to_pybytes(), block_bytes):
                texts.append(part)
                langs.append(lang)
                size += len(part)
                if size >= block_bytes:
                    yield row()
                    texts, langs, size, block = [], [], 0, block + 1
    if texts:
        yield row()


def _numbered(held: np.ndarray, places: np.ndarray, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The semi-join in a block: occurrences of the phrases that were given numbers, and those numbers in order."""
    rank = np.full(int(max(phrases.max(initial=-1), held["at"].max(initial=-1))) + 1, -1, dtype=np.int64)
    rank[held["at"]] = np.arange(len(held))
    rank = rank[phrases]
    return places[rank >= 0], rank[rank >= 0], held["id"].astype(np.int64)


def _extend(batches: Iterator[pa.RecordBatch], k: int, buckets: int, more: bool) -> Iterator[pa.RecordBatch]:
    """R(k + 1) of each block by a merge-join of R(k) and R(1), and its blocks' counts by bucket of their phrase."""
    sums: list[np.ndarray] = []

    def relation(*values) -> pa.RecordBatch:
        row = [pa.array([v], pa.int64() if i == 0 else pa.binary()) for i, v in enumerate(values)]
        row += [pa.array([None], pa.int32()), pa.array([None], pa.binary())]
        return pa.RecordBatch.from_arrays(row, schema=_RELATION)

    def sent() -> pa.RecordBatch:
        counts = np.concatenate(sums)
        key = mix(counts["pre"].view(np.uint64) * np.uint64(BASE) ^ mix(counts["next"].view(np.uint64)))
        bucket = (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
        at = [order[i:j] for i, j in zip(cut, cut[1:])]
        row = [pa.nulls(len(at), f.type) for f in list(_RELATION)[:-2]]
        row += [pa.array([int(bucket[p[0]]) for p in at], pa.int32()), pa.array([_pack_counts(counts[p]) for p in at], pa.binary())]
        return pa.RecordBatch.from_arrays(row, schema=_RELATION)

    for batch in batches:
        several = [batch.column(n) for n in ("ats", "ids")] if k == 1 else [batch.column("numbers")]
        for i, row in enumerate(batch.select(["block", *_RELATION.names[1:6]]).to_pylist()):
            held = [column[i].values for column in several]
            if k == 1:
                given = np.empty(len(held[0]), NUMBER)
                given["at"], given["id"] = (values.to_numpy(zero_copy_only=False) for values in held)
            else:
                given = np.frombuffer(b"".join(held[0].to_pylist()), NUMBER)
            places, phrases, ids = _numbered(given, _unpack_places(row["places"]), _unpack(row["phrases"], "<i4"))
            if k == 1:
                places1, words1, ids1 = places, phrases, ids
            else:
                places1, words1, ids1 = _unpack_places(row["places1"]), _unpack(row["words1"], "<i4"), _unpack(row["ids1"], "<i8")
            at = np.searchsorted(places1, places + k)
            meets = at < len(places1)
            meets[meets] = places1[at[meets]] == places[meets] + k
            pair = phrases[meets] * max(1, len(ids1)) + words1[at[meets]]
            found, number, n = np.unique(pair, return_inverse=True, return_counts=True)
            places = places[meets]
            counts = np.empty(len(found), COUNT)
            counts["pre"], counts["next"] = ids[found // max(1, len(ids1))], ids1[found % max(1, len(ids1))]
            counts["n"], counts["block"], counts["at"] = n, row["block"], np.arange(len(found))
            sums.append(counts)
            if more and len(found):
                # Of R(1), the next join asks for what follows these occurrences only.
                next_ = np.isin(places1, places + k + 1, assume_unique=True)
                packed = _pack_places(places1[next_]), _pack(words1[next_].astype("<i4")), _pack(ids1.astype("<i8"))
                yield relation(row["block"], *packed, _pack_places(places), _pack(number.astype("<i4")))
            if sum(map(len, sums)) >= HELD:
                yield sent()
                sums = []
    if sum(map(len, sums)):
        yield sent()


_RELATION = pa.schema(
    [("block", pa.int64())]
    + [(n, pa.binary()) for n in ("places1", "words1", "ids1", "places", "phrases")]
    + [("bucket", pa.int32()), ("counts", pa.binary())]
)


def _count(key: tuple, table: pa.Table, least: int, more: bool) -> pa.Table:
    """The group-count of one bucket's phrases: those frequent enough, and their numbers for each block that has them."""
    rows = np.concatenate([_unpack_counts(c.as_py()) for c in table.column("counts")])
    rows = rows[np.lexsort((rows["next"], rows["pre"]))]
    starts = np.flatnonzero(np.concatenate(([True], (rows["pre"][1:] != rows["pre"][:-1]) | (rows["next"][1:] != rows["next"][:-1]))))
    total = np.add.reduceat(rows["n"].astype(np.int64), starts)
    frequent = total >= least
    number = (np.int64(key[0].as_py()) << np.int64(40)) + np.cumsum(frequent) - 1
    groups = rows[starts[frequent]]
    blocks, packed = [], []
    if more:
        size = np.diff(np.append(starts, len(rows)))
        kept = np.repeat(frequent, size)
        back = np.empty(int(kept.sum()), NUMBER)
        back["at"], back["id"] = rows["at"][kept], np.repeat(number, size)[kept]
        block = rows["block"][kept]
        order = np.argsort(block, kind="stable")
        back, block = back[order], block[order]
        cut = np.flatnonzero(np.diff(block, prepend=-1)).tolist() + [len(block)]
        blocks = [int(block[i]) for i in cut[:-1]]
        packed = [back[i:j].tobytes() for i, j in zip(cut, cut[1:])]
    none, nothing = len(groups), len(blocks)
    columns = [
        pa.concat_arrays([pa.array(values, pa.int64()), pa.nulls(nothing, pa.int64())])
        for values in (number[frequent], groups["pre"].copy(), groups["next"].copy(), total[frequent])
    ]
    columns.append(pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(blocks, pa.int64())]))
    columns.append(pa.concat_arrays([pa.nulls(none, pa.binary()), pa.array(packed, pa.binary())]))
    return pa.Table.from_arrays(columns, names=["id", "pre", "next", "a", "block", "numbers"])


def _extender(k: int, buckets: int, more: bool):
    return lambda batches: _extend(batches, k, buckets, more)


def _counter(least: int, more: bool):
    return lambda key, table: _count(key, table, least, more)


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, a) for every phrase of up to ``longest`` words with a count ``a`` of at least ``least``; (lang, n)."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    rows = own_session(rows.where("text != ''"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = pieces(total, BUCKET_BYTES)
    blocks = stored(rows.mapInArrow(lambda it: _scan(it, block_bytes), OCCURRENCES), "phrases-1", "zstd", large_rows=True)
    counted = blocks.select("block", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("at", "it")).select("block", "at", "it.*")
    totals = stored(counted.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    words = counted.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    words = stored(words.withColumn("id", F.monotonically_increasing_id()), "phrases-words")
    # Both lists take the same rows in the same order; as lists of numbers they are a third of one list of pairs.
    numbers = counted.join(words, ["lang", "word"]).groupBy("block").agg(F.collect_list("at").alias("ats"), F.collect_list("id").alias("ids"))
    relation = blocks.select("block", *[F.lit(None).cast("binary").alias(n) for n in ("places1", "words1", "ids1")], "places", F.col("words").alias("phrases"))
    named = words.select("id", "lang", F.array("word").alias("words"), "a")
    found, table = [named], blocks
    for k in range(1, longest):
        more = k + 1 < longest
        joined = own_session(relation.join(numbers, "block"), BLOCK_ROWS)
        step = stored(joined.mapInArrow(_extender(k, buckets, more), RELATION), f"phrases-{k + 1}")
        counts = step.where("counts is not null").select("bucket", "counts")
        groups = stored(counts.groupBy("bucket").applyInArrow(_counter(least, more), GROUPS), f"phrases-groups-{k + 1}")
        discard(table)
        table = step
        longer = groups.where("id is not null").select("id", "pre", "next", "a")
        before = named.select(F.col("id").alias("pre"), "lang", F.col("words").alias("first"))
        after = words.select(F.col("id").alias("next"), "word")
        named = longer.join(before, "pre").join(after, "next").select("id", "lang", F.concat("first", F.array("word")).alias("words"), "a")
        found.append(named)
        relation = step.where("counts is null").drop("bucket", "counts")
        numbers = groups.where("block is not null").groupBy("block").agg(F.collect_list("numbers").alias("numbers"))
    discard(table)
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every.select("lang", "words", "a"), totals


def _long(name: str) -> str:
    """Counts as decimals, whose products may pass 64 bits."""
    return f"cast({name} as decimal(20, 0))"


def _joined(words, start, length):
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
    absorb: int = ABSORB, top: int = TOP, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, its count ``a``, those of the parts at its worst cut, ``n`` words, score."""
    every, totals = frequent_phrases(docs, text, lang, least, longest, block_bytes)
    size = F.size("words").alias("size")
    every = stored(every.select("lang", "words", size, F.array_join("words", " ").alias("phrase"), "a"), "phrases-frequent")
    cuts = every.where("size >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    first, rest = _joined("words", F.lit(1), F.col("k")), _joined("words", F.col("k") + 1, F.col("size") - F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    left = every.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = every.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    cuts = cuts.withColumn("score", F.expr(f"({_long('a')} * {SCALE}) div ({_long('l')} + {_long('r')})"))
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = every.where("size >= 3").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    around = inner.groupBy("lang", _joined("words", F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("around"))
    own = worst.join(around, ["lang", "phrase"], "left").where(f"around is null or 100 * {_long('around')} < {absorb} * {_long('a')}")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
