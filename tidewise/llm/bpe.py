"""Byte-level BPE: encode whole texts to ids and decode ids to bytes.

The pre-tokeniser works without a regular expression. Each character gets a class
(letter, number, blank, ...) from a table over all code points, a few classes
depend on the characters that follow. Every class is a transition function over a
few states ("inside a word", "after a blank", ...). Function composition is
associative, so a scan over blocks gives the state before every character of a
whole chunk of documents with array operations, and a table of (state, class) says
where a slice begins. Slices then go through a cache of merged slices: those of
up to 15 bytes are two numbers, looked up for a whole chunk at once in a table that
compares both; the few longer ones go through a dictionary.

Null and empty texts encode to no ids. Rows and their other columns are kept as
they are; ``ids``, ``ends`` and ``n_tokens`` replace columns of those names.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrays import BASE, chunks, mix, own_session

#: Slices that a Python worker remembers; beyond it the cache starts anew.
CACHE = 400_000
#: Slots of the table of short slices, of at most so many bytes; and masks of a number's first bytes.
SLOTS, SHORT_SLICE = 1 << 20, 15
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)

# The white space of the pattern, as ranges of code points.
BLANKS = [
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
# What may follow an apostrophe in a contraction.
SHORT, LONG = "stmd", ("re", "ve", "ll")

LETTER, NUMBER, OTHER, QUOTE1, QUOTE2, BLANK, LAST_BLANK, LAST_SPACE, END = range(9)
IN_WORD, IN_NUMBER, IN_OTHER, SPACE, IN_BLANKS, ONE_MORE, TWO_MORE, CLOSED = range(8)
END_POINT = 0x110000

# From which states a character of a class goes on with the slice, and the state after it.
GOES_ON = {
    LETTER: {IN_WORD, SPACE, ONE_MORE, TWO_MORE},
    NUMBER: {IN_NUMBER, SPACE},
    OTHER: {IN_OTHER, SPACE},
    QUOTE1: {IN_OTHER, SPACE},
    QUOTE2: {IN_OTHER, SPACE},
    BLANK: {IN_BLANKS},
    LAST_BLANK: set(),
    LAST_SPACE: set(),
    END: set(),
}


def _after(kind: int, state: int) -> int:
    if kind == LETTER:
        return {TWO_MORE: ONE_MORE, ONE_MORE: CLOSED}.get(state, IN_WORD)
    if kind in (QUOTE1, QUOTE2) and state not in GOES_ON[kind]:
        return ONE_MORE if kind == QUOTE1 else TWO_MORE
    return {NUMBER: IN_NUMBER, BLANK: IN_BLANKS, LAST_BLANK: CLOSED, LAST_SPACE: SPACE, END: CLOSED}.get(kind, IN_OTHER)


@functools.lru_cache(maxsize=1)
def _machine() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins[state, class]; composed[f, g] = first f, then g; applied[f, state]. Function ``c`` is that of class c."""
    functions = [tuple(_after(kind, state) for state in range(8)) for kind in range(9)]
    number = {f: i for i, f in reversed(list(enumerate(functions)))}
    at = 0
    while at < len(functions):
        for generator in functions[:9]:
            new = tuple(generator[s] for s in functions[at])
            if new not in number:
                number[new] = len(functions)
                functions.append(new)
        at += 1
    applied = np.array(functions, dtype=np.uint8)
    composed = np.array([[number[tuple(g[s] for s in f)] for g in functions] for f in functions], dtype=np.uint16)
    begins = np.array([[state not in GOES_ON[kind] for kind in range(9)] for state in range(8)])
    return begins, composed, applied


@functools.lru_cache(maxsize=1)
def _point_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(p))[0], OTHER) for p in range(END_POINT)] + [END], dtype=np.uint8)
    for low, high in BLANKS:
        table[low : high + 1] = BLANK
    return table


def _states_before(kinds: np.ndarray, width: int = 128) -> np.ndarray:
    """The state before each character, by a scan over function compositions in blocks of ``width``."""
    _, composed, applied = _machine()
    rows = -(-len(kinds) // width)
    padded = np.full(rows * width, END, dtype=np.uint16)
    padded[: len(kinds)] = kinds
    scanned = np.ascontiguousarray(padded.reshape(rows, width).T)
    for i in range(1, width):
        scanned[i] = composed[scanned[i - 1], scanned[i]]
    enter = np.empty(rows, dtype=np.uint8)
    if rows <= width:
        state = CLOSED
        for row in range(rows):
            enter[row] = state
            state = applied[scanned[-1, row], state]
    else:
        enter = _states_before_functions(scanned[-1], width)
    after = applied[scanned, enter[None, :]].T.reshape(-1)[: len(kinds)]
    return np.concatenate(([np.uint8(CLOSED)], after[:-1]))


def _states_before_functions(functions: np.ndarray, width: int) -> np.ndarray:
    """The same scan one level up, over the functions of whole blocks."""
    return _states_before(functions, width)


def slice_starts(points: np.ndarray) -> np.ndarray:
    """Where slices begin in code points in which END_POINT ends every document."""
    kinds = _point_classes()[points]
    following = np.concatenate((kinds[1:], [np.uint8(END)]))
    blank = kinds == BLANK
    last = blank & (following != BLANK) & (following != END)
    kinds[last] = np.where(points[last] == 0x20, LAST_SPACE, LAST_BLANK)
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        one = points[np.minimum(quotes + 1, len(points) - 1)]
        two = points[np.minimum(quotes + 2, len(points) - 1)]
        kinds[quotes[np.isin(one, [ord(c) for c in SHORT])]] = QUOTE1
        for pair in LONG:
            kinds[quotes[(one == ord(pair[0])) & (two == ord(pair[1]))]] = QUOTE2
    begins, _, _ = _machine()
    return np.flatnonzero(begins[_states_before(kinds), kinds])


class Merges:
    """The ids of slices. What is known of a slice is its place in ``pool``; unknown slices of a chunk are merged together."""

    NONE = 1 << 40

    def __init__(self, ranks: dict[bytes, int], limit: int = CACHE) -> None:
        self.ranks, self.limit = ranks, limit
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        splits = ((t[:i], t[i:], r) for t, r in ranks.items() for i in range(1, len(t)))
        pairs = np.array([(ranks[a] << 20 | ranks[b], r) for a, b, r in splits if a in ranks and b in ranks], dtype=np.int64)
        pairs = pairs.reshape(-1, 2)[np.argsort(pairs.reshape(-1, 2)[:, 0])]
        self.pair, self.merged = np.append(pairs[:, 0], self.NONE), np.append(pairs[:, 1], self.NONE)
        self._forget()

    def _forget(self) -> None:
        self.pool, self.used, self.slices = np.zeros(1 << 16, dtype=np.uint32), 0, 0
        # Slots by a hash of the slice; a later slice takes an earlier one's slot. A slice's length is part of ``high``, which is never 0.
        self.low, self.high = np.zeros(SLOTS, dtype=np.uint64), np.zeros(SLOTS, dtype=np.uint64)
        self.at, self.count = np.zeros(SLOTS, dtype=np.int64), np.zeros(SLOTS, dtype=np.int64)
        self.long: dict[bytes, tuple[int, int]] = {}

    def _keep(self, ids: np.ndarray) -> int:
        """Append ids to the pool; where they begin."""
        start, self.used = self.used, self.used + len(ids)
        if self.used > len(self.pool):
            self.pool = np.concatenate((self.pool[:start], np.zeros(2 * self.used - start, dtype=np.uint32)))
        self.pool[start : self.used] = ids
        return start

    def places(self, data: bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``pool`` each slice's ids begin, and how many they are; valid until the next call.

        A full cache starts anew, so it never outgrows its limit and one chunk.
        """
        if self.slices > self.limit or self.used > 8 * self.limit:
            self._forget()
        at, count = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        # The eight bytes from each place on.
        words = np.ndarray(len(data) + 9, dtype="<u8", buffer=data + bytes(16), strides=(1,))
        short = np.flatnonzero((size > 0) & (size <= SHORT_SLICE))
        begin, width = start[short], size[short]
        low = words[begin] & FIRST_BYTES[np.minimum(width, 8)]
        high = (words[begin + 8] & FIRST_BYTES[np.maximum(width - 8, 0)]) | width.astype(np.uint64) << np.uint64(56)
        slot = (mix(low ^ (high * np.uint64(BASE))) & np.uint64(SLOTS - 1)).astype(np.int64)
        at[short], count[short] = self.at[slot], self.count[slot]
        unknown = np.flatnonzero((self.low[slot] != low) | (self.high[slot] != high))
        if len(unknown):
            unknown = unknown[np.lexsort((high[unknown], low[unknown]))]
            differs = (np.diff(low[unknown]) != 0) | (np.diff(high[unknown]) != 0)
            first = np.concatenate(([True], differs))
            new, kind = unknown[first], np.cumsum(first) - 1
            ids, counts = self._merge_together([data[i : i + n] for i, n in zip(begin[new].tolist(), width[new].tolist())])
            places = self._keep(ids) + np.cumsum(counts) - counts
            at[short[unknown]], count[short[unknown]] = places[kind], counts[kind]
            taken, which = np.unique(slot[new], return_index=True)
            self.low[taken], self.high[taken] = low[new[which]], high[new[which]]
            self.at[taken], self.count[taken] = places[which], counts[which]
            self.slices += len(new)
        for i in np.flatnonzero(size > SHORT_SLICE).tolist():
            piece = data[start[i] : start[i] + size[i]]
            if piece not in self.long:
                ids = self._merge_long(piece)
                self.long[piece] = self._keep(np.array(ids, dtype=np.uint32)), len(ids)
                self.slices += 1
            at[i], count[i] = self.long[piece]
        return at, count

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 20 | right
        at = np.searchsorted(self.pair, wanted)
        return np.where(self.pair[at] == wanted, self.merged[at], self.NONE)

    def _merge_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slices in a row, and how many each has. Each round merges every slice's pair of lowest rank, the leftmost of equals; done slices leave the round."""
        sizes = np.array([len(p) for p in pieces])
        ids = self.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        rank = np.full(len(ids), self.NONE)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self._rank(ids[inner], ids[inner + 1])
        done_ids, done_owner = [], []
        while len(ids):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            counts = np.diff(np.append(starts, len(ids)))
            lowest = np.minimum.reduceat(rank, starts)
            going = np.repeat(lowest < self.NONE, counts)
            if not going.all():
                done_ids.append(ids[~going])
                done_owner.append(owner[~going])
                ids, owner, rank = ids[going], owner[going], rank[going]
                lowest, counts = lowest[lowest < self.NONE], counts[lowest < self.NONE]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == np.repeat(lowest, counts))
            hits = hits[np.concatenate(([True], owner[hits[1:]] != owner[hits[:-1]]))]
            ids[hits] = lowest
            keep = np.ones(len(ids), dtype=bool)
            keep[hits + 1] = False
            at = hits - np.arange(len(hits))
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            for changed in (at, at[at > 0] - 1):
                after = np.minimum(changed + 1, len(ids) - 1)
                same = (owner[changed] == owner[after]) & (after > changed)
                rank[changed] = np.where(same, self._rank(ids[changed], ids[after]), self.NONE)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owner, minlength=len(pieces))

    def _merge_long(self, piece: bytes) -> list[int]:
        """One long slice with a heap, which keeps the time near linear."""
        ranks, n = self.ranks, len(piece)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, stop = heapq.heappop(heap)
            right = after[left]
            if not alive[left] or right >= n or end[right] != stop:
                continue
            alive[right] = False
            end[left] = stop
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                if (r := ranks.get(piece[left : end[after[left]]])) is not None:
                    heapq.heappush(heap, (r, left, end[after[left]]))
            if before[left] >= 0 and (r := ranks.get(piece[before[left] : stop])) is not None:
                heapq.heappush(heap, (r, before[left], stop))
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at : end[at]]])
            at = after[at]
        return out


@functools.lru_cache(maxsize=2)
def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line holds a token in base 64 and its id."""
    return {base64.b64decode(token): int(number) for token, number in map(bytes.split, raw.splitlines())}


@functools.lru_cache(maxsize=2)
def merges_of(raw: bytes) -> Merges:
    return Merges(parse_ranks(raw))


@functools.lru_cache(maxsize=2)
def token_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All tokens in one buffer, and where each id's bytes begin in it."""
    ranks = parse_ranks(raw)
    size = max(ranks.values(), default=-1) + 1
    tokens = [b""] * size
    for token, number in ranks.items():
        tokens[number] = token
    starts = np.zeros(size + 1, dtype=np.int64)
    np.cumsum([len(t) for t in tokens], out=starts[1:])
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), starts


def encode_chunk(texts: list[str], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and the place after each text's last (0 first); the texts are sliced together."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    points[ends] = END_POINT
    widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + ((points >= 0x10000) & (points < END_POINT))
    widths[ends] = 1
    offset = np.zeros(len(points) + 1, dtype=np.int64)
    np.cumsum(widths, out=offset[1:])
    starts = slice_starts(points)
    bounds = offset[np.append(starts, len(points))]
    size = np.diff(bounds)
    # END begins a slice of its own, which closes the document's last slice and has no ids.
    closing = np.searchsorted(starts, ends)
    size[closing] = 0
    at, count = merges.places(joined.encode(), bounds[:-1], size)
    total = np.cumsum(count)
    ids = merges.pool[np.repeat(at - (total - count), count) + np.arange(total[-1])]
    return ids, np.concatenate(([0], total[closing]))


def encode_texts(texts: list[str], merges: Merges) -> list[bytes]:
    """The ids of each text, packed."""
    ids, cut = encode_chunk(texts, merges)
    packed, cut = ids.astype("<u4").tobytes(), (cut * 4).tolist()
    return [packed[i:j] for i, j in zip(cut, cut[1:])]


def decode_ids(ids: np.ndarray, ends: np.ndarray, raw: bytes) -> bytes:
    """The bytes of a document's ids; ``ends`` are the retained ends of the tokens."""
    if not len(ids):
        return b""
    buffer, starts = token_bytes(raw)
    begin = np.concatenate(([0], ends[:-1])).astype(np.int64)
    length = ends.astype(np.int64) - begin
    shift = starts[ids] - begin
    return buffer[np.repeat(shift, length) + np.arange(int(ends[-1]))].tobytes()


def _token_ends(ids: np.ndarray, raw: bytes) -> np.ndarray:
    _, starts = token_bytes(raw)
    return np.cumsum(starts[ids + np.uint32(1)] - starts[ids])


def token_ends(ids: np.ndarray, raw: bytes) -> np.ndarray:
    return _token_ends(ids, raw).astype("<u4")


def _binaries(data: bytes, cut: np.ndarray) -> pa.Array:
    """Binary values that lie in a row, cut at offsets."""
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(data)])


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _with(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    added = {f.name for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in added] + fields)


def _columns(batch: pa.RecordBatch, names: Iterable[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def encode(
    df: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None, decoded: bool = False
) -> DataFrame:
    """Add ``ids`` (packed little-endian unsigned 32-bit), ``ends`` (their byte ends, packed alike) and ``n_tokens``.

    ``keep`` names the columns that stay (default: all). ``decoded`` adds what ``decode`` would give, in the same pass. Null or empty text: empty ids, zero tokens.
    The vocabulary file is read by the driver and broadcast: its size is that of a vocabulary.
    """
    df = own_session(df)
    kept = [c for c in (keep or df.columns) if c not in ("ids", "ends", "n_tokens", "decoded")]
    names = list(dict.fromkeys([*kept, text]))
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("ends", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = ranks.value
        merges = merges_of(raw)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
            for start, stop in chunks(sizes):
                part = batch.slice(start, stop - start)
                coded, cut = encode_chunk([t or "" for t in part.column(text).to_pylist()], merges)
                # Ends within the chunk, and where each document begins and ends among its bytes.
                ends = _token_ends(coded, raw)
                place = np.concatenate(([0], ends))[cut]
                own = (ends - np.repeat(place[:-1], np.diff(cut))).astype("<u4")
                made = [_binaries(coded.astype("<u4").tobytes(), cut * 4), _binaries(own.tobytes(), cut * 4), pa.array(np.diff(cut), pa.int64())]
                if decoded:
                    made.append(_binaries(decode_ids(coded, ends, raw), place))
                yield pa.RecordBatch.from_arrays(_columns(part, kept) + made, names=[*kept, *(f.name for f in fields)])

    return df.select(*names).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str) -> DataFrame:
    """Replace ``ids`` and ``ends`` of ``encode`` by ``decoded``, the bytes they stand for."""
    df = own_session(df)
    kept = [c for c in df.columns if c not in ("ids", "ends", "decoded")]
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = ranks.value
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("ids")).fill_null(0).to_numpy(zero_copy_only=False)
            for start, stop in chunks(sizes):
                part = batch.slice(start, stop - start)
                both = zip(part.column("ids").to_pylist(), part.column("ends").to_pylist(), strict=True)
                out = [decode_ids(np.frombuffer(i or b"", "<u4"), np.frombuffer(e or b"", "<u4"), raw) for i, e in both]
                yield pa.RecordBatch.from_arrays(
                    _columns(part, [*kept, "ids"]) + [pa.array(out, pa.binary())], names=[*kept, "ids", "decoded"]
                )

    return df.mapInArrow(run, schema)
