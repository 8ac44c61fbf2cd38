"""Remove byte strings that already start earlier in the corpus, by a hash-compared suffix sort.

A byte goes when it lies in a ``length``-byte string that also starts earlier (in a document of smaller id, or
earlier in the same one). Matches never cross documents; all strings are judged on the input.

1. *Anchors.* Of the ``ANCHOR``-byte strings in each window of ``length`` bytes, the one of least hash (leftmost of
   equals) is the window's anchor. Equal windows have equal anchors at the same place, so only neighbourhoods of equal
   anchors can hold repeats, and about one position in 35 is an anchor. A scan task keeps the first of equal
   neighbourhoods and sends one packed block per bucket of anchor hashes, so a passage that a third of all documents
   share reaches its bucket once per task.
2. *Equal neighbourhoods* (128 bits of hash) are settled there: all but the first are covered.
3. *Different neighbourhoods of one anchor* are fetched as bytes and their suffixes sorted by a merge sort, in which two
   suffixes compare by the length of their common extension, found by binary search over prefix polynomial hashes.
   Neighbours with an extension of ``length`` are compared byte by byte (a collision of hashes is split there) and form
   a class; all but its earliest suffix mark their bytes.
4. The marked spans of a document are merged, in each task and then over all, and cut out.

Null text counts as empty; documents shorter than ``length`` lose nothing; equal texts are ordered by id. Rows of one id
are one document in that order: of two of them neither is earlier than the other at the same start, so a repeated row
takes nothing from its copy. Rows of one id are told apart by their text. Extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, CHUNK, PrefixHash, chunks, free_name, mix, own_session, pieces, stored

LENGTH = 100
ANCHOR = 32
#: Bytes of text whose anchors meet in one task, and anchors a scan task holds before it sends them on.
BUCKET_BYTES = 12 << 20
HELD = 1 << 18
#: The second, independent hash of a neighbourhood.
BASE2 = 0xD6E8FEB86659FD93

#: ``twin`` is a hash of the row's text, which tells rows of one id apart.
ANCHOR_ROW = np.dtype(
    [("key", "<u8"), ("near", "<u8"), ("doc", "<i8"), ("twin", "<i8"), ("pos", "<i4"), ("left", "u1"), ("right", "u1")]
)
SPAN = np.dtype([("start", "<i4"), ("stop", "<i4")])
ASKED = np.dtype([("key", "<i8"), ("part", "<i4"), ("start", "<i4"), ("stop", "<i4"), ("pos", "<i4")])
FIRST = np.dtype([("hash1", "<i8"), ("hash2", "<i8"), ("doc", "<i8"), ("twin", "<i8"), ("start", "<i4")])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions in a buffer of documents that begin at ``bounds``, their hashes and the hasher."""
    hashed = PrefixHash(data)
    keys = mix(hashed.windows(ANCHOR))
    spread = length - ANCHOR + 1
    lowest = _sliding_min(keys, spread)
    # A window that crosses documents has no say.
    valid = np.zeros(len(lowest), dtype=bool)
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - begin >= length:
            valid[begin : end - length + 1] = True
    # p is an anchor when a valid window in [p - spread + 1, p] has p's hash as its least one.
    reach = np.where(valid, lowest, np.uint64(0))
    padded = np.concatenate((np.zeros(spread - 1, np.uint64), reach, np.zeros(len(keys) - len(lowest), np.uint64)))
    highest = ~_sliding_min(~padded, spread)
    at = np.flatnonzero(highest[: len(keys)] == keys)
    return at, keys[at], hashed


def anchor_rows(texts: list[bytes], docs: np.ndarray, twins: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The anchors of some documents, each with the hash of its neighbourhood: all windows that can have this anchor."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < length:
        return np.empty(0, ANCHOR_ROW)
    at, keys, hashed = anchors(data, bounds, length)
    owner = np.searchsorted(bounds, at, side="right") - 1
    begin, end = bounds[owner], bounds[owner + 1]
    low, high = np.maximum(begin, at - (length - ANCHOR)), np.minimum(end, at + length)
    rows = np.empty(len(at), ANCHOR_ROW)
    second = PrefixHash(data, BASE2)
    # Anchors have the least hashes of their windows; mixed once more they are even, as buckets need them.
    rows["key"], rows["doc"], rows["twin"], rows["pos"] = mix(keys), docs[owner], twins[owner], at - begin
    rows["left"], rows["right"] = at - low, high - at
    sides = rows["left"].astype(np.uint64) << np.uint64(8) | rows["right"]
    rows["near"] = mix(second.slices(low, high) ^ mix(sides))
    return rows


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where any column of sorted rows differs from the row before, and at the first row."""
    out = np.zeros(len(columns[0]), dtype=bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _settle(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of equal neighbourhoods (all that share its id and place), whether its anchor begins here, and the repeated ones."""
    rows = rows[np.lexsort((rows["twin"], rows["pos"], rows["doc"], rows["near"], rows["key"]))]
    key_starts = _changes(rows["key"])
    starts = key_starts | _changes(rows["near"])
    rows_differ = starts | _changes(rows["doc"], rows["pos"], rows["twin"])
    first = rows[np.flatnonzero(starts)][np.cumsum(starts) - 1] if len(rows) else rows
    kept = (rows["doc"] == first["doc"]) & (rows["pos"] == first["pos"])
    return rows[kept & rows_differ], key_starts[kept & rows_differ], rows[~kept]


def _spans(rows: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), SPAN)
    out["start"], out["stop"] = rows["pos"] - rows["left"].astype("<i4"), rows["pos"] + rows["right"].astype("<i4")
    return out


def _merged(doc: np.ndarray, twin: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same bytes of each document in as few spans as cover them, in order."""
    order = np.lexsort((spans["start"], twin, doc))
    doc, twin, spans = doc[order], twin[order], spans[order]
    # Each document's places lie beyond those of the ones before it.
    shift = np.cumsum(_changes(doc, twin)).astype(np.int64) << 32
    reach = np.maximum.accumulate(spans["stop"] + shift)
    begins = np.ones(len(doc), dtype=bool)
    begins[1:] = spans["start"][1:] + shift[1:] > reach[:-1]
    at = np.flatnonzero(begins)
    out = spans[at].copy()
    if len(at):
        out["stop"] = np.append(reach[at[1:] - 1], reach[-1]) - shift[at]
    return doc[at], twin[at], out


def _packed(doc: np.ndarray, twin: np.ndarray, rows: np.ndarray) -> dict[tuple[int, int], bytes]:
    """Rows of each document as bytes."""
    order = np.lexsort((twin, doc))
    doc, twin, rows = doc[order], twin[order], rows[order]
    cut = np.flatnonzero(_changes(doc, twin)).tolist() + [len(doc)]
    return {(int(doc[i]), int(twin[i])): rows[i:j].tobytes() for i, j in zip(cut, cut[1:])}


def _by_document(spans: dict[tuple[int, int], bytes], asked: dict[tuple[int, int], bytes]) -> pa.Table:
    names = list(dict.fromkeys([*spans, *asked]))
    columns = [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64())]
    columns += [pa.array([held.get(n) for n in names], pa.binary()) for held in (spans, asked)]
    return pa.Table.from_arrays(columns, names=["doc_id", "twin", "spans", "asked"])


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def _blocks(rows: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by bucket; ``rows`` are sorted by key, whose high bits choose the bucket."""
    bucket = _bucket(rows["key"], buckets)
    cut = np.flatnonzero(_changes(bucket)).tolist() + [len(rows)]
    for i, j in zip(cut, cut[1:]):
        yield int(bucket[i]), rows[i:j]


def common_extension(hashed: PrefixHash, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes from ``a`` and ``b`` on agree, up to ``most``: a binary search over prefix hashes."""
    low, high = np.zeros(len(a), dtype=np.int64), most.astype(np.int64)
    for _ in range(int(most.max(initial=0)).bit_length()):
        middle = (low + high + 1) >> 1
        same = hashed.slices(a, a + middle) == hashed.slices(b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _order(hashed: PrefixHash, data: np.ndarray, start, limit, x, y) -> np.ndarray:
    """-1, 0 or 1 as suffix x sorts before, with or after suffix y."""
    a, b = start[x], start[y]
    most = np.minimum(limit[x], limit[y])
    same = common_extension(hashed, a, b, most)
    ended = same == most
    last = len(data) - 1
    by_byte = np.sign(data[np.minimum(a + same, last)].astype(np.int16) - data[np.minimum(b + same, last)])
    return np.where(ended, np.sign(limit[x] - limit[y]), by_byte)


def suffix_sort(data: np.ndarray, start: np.ndarray, limit: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort suffixes within groups (members of a group lie together); also each one's extension shared with the one before.

    A bottom-up merge sort over all groups at once: every element finds its rank in the neighbouring run by binary
    search, each probe of which is one hash comparison of logarithmic cost. Extensions are verified byte by byte.
    """
    hashed, n = PrefixHash(data), len(start)
    begins = np.flatnonzero(_changes(group)) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, n))
    base, size = np.repeat(begins, sizes), np.repeat(sizes, sizes)
    order, width = np.arange(n), 1
    while n and width < sizes.max():
        at = np.flatnonzero(size > width)
        local = at - base[at]
        run = local // width
        partner = base[at] + (run ^ 1) * width
        stop = np.minimum(partner + width, base[at] + size[at])
        low, high = np.minimum(partner, stop), stop.copy()
        first, left = low.copy(), run % 2 == 0
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            sign = _order(hashed, data, start, limit, order[middle], order[at[going]])
            right = np.where(left[going], sign < 0, sign <= 0)
            low[going] = np.where(right, middle + 1, low[going])
            high[going] = np.where(right, high[going], middle)
            going = going[low[going] < high[going]]
        merged = order.copy()
        merged[base[at] + (run >> 1) * 2 * width + local % width + (low - first)] = order[at]
        order, width = merged, width * 2
    shared = np.zeros(n, dtype=np.int64)
    inner = np.flatnonzero(base[1:] == base[:-1]) + 1
    x, y = order[inner - 1], order[inner]
    shared[inner] = common_extension(hashed, start[x], start[y], np.minimum(limit[x], limit[y]))
    return order, _verified(data, start[order], shared)


def _verified(data: np.ndarray, start: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Shared extensions cut at the first byte that differs, should two hashes have collided."""
    at = np.flatnonzero(shared)
    for i in range(0, len(at), 1 << 12):
        part = at[i : i + (1 << 12)]
        length = shared[part]
        begin = np.cumsum(length) - length
        step = np.arange(int(length.sum())) - np.repeat(begin, length)
        differs = data[np.repeat(start[part], length) + step] != data[np.repeat(start[part - 1], length) + step]
        if differs.any():
            shared[part] = np.minimum.reduceat(np.where(differs, step, np.repeat(length, length)), begin)
    return shared


def repeated_windows(
    data: np.ndarray,
    anchor: np.ndarray,
    left: np.ndarray,
    right: np.ndarray,
    group: np.ndarray,
    place: np.ndarray,
    length: int = LENGTH,
) -> tuple[np.ndarray, np.ndarray]:
    """For neighbourhoods in order of (group, document, position): which windows repeat an earlier one, and which are first.

    Column k stands for the window that begins ``length - ANCHOR - k`` bytes before the anchor. Two windows are equal
    when the suffixes at the anchor agree to the window's end and the reversed ones to its start, so the classes of
    all windows follow from two suffix sorts. Members of equal ``place`` (rows of one id) are as early as each other.
    """
    n, spread = len(anchor), length - ANCHOR + 1
    forward, agree_right = suffix_sort(data, anchor, right, group)
    reverse = np.ascontiguousarray(data[::-1])
    backward, agree_left = suffix_sort(reverse, len(data) - anchor, left, group)
    breaks = _changes(group)
    repeat, head = np.zeros((n, spread), dtype=bool), np.zeros((n, spread), dtype=bool)
    for k in range(spread):
        before = length - ANCHOR - k
        there = (left >= before) & (right >= length - before)
        classes = []
        for order, agree, depth in ((forward, agree_right, length - before), (backward, agree_left, before)):
            number = np.empty(n, dtype=np.int64)
            number[order] = np.cumsum(breaks | (agree < depth)) - 1
            classes.append(number)
        head[:, k] = there
        for number in classes:
            there = there & (np.bincount(number[there], minlength=n)[number] > 1)
        at = np.flatnonzero(there)
        if not len(at):
            continue
        both = classes[0][at] * n + classes[1][at]
        sort = np.argsort(both, kind="stable")
        starts = _changes(both[sort])
        first = at[sort[np.flatnonzero(starts)]][np.cumsum(starts) - 1]
        later = at[sort][place[at[sort]] != place[first]]
        repeat[later, k] = True
        head[later, k] = False
    return repeat, head


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of marks."""
    padded = np.zeros((marked.shape[0], marked.shape[1] + 2), dtype=np.int8)
    padded[:, 1:-1] = marked
    step = np.diff(padded, axis=1)
    row, first = np.nonzero(step == 1)
    return row, first, np.nonzero(step == -1)[1] - 1


#: Different neighbourhoods of one anchor that are sorted together; larger groups are dealt out and their firsts merged.
GROUP = 4096


def _scan(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """Anchor blocks by bucket, and the neighbourhoods that repeat within what this task holds."""
    held, count = [], 0

    def sent() -> pa.RecordBatch:
        rows, _, repeats = _settle(np.concatenate(held))
        there = dict(_blocks(repeats, buckets))
        mine = dict(_blocks(rows, buckets))
        names = list(mine)
        blocks = [mine[b].tobytes() for b in names]
        done = [there[b].tobytes() if b in there else None for b in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), pa.array(blocks, pa.binary()), pa.array(done, pa.binary())], names=["bucket", "block", "repeats"]
        )

    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).fill_null(b"")
        sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
        docs, twins = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        for start, stop in chunks(sizes):
            rows = anchor_rows(texts.slice(start, stop - start).to_pylist(), docs[start:stop], twins[start:stop], length)
            held.append(rows)
            count += len(rows)
            if count >= HELD:
                yield sent()
                held, count = [], 0
    if count:
        yield sent()


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype=dtype)


MARKS = "doc_id long, twin long, spans binary, asked binary"


def _meet(table: pa.Table, most: int) -> pa.Table:
    """Settle one bucket: a document's spans of repeated neighbourhoods, and those that must be compared as bytes."""
    rows, starts, repeats = _settle(_joined(table.column("block"), ANCHOR_ROW))
    group = np.cumsum(starts) - 1
    sizes = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    rank = np.arange(len(rows)) - np.flatnonzero(starts)[group]
    open_ = sizes[group] > 1
    done = np.concatenate((repeats, _joined(table.column("repeats"), ANCHOR_ROW)))
    # Members of an oversized group are dealt out; the number of its parts is in the part number's sign.
    part = rank[open_] // most
    part = np.where(sizes[group][open_] > most, -1 - part, part)
    asked, spans = np.empty(len(part), ASKED), _spans(rows[open_])
    asked["key"], asked["part"], asked["pos"] = rows["key"][open_].view(np.int64), part, rows["pos"][open_]
    asked["start"], asked["stop"] = spans["start"], spans["stop"]
    return _by_document(
        _packed(*_merged(done["doc"], done["twin"], _spans(done))), _packed(rows["doc"][open_], rows["twin"][open_], asked)
    )


WANTED = np.dtype([("doc", "<i8"), ("twin", "<i8"), *ASKED.descr])


def _fetch(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Cut the asked neighbourhoods out of the texts, packed by bucket of their group."""

    def sent(rows: np.ndarray, cut: list[bytes]) -> pa.RecordBatch:
        mixed = mix(rows["key"].view(np.uint64) ^ mix(rows["part"].astype(np.int64).view(np.uint64)))
        bucket = _bucket(mixed, buckets)
        order = np.argsort(bucket, kind="stable")
        at = np.flatnonzero(_changes(bucket[order])).tolist() + [len(order)]
        pieces_ = [order[i:j] for i, j in zip(at, at[1:])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(bucket[p[0]]) for p in pieces_], pa.int32()),
                pa.array([rows[p].tobytes() for p in pieces_], pa.binary()),
                pa.array([b"".join(map(cut.__getitem__, p.tolist())) for p in pieces_], pa.binary()),
            ],
            names=["bucket", "rows", "bytes"],
        )

    held, cut, size = [], [], 0
    for doc, twin, text, asked in (row for batch in batches for row in zip(*batch.columns, strict=True)):
        found = np.frombuffer(b"".join(block.as_py() for block in asked.values), ASKED)
        mine = np.empty(len(found), WANTED)
        mine["doc"], mine["twin"] = doc.as_py(), twin.as_py()
        for name in ASKED.names:
            mine[name] = found[name]
        data = text.as_buffer().to_pybytes()
        held.append(mine)
        cut.extend(map(data.__getitem__, map(slice, mine["start"].tolist(), mine["stop"].tolist())))
        size += int((mine["stop"] - mine["start"]).sum()) + 64 * len(mine)
        if size >= 8 << 20:
            yield sent(np.concatenate(held), cut)
            held, cut, size = [], [], 0
    if cut:
        yield sent(np.concatenate(held), cut)


FOUND = "doc_id long, twin long, spans binary, part int, firsts binary"


def _compare(table: pa.Table, length: int, buckets: int) -> pa.Table:
    """Sort the suffixes of one bucket's groups: each document's repeated windows, and the firsts of dealt-out groups by bucket."""
    rows, data = _joined(table.column("rows"), WANTED), _joined(table.column("bytes"), np.uint8)
    size = rows["stop"] - rows["start"]
    begin = np.cumsum(size, dtype=np.int64) - size
    order = np.lexsort((rows["twin"], rows["pos"], rows["doc"], rows["part"], rows["key"]))
    rows, begin, size = rows[order], begin[order], size[order]
    groups = np.append(np.flatnonzero(_changes(rows["key"], rows["part"])), len(rows))
    out = []
    # Some whole groups at a time: the sort needs a few dozen bytes for each byte it holds.
    for i, j in chunks(np.add.reduceat(size, groups[:-1]) if len(rows) else size, CHUNK):
        i, j = int(groups[i]), int(groups[j])
        held = np.concatenate([data[a : a + n] for a, n in zip(begin[i:j].tolist(), size[i:j].tolist())])
        out.append(_compare_groups(rows[i:j], held, length))
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, SPAN), np.zeros(0, FIRST))
    doc, twin, spans, firsts = (np.concatenate([none, *(o[k] for o in out)]) for k, none in enumerate(empty))
    packed = _packed(*_merged(doc, twin, spans))
    bucket = _bucket(mix(firsts["hash1"].view(np.uint64)), buckets)
    firsts = firsts[np.argsort(bucket, kind="stable")]
    bucket = np.sort(bucket)
    cut = np.flatnonzero(_changes(bucket)).tolist() + [len(bucket)]
    parts = [(int(bucket[i]), firsts[i:j].tobytes()) for i, j in zip(cut, cut[1:])]
    none, nothing = [None] * len(packed), [None] * len(parts)
    columns = [
        pa.array([d for d, _ in packed] + nothing, pa.int64()),
        pa.array([t for _, t in packed] + nothing, pa.int64()),
        pa.array(list(packed.values()) + nothing, pa.binary()),
        pa.array(none + [b for b, _ in parts], pa.int32()),
        pa.array(none + [f for _, f in parts], pa.binary()),
    ]
    return pa.Table.from_arrays(columns, names=["doc_id", "twin", "spans", "part", "firsts"])


def _compare_groups(rows: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Documents, twins and spans that repeat in some groups, and the first windows of dealt-out groups."""
    size = rows["stop"] - rows["start"]
    begin = np.cumsum(size, dtype=np.int64) - size
    group = np.cumsum(_changes(rows["key"], rows["part"]))
    place = np.cumsum(_changes(group, rows["doc"], rows["pos"]))
    left, right = (rows["pos"] - rows["start"]).astype(np.int64), (rows["stop"] - rows["pos"]).astype(np.int64)
    repeat, head = repeated_windows(data, begin + left, left, right, group, place, length)
    origin = rows["pos"] - (length - ANCHOR)
    row, first, last = _runs(repeat)
    spans = np.empty(len(row), SPAN)
    spans["start"], spans["stop"] = origin[row] + first, origin[row] + last + length
    split, column = np.nonzero(head & (rows["part"] < 0)[:, None])
    firsts = np.empty(len(split), FIRST)
    if len(split):
        at = begin[split] + left[split] - (length - ANCHOR) + column
        firsts["hash1"], firsts["hash2"] = (PrefixHash(data, base).slices(at, at + length).view(np.int64) for base in (BASE, BASE2))
        firsts["doc"], firsts["twin"], firsts["start"] = rows["doc"][split], rows["twin"][split], origin[split] + column
    return rows["doc"][row], rows["twin"][row], spans, firsts


def _later(table: pa.Table, length: int) -> pa.Table:
    """Each document's windows that are not the first of their hashes, of one bucket of dealt-out groups' firsts."""
    rows = _joined(table.column("firsts"), FIRST)
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["hash2"], rows["hash1"]))]
    starts = _changes(rows["hash1"], rows["hash2"])
    first = rows[np.flatnonzero(starts)][np.cumsum(starts) - 1] if len(rows) else rows
    rows = rows[(rows["doc"] != first["doc"]) | (rows["start"] != first["start"])]
    spans = np.empty(len(rows), SPAN)
    spans["start"], spans["stop"] = rows["start"], rows["start"] + length
    return _by_document(_packed(*_merged(rows["doc"], rows["twin"], spans)), {}).drop_columns("asked")


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    merged: list[list[int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([start, stop])
    at, kept = 0, []
    for start, stop in merged:
        kept.append(text[at:start])
        at = stop
    return b"".join([*kept, text[at:]]), [(a, b) for a, b in merged]


def repeat_spans(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP
) -> DataFrame:
    """Packed spans (doc_id, twin, spans) of bytes that repeat; a document's may overlap and lie in several rows.

    ``twin`` is ``xxhash64`` of the row's text; ``spans`` are pairs of 32-bit start and stop.
    """
    if not 2 * ANCHOR <= length <= 200:
        raise ValueError(f"length must be {2 * ANCHOR} to 200")
    content = F.col(text).cast("string")
    texts = own_session(docs).select(F.col(id_column).cast("long").alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("twin"))
    texts = texts.where("doc_id is not null")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = pieces(total, BUCKET_BYTES)
    blocks = texts.mapInArrow(lambda it: _scan(it, buckets, length), "bucket int, block binary, repeats binary")
    marks = stored(blocks.groupBy("bucket").applyInArrow(lambda t: _meet(t, group), MARKS), "suffix-marks")
    asked = marks.where(F.col("asked").isNotNull()).groupBy("doc_id", "twin").agg(F.collect_list("asked").alias("asked"))
    # One of identical rows is enough: the spans found are theirs alike.
    wanted = texts.join(asked, ["doc_id", "twin"]).select("doc_id", "twin", "text", "asked")
    cuts = wanted.mapInArrow(lambda it: _fetch(it, buckets), "bucket int, rows binary, bytes binary")
    found = stored(cuts.groupBy("bucket").applyInArrow(lambda t: _compare(t, length, buckets), FOUND), "suffix-found")
    firsts = found.where(F.col("firsts").isNotNull()).select("part", "firsts")
    later = firsts.groupBy("part").applyInArrow(lambda t: _later(t, length), "doc_id long, twin long, spans binary")
    spans = [source.where(F.col("spans").isNotNull()).select("doc_id", "twin", "spans") for source in (marks, found)]
    return spans[0].unionByName(spans[1]).unionByName(later)


CUT = "spans array<struct<start:int,stop:int>>, kept {}, n_bytes long, n_removed long"


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, as_text: bool = False
) -> DataFrame:
    """Add ``spans`` (maximal removed runs), ``kept`` (the remaining bytes), ``n_bytes`` and ``n_removed`` to every row.

    Columns of these names are replaced. Rows without an id lose nothing. With ``as_text``, ``kept`` is text: what
    is left of a character that was cut apart goes too.
    """
    added = ["spans", "kept", "n_bytes", "n_removed"]
    others = [c for c in docs.columns if c not in added]
    found, twin, doc = (free_name(docs, n) for n in ("found", "twin", "doc"))
    spans = (
        repeat_spans(docs, id_column, text, length)
        .groupBy(F.col("doc_id").alias(doc), F.col("twin").alias(twin))
        .agg(F.collect_list("spans").alias(found))
    )
    rows = own_session(docs).select(*others)
    same = (rows[id_column].cast("long") == F.col(doc)) & (F.xxhash64(rows[text].cast("string")) == F.col(twin))
    joined = rows.join(spans, same, "left").drop(doc, twin)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields if f.name != found] + [CUT.format("string" if as_text else "binary")])

    def marks(blocks: list[bytes] | None) -> list[tuple[int, int]]:
        held = np.frombuffer(b"".join(blocks or ()), SPAN)
        return list(zip(held["start"].tolist(), held["stop"].tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(text).cast(pa.binary())).fill_null(0).to_numpy(zero_copy_only=False)
            for first, last in chunks(sizes):
                part = batch.slice(first, last - first)
                texts = [t or b"" for t in part.column(text).cast(pa.binary()).to_pylist()]
                cut = [_cut(t, marks(m)) for t, m in zip(texts, part.column(found).to_pylist(), strict=True)]
                columns = [part.column(c) for c in others] + [
                    pa.array([[{"start": a, "stop": b} for a, b in m] for _, m in cut], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                    pa.array([k.decode("utf-8", "ignore") for k, _ in cut], pa.string()) if as_text else pa.array([k for k, _ in cut], pa.binary()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(t) - len(k) for t, (k, _) in zip(texts, cut)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=others + added)

    return joined.mapInArrow(run, schema)
