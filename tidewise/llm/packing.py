"""Pack token ids into rows of fixed length: best fit, longest pieces first.

Documents are dealt to shards by a hash of the id, about ``SHARD_BYTES`` of text each, and every shard is encoded and
packed by itself, so the packing does not depend on how the input is partitioned and no task holds more than a shard.
A document longer than a row is split into whole rows and a rest; nothing is lost. Pieces go, longest first (ties in
order of id and place), into the open row they leave the least room in. A segment tree over capacities, whose leaves
say how many open rows have exactly that room, finds it in logarithmic time.

A packed row has its ids (padded to the full length in the matrix), cumulative segment lengths starting at 0, and
position ids that start anew with every segment. Null and empty texts give no piece. Rows without an id are packed last;
rows of equal id are separate documents. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import chunks, own_session, pieces
from .bpe import encode_chunk, merges_of, read_ranks

LENGTH = 2048
SHARD_BYTES = 8 << 20
PACKED = (
    "shard int, row int, n_tokens int, doc_ids array<long>, doc_starts array<int>, "
    "cumulative array<int>, ids binary, positions binary"
)


class Capacities:
    """Open rows by the room they have left; finds the least sufficient room."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of least room that is at least ``need``; the newest of equals."""
        node = need + self.size
        if not self.count[node]:
            # Climb until a right neighbour has an open row, then go down to its leftmost.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of piece numbers; pieces are taken longest first and none is longer than ``length``."""
    rows: list[list[int]] = []
    open_rows = Capacities(length)
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = open_rows.take(sizes[piece])
        room, row = found or (length, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(piece)
        if room > sizes[piece]:
            open_rows.add(room - sizes[piece], row)
    return rows


def pack_documents(ids: list[np.ndarray], length: int) -> list[list[tuple[int, int, int]]]:
    """Rows of segments (document, start, stop) that hold every token of every document once."""
    segments = [(d, s, min(s + length, len(x))) for d, x in enumerate(ids) for s in range(0, len(x), length)]
    return [[segments[i] for i in row] for row in best_fit([stop - start for _, start, stop in segments], length)]


def matrix(packed: list[bytes], length: int, pad: int) -> np.ndarray:
    """Packed ids of some rows as one padded matrix."""
    out = np.full((len(packed), length), pad, dtype="<u4")
    for i, ids in enumerate(packed):
        values = np.frombuffer(ids, dtype="<u4")
        out[i, : len(values)] = values
    return out


def _pack(table: pa.Table, vocabulary, length: int) -> pa.Table:
    merges = merges_of(vocabulary.value)
    order = pa.compute.sort_indices(table, sort_keys=[("doc", "ascending"), ("text", "ascending")])
    docs, texts = table.column("doc").take(order).to_pylist(), table.column("text").take(order)
    sizes = pa.compute.binary_length(texts).to_numpy()
    ids: list[np.ndarray] = []
    for start, stop in chunks(sizes):
        coded, cut = encode_chunk(texts.slice(start, stop - start).to_pylist(), merges)
        ids += [coded[i:j] for i, j in zip(cut.tolist(), cut[1:].tolist())]
    shard = table.column("shard")[0].as_py()
    out: list[tuple] = []
    for number, row in enumerate(pack_documents(ids, length)):
        parts = [ids[d][start:stop] for d, start, stop in row]
        lengths = np.array([len(p) for p in parts])
        cumulative = np.concatenate(([0], np.cumsum(lengths)))
        positions = np.concatenate([np.arange(n, dtype="<u4") for n in lengths])
        out.append(
            (
                shard, number, int(cumulative[-1]), [docs[d] for d, _, _ in row], [start for _, start, _ in row],
                cumulative.tolist(), np.concatenate(parts).tobytes(), positions.tobytes(),
            )
        )
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    columns = list(zip(*out)) or [[] for _ in kinds]
    names = ["shard", "row", "n_tokens", "doc_ids", "doc_starts", "cumulative", "ids", "positions"]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pack(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Packed rows: ``shard`` and ``row`` number, the segments' documents and first tokens in them, ``cumulative``
    segment lengths, ``ids`` and ``positions`` (packed little-endian unsigned 32-bit)."""
    docs = own_session(docs)
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).where("text is not null and text != ''")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = pieces(total, SHARD_BYTES)
    vocabulary_bytes = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    # The text takes part in the hash, so that rows without an id or with one id do not all meet in one shard.
    shard = F.pmod(F.xxhash64("doc", F.substring("text", 1, 64), F.length("text")), F.lit(shards)).cast("int")
    dealt = texts.select(shard.alias("shard"), "doc", "text")
    return dealt.groupBy("shard").applyInArrow(lambda table: _pack(table, vocabulary_bytes, length), PACKED)


def write_matrices(packed: DataFrame, path: str, length: int = LENGTH, pad: int = 50256) -> None:
    """Write packed rows as Parquet with ``ids`` and ``positions`` padded to ``length``: a matrix row each.

    Files can be read as matrices without looking at row lengths; ``cumulative`` says where segments and padding begin.
    """

    def run(batches):
        for batch in batches:
            columns = {name: batch.column(batch.schema.get_field_index(name)) for name in batch.schema.names}
            for name, filler in (("ids", pad), ("positions", 0)):
                full = matrix(columns[name].to_pylist(), length, filler)
                columns[name] = pa.array([row.tobytes() for row in full], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    packed.mapInArrow(run, packed.schema).write.parquet(path)
