"""Repair the structure of conversations: the cheapest edits that make the turns ``(s?(ua)+)?``, by Four-Russians tables.

A conversation is its rows by turn (nulls first; rows of one turn by role, then text). A row's first fault counts: *blank*
(nothing but blanks), *duplicate* (role and text seen earlier in the conversation), *truncated* (does not end in ``.!?``).
Edits and their costs: Keep 0, Rerole to user or assistant 1, Delete 2 (blank and duplicate rows must go), Insert an empty
user or assistant row 5; a truncated row that stays adds 5.

What is left to pay after a row depends only on what was written last (nothing, system, user, assistant), so it is a vector
of four costs; less its least one, only a few dozen vectors can occur. A row is one of nine symbols. ``Tables`` holds, for
every such vector and every block of ``BLOCK`` symbols, the vector before the block and what the block adds. A conversation
is worked off from its end, a lookup a block; then from its start each block is expanded backward, from the vector behind
it, and the first edit in ASCII order (D, I, K, R) that stays on a cheapest way is taken: the least of all cheapest audits.

Spark sorts the rows by conversation; a task streams them and holds one symbol for each row of the conversation at hand,
never its texts. Repeated (role, text) are found by an aggregate over digests beforehand. The audit and the digest of a
conversation are single values of its result, so its rows do meet in one task.

Null role and text count as one space, rows of a null id are one conversation, a null turn is part of no gap. Repeated rows
are duplicates. A conversation without rows: zeros and an empty audit. Empty table: no rows. Other columns do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import own_session, stored

# Blanks, closing characters, roles, what edits cost.
BLANKS = " \t\n\x0b\x0c\r"
CLOSING = ".!?"
USER, ASSISTANT = "user", "assistant"
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5

BLOCK = 4
#: What was written last, and the state that the next turn of the alternation leads to.
NOTHING, SYSTEM_LAST, USER_LAST, ASSISTANT_LAST = range(4)
FOLLOWS = (USER_LAST, USER_LAST, ASSISTANT_LAST, USER_LAST)
ENDS = (NOTHING, ASSISTANT_LAST)
#: Symbols: a row's initial (s, u, a or another), the same for truncated rows, one that must go, and none.
INITIALS = "sua"
OTHER, TRUNCATED, GONE, NONE, SYMBOLS = 3, 4, 8, 9, 10

REPORT = {n: "long" for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "string"}
Vector = tuple[int, int, int, int]


def _kept_as(state: int, symbol: int) -> int | None:
    """The state that keeping a row of this symbol leads to, if it may stay as it is."""
    initial = symbol % TRUNCATED
    if initial == 0:
        return SYSTEM_LAST if state == NOTHING else None
    return FOLLOWS[state] if initial == FOLLOWS[state] - 1 else None


def _before(costs: Vector, symbol: int) -> Vector:
    """What is left to pay before a row, from what is left after it."""
    out = list(costs)
    if symbol != NONE:
        stays = STAYS_TRUNCATED if TRUNCATED <= symbol < GONE else 0
        for state in range(4):
            best = DELETE + costs[state]
            if symbol != GONE:
                best = min(best, REROLE + stays + costs[FOLLOWS[state]])
                kept = _kept_as(state, symbol)
                best = best if kept is None else min(best, KEEP + stays + costs[kept])
            out[state] = best
    return _with_inserts(out)


def _with_inserts(costs: list[int]) -> Vector:
    for _ in range(2):
        costs = [min(costs[state], INSERT + costs[FOLLOWS[state]]) for state in range(4)]
    return tuple(costs)


LAST: Vector = _with_inserts([0 if state in ENDS else 2 * INSERT for state in range(4)])


class Tables:
    """For every vector that can occur and every block of symbols: the vector before the block, and the cost it adds."""

    def __init__(self, length: int = BLOCK) -> None:
        self.length = length
        self.vectors: list[Vector] = []
        number: dict[Vector, int] = {}
        steps: list[list[tuple[int, int]]] = []

        def numbered(costs: Vector) -> tuple[int, int]:
            least = min(costs)
            vector = tuple(c - least for c in costs)
            if vector not in number:
                number[vector] = len(self.vectors)
                self.vectors.append(vector)
            return number[vector], least

        self.last, self.added = numbered(LAST)
        while len(steps) < len(self.vectors):
            vector = self.vectors[len(steps)]
            steps.append([numbered(_before(vector, symbol)) for symbol in range(SYMBOLS)])
        one = np.array(steps, dtype=np.int64)
        goes, adds = one[:, :, 0], one[:, :, 1]
        for _ in range(length - 1):
            # A block is a number in base SYMBOLS, its first symbol the highest digit: put one more symbol before all blocks.
            first = np.arange(SYMBOLS)[None, :, None]
            goes, adds = one[goes[:, None, :], first, 0], adds[:, None, :] + one[goes[:, None, :], first, 1]
            goes, adds = goes.reshape(len(one), -1), adds.reshape(len(one), -1)
        self.goes, self.adds = goes, adds

    def audit(self, symbols: bytes) -> tuple[int, str]:
        """The least cost, and of the edits that have it the least in ASCII order."""
        padded = symbols + bytes([NONE]) * (-len(symbols) % self.length)
        rows = np.frombuffer(padded, np.uint8).reshape(-1, self.length).astype(np.int64)
        codes = (rows @ SYMBOLS ** np.arange(self.length - 1, -1, -1)).tolist()
        behind, vector, cost = [0] * len(codes), self.last, self.added
        for i in range(len(codes) - 1, -1, -1):
            behind[i] = vector
            cost += int(self.adds[vector, codes[i]])
            vector = int(self.goes[vector, codes[i]])
        cost += self.vectors[vector][NOTHING]
        state, edits = NOTHING, []
        for i, vector in enumerate(behind):
            block = padded[i * self.length : (i + 1) * self.length]
            left = [self.vectors[vector]]
            for symbol in reversed(block):
                left.append(_before(left[-1], symbol))
            left.reverse()
            for at, symbol in enumerate(block):
                if symbol == NONE:
                    break
                state = self._row(left[at], left[at + 1], symbol, state, edits)
        while state not in ENDS:
            edits.append("I")
            state = FOLLOWS[state]
        return cost, "".join(edits)

    @staticmethod
    def _row(here: Vector, after: Vector, symbol: int, state: int, edits: list[str]) -> int:
        """The edits up to and with one row; the state behind it."""
        stays = STAYS_TRUNCATED if TRUNCATED <= symbol < GONE else 0
        while True:
            if DELETE + after[state] == here[state]:
                edits.append("D")
                return state
            if INSERT + here[FOLLOWS[state]] == here[state]:
                edits.append("I")
                state = FOLLOWS[state]
                continue
            kept = None if symbol == GONE else _kept_as(state, symbol)
            if kept is not None and KEEP + stays + after[kept] == here[state]:
                edits.append("K")
                return kept
            edits.append("R")
            return FOLLOWS[state]


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows of one conversation, across batches; the id is the first column."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    return itertools.groupby(rows, key=lambda row: row[0])


def _report(rows: Iterator[tuple], table: Tables) -> tuple:
    """Counts, cost and audit of one conversation from (id, turn, initial, fault, repeats an earlier turn, copies, digest)."""
    symbols, blank, duplicate, truncated, illegal = bytearray(), 0, 0, 0, 0
    before, same, low, high, turns = None, None, None, None, 0
    for _, turn, role, initial, is_blank, is_cut, again, copies, digest in rows:
        if not copies:
            continue
        if turn is not None:
            low = turn if low is None else low
            turns += turn != high
            high = turn
        for copy in range(copies):
            repeats = again or copy or same == (turn, role, digest)
            same = (turn, role, digest)
            if is_blank:
                blank, symbol = blank + 1, GONE
            elif repeats:
                duplicate, symbol = duplicate + 1, GONE
            else:
                symbol = INITIALS.find(initial) if initial else -1
                symbol = (OTHER if symbol < 0 else symbol) + (TRUNCATED if is_cut else 0)
                truncated += is_cut
            symbols.append(symbol)
            illegal += before is not None and before + initial not in ("su", "ua", "au")
            before = initial
    cost, audit = table.audit(bytes(symbols))
    gaps = 0 if low is None else high - low + 1 - turns
    return gaps, blank, duplicate, truncated, illegal, cost, audit


def _typed(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """The type of the conversation ids, and all batches."""
    first = next(batches, None)
    return (None, iter(())) if first is None else (first.schema.field(0).type, itertools.chain([first], batches))


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, batches = _typed(batches)
    table = tables()
    found = ((key, *_report(rows, table)) for key, rows in _stream(batches))
    for some in itertools.batched(found, 1000):
        columns = list(zip(*some))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", *REPORT])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that the audits leave, in order: (id, position, edit, role, text)."""
    kind, batches = _typed(batches)

    def edited(key, rows: Iterator[tuple]) -> Iterator[tuple]:
        edits, state, at, position = "", NOTHING, 0, 0

        def inserted() -> Iterator[tuple]:
            nonlocal state, at, position
            while at < len(edits) and edits[at] == "I":
                state, at, position = FOLLOWS[state], at + 1, position + 1
                yield key, position, "I", USER if state == USER_LAST else ASSISTANT, ""

        for _, audit, _, role, text, copies in rows:
            if audit is not None:
                edits = audit
            for _ in range(copies):
                yield from inserted()
                edit, at = edits[at], at + 1
                if edit == "D":
                    continue
                state = SYSTEM_LAST if edit == "K" and role[:1] == INITIALS[0] else FOLLOWS[state]
                position += 1
                yield key, position, edit, role if edit == "K" else USER if state == USER_LAST else ASSISTANT, text
        yield from inserted()

    kept = (row for key, rows in _stream(batches) for row in edited(key, rows))
    for some in itertools.batched(kept, 200):
        columns = list(zip(*some))
        arrays = [pa.array(columns[0], kind), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.string()) for c in columns[2:])]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "position", "edit", "role", "text"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, batches = _typed(batches)

    def digest(rows: Iterator[tuple]) -> str:
        hashed, between = hashlib.sha256(), b""
        for *_, role, text in rows:
            hashed.update(between + f"{role}:{text}".encode())
            between = b"\n"
        return hashed.hexdigest()

    for some in itertools.batched(((key, digest(rows)) for key, rows in _stream(batches)), 1000):
        ids, digests = zip(*some)
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """The rows as the operator takes them. ``copies`` names how often each stands there; a conversation of none is still reported."""
    space = F.lit(" ")
    return rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
        (F.lit(1) if copies is None else F.col(copies)).cast("int").alias("copies"),
    )


def report(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``turns``: gaps, faults, illegal neighbours, least cost and audit. It is stored."""
    rows = own_session(rows).withColumn("digest", F.sha2("text", 256))
    seen = rows.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
    seen = stored(seen.where("n > 1").select("conv_id", "role", "digest", "first"), "repair-repeated")
    other = seen.select(*[F.col(c).alias(f"of_{c}") for c in ("conv_id", "role", "digest")], F.col("first.turn").alias("first"), F.lit(True).alias("met"))
    same = F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & (F.col("role") == F.col("of_role")) & (F.col("digest") == F.col("of_digest"))
    again = F.coalesce("met", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    rest = F.rtrim(F.col("text"), F.lit(BLANKS))
    closed = F.right(rest, F.lit(1)).isin(*CLOSING)
    joined = rows.join(other, same, "left").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    narrow = joined.select(
        "conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"), (rest == "").alias("blank"), (~closed).alias("cut"),
        again.alias("again"), "copies", "digest",
    )
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{n} {t}" for n, t in REPORT.items())
    return stored(narrow.mapInArrow(_reports, schema), "repair-report")


def repair(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The rows after the edits of ``report``: conv_id, position (from 1), edit, role and text.

    A conversation's rows lie together in a partition, in order.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    there = rows.where("copies > 0").select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies")
    audits = reports.select(
        "conv_id", "audit", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("copies")
    )
    both = own_session(there).unionByName(audits).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text")
    return ordered.mapInArrow(_repaired, f"conv_id {kind}, position long, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the conversations in ``repair``'s result, as it is: ``role:text`` of its rows by line."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")


def repair_digests(rows: DataFrame) -> DataFrame:
    """``report`` with the digest of each repaired conversation."""
    reports = report(rows)
    found = digests(repair(rows, reports)).withColumnRenamed("conv_id", "of_conv_id")
    joined = reports.join(found, F.col("conv_id").eqNullSafe(F.col("of_conv_id")), "left").drop("of_conv_id")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))
