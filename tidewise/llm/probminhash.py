"""Near-duplicate classes by ProbMinHash over weighted word shingles, banding and verification.

A document is the bag of its five-word shingles (lower case, split on white space; a text of one to four words is one
shingle), a shingle's weight is how often it occurs. Similarity is the probability Jaccard index of two bags. Every
shingle sends arrivals of a Poisson process whose rate is its weight to random registers; a register keeps its earliest
arrival, and a shingle stops as soon as its next arrival comes after the latest register of its document. Registers of
two documents agree with probability equal to their similarity.

Equal texts are classed first, by hash. Of every other bucket of equal bands, each member is first compared with the
bucket's smallest document, never all with all. Only buckets that then still hold several components go on: their
members' registers, one byte each, are compared in blocks of bounded size, inside a task; a pair is looked at in the
first bucket it shares. If its registers agree in ``ESTIMATE`` or more and no link so far joins the two, it is verified
there, on the bags that came along. So a block sends on the links of a forest, fewer than it has members, and every pair
that it looked at is joined by links or was found unlike. Every link is verified on the bags. Classes are the connected
components.

Null and empty texts have no shingles and are classes of their own; rows without an id have a null class; rows of equal
id are one document. Extra columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import PrefixHash, chunks, free_name, mix, own_session, pieces, stored, uniform

WORDS = 5
SIMILARITY = 0.8
#: 32 bands of 8 registers: a pair of similarity 0.8 shares a band with probability 0.997, one of 0.5 with 0.12.
BANDS, ROWS = 32, 8
IDENTITY_BITS = 50
#: So many further registers only serve to estimate. All together stray from a similarity of 0.8 by 0.018 (one deviation).
FURTHER = 256
#: At ESTIMATE, 4.5 deviations lower, banding alone decides which pairs are found.
ESTIMATE = 0.72
#: Members of a bucket, or of one of its blocks, that are compared with each other at once, and bytes of bags in a call.
BLOCK = 1024
CALL_BYTES = 8 << 20


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode()


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every shingle occurrence of some normalised texts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    gap = (data == 32) | (data == 10)
    start = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    end = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(bounds, start, side="right")
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    last = np.append(first[1:], len(start)) - 1
    short = last - first + 1 < words
    whole = np.flatnonzero(owner[words - 1 :] == owner[: len(owner) - words + 1]) if len(start) >= words else np.zeros(0, np.int64)
    left, right = np.concatenate((whole, first[short])), np.concatenate((whole + words - 1, last[short]))
    return owner[left], mix(PrefixHash(data).slices(start[left], end[right]))


def bags(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, shingle and weight of the distinct shingles of some normalised texts, in order of owner and shingle."""
    if len(texts) >= 1 << (64 - IDENTITY_BITS):
        raise ValueError("too many texts at once")
    owner, hashed = shingles(texts, words)
    keys = np.sort(owner.astype(np.uint64) << np.uint64(IDENTITY_BITS) | hashed >> np.uint64(64 - IDENTITY_BITS))
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    weight = np.diff(np.append(starts, len(keys)))
    keys = keys[starts]
    return (keys >> np.uint64(IDENTITY_BITS)).astype(np.int64), keys & np.uint64((1 << IDENTITY_BITS) - 1), weight


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, documents: int, registers: int) -> np.ndarray:
    """The earliest element of every register of every document; documents without elements keep zeros."""
    earliest = np.full(documents * registers, np.inf)
    winner = np.zeros(documents * registers, dtype=np.uint64)
    clock = np.zeros(len(element))
    active, arrived = np.arange(len(element)), 0
    while len(active):
        # Single arrivals at first; what is still active then has few fellows, so many arrivals cost little.
        several = 1 if arrived < 8 else 64
        number = np.arange(arrived + 1, arrived + several + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        draw = mix(element[active][:, None] * np.uint64(0x9FB21C651E98DF25) ^ number[None, :])
        times = clock[active][:, None] + np.cumsum(-np.log(uniform(draw)), axis=1) / weight[active][:, None]
        register = ((mix(draw) >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        slot = (owner[active][:, None] * registers + register.astype(np.int64)).ravel()
        flat = times.ravel()
        np.minimum.at(earliest, slot, flat)
        hit = np.flatnonzero(earliest[slot] == flat)
        winner[slot[hit]] = element[active][hit // several]
        clock[active] = times[:, -1]
        latest = earliest.reshape(documents, registers).max(axis=1)
        active = active[times[:, -1] < latest[owner[active]]]
        arrived += several
    return winner.reshape(documents, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band and document."""
    rows = signature.shape[1] // bands
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(56), (len(signature), bands)).copy()
    for i in range(rows):
        key = mix(key ^ signature[:, i::rows][:, :bands])
    return key.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Probability Jaccard index of two bags given as sorted arrays in which an element occurs as often as it weighs."""
    x, p = np.unique(a, return_counts=True)
    y, q = np.unique(b, return_counts=True)
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = y[at] == x
    shared = int(common.sum())
    if not shared:
        return 0.0
    if len(x) == len(a) and len(y) == len(b):
        return shared / (len(x) + len(y) - shared)
    # For a common element of ratio r = p/q, the others weigh max(p'/p, q'/q): p'/p from ratio r up, q'/q below it.
    p_common, q_common = p[common], q[at[common]]
    ratio = p_common / q_common
    order = np.argsort(ratio, kind="stable")
    from_up = np.cumsum(p_common[order][::-1])[::-1] + (len(a) - p_common.sum())
    below = np.concatenate(([0], np.cumsum(q_common[order])[:-1])) + (len(b) - q_common.sum())
    return float((1.0 / (from_up / p_common[order] + below / q_common[order])).sum())


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        for start, stop in chunks(sizes, 2 << 20):
            texts = [normal(t) for t in batch.column(1).slice(start, stop - start).to_pylist()]
            owner, element, weight = bags(texts)
            registers = signatures(owner, element, weight, len(texts), BANDS * ROWS + FURTHER)
            keys = band_keys(registers[:, : BANDS * ROWS])
            there = np.bincount(owner, minlength=len(texts)) > 0
            offsets = np.concatenate(([0], np.cumsum(there * BANDS)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, stop - start),
                    pa.array([hashlib.blake2b(t, digest_size=16).digest() if t else None for t in texts], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[there].ravel())),
                    pa.array([row.tobytes() for row in (registers >> np.uint64(8)).astype(np.uint8)], pa.binary()),
                ],
                names=["doc", "same", "bands", "registers"],
            )


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        for start, stop in chunks(sizes, 2 << 20):
            texts = [normal(t) for t in batch.column(1).slice(start, stop - start).to_pylist()]
            owner, element, weight = bags(texts)
            values = np.repeat((element >> np.uint64(IDENTITY_BITS - 32)).astype("<u4"), weight)
            cut = np.concatenate(([0], np.cumsum(np.bincount(owner, weights=weight, minlength=len(texts)).astype(np.int64)))).tolist()
            packed = [values[i:j].tobytes() for i, j in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(packed, pa.binary())], names=["doc", "bag"])


def _verify(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bag = [[np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(i)] for i in (2, 3)]
        linked = [similarity(a, b) >= least for a, b in zip(*bag, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def components(links: DataFrame) -> DataFrame:
    """(doc, component) of every document in ``links`` (a, b): smallest labels spread and are followed to their own label."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b"), "links")
    labels = stored(both.groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("label")).withColumn("label", F.least("doc", "label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["doc"]).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["doc"] == near["a"]).select("doc", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        onward = spread.select(F.col("doc").alias("at"), F.col("to").alias("onward"))
        jumped = spread.join(onward, spread["to"] == onward["at"]).select("doc", F.least("to", "onward").alias("label"), "was")
        labels = stored(jumped, "labels")
        if not labels.where("label < was").limit(1).count():
            return labels.select("doc", F.col("label").alias("component"))


def _check(pairs: DataFrame, bag: DataFrame, least: float) -> DataFrame:
    """Verify pairs (a, b) on the bags of their texts."""
    pairs = stored(pairs, "pairs")
    left = pairs.join(bag.toDF("a", "bag_a").hint("merge"), "a")
    full = left.join(bag.toDF("b", "bag_b").hint("merge"), "b").select("a", "b", "bag_a", "bag_b")
    return stored(full.mapInArrow(lambda it: _verify(it, least), "a long, b long, linked boolean"), "verified")


def _near_links(table: pa.Table, least: float) -> pa.Table:
    """Verified links between components, a forest of each bucket block of one call."""
    key, low, high = (table.column(c).to_numpy() for c in ("key", "low", "high"))
    doc, component, block = (table.column(c).to_numpy() for c in ("doc", "component", "block"))
    registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint8).reshape(len(doc), -1)
    bands = np.stack(table.column("bands").to_numpy())
    bags_ = [np.frombuffer(x.as_buffer(), "<u4") for x in table.column("bag")]
    order = np.lexsort((doc, high, low, key))
    change = (np.diff(key[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
    need = ESTIMATE * registers.shape[1]
    found: set[tuple[int, int]] = set()
    for members in np.split(order, np.flatnonzero(change) + 1):
        name: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := name.get(x, x)) != x:
                x = name[x] = name.get(up, up)
            return x

        for at, x in enumerate(members[:-1].tolist()):
            others = members[at + 1 :]
            others = others[component[others] != component[x]]
            if low[x] != high[x]:
                others = others[block[others] != block[x]]
            same = (registers[others] == registers[x]).sum(axis=1)
            likeliest = np.argsort(-same, kind="stable")
            others = others[likeliest[same[likeliest] >= need]]
            shared = (bands[others] == bands[x]).argmax(axis=1)
            for y in others[bands[x][shared] == key[x]].tolist():
                p, q = root(int(component[x])), root(int(component[y]))
                if p != q and similarity(bags_[x], bags_[y]) >= least:
                    name[max(p, q)] = min(p, q)
                    found.add((int(min(doc[x], doc[y])), int(max(doc[x], doc[y]))))
    pairs = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def near_classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(doc, class) for every distinct non-null id: the smallest id of its class of near copies."""
    docs = own_session(docs)
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).where("doc is not null")
    base = stored(texts.mapInArrow(_scan, "doc long, same binary, bands array<long>, registers binary"), "signatures")
    shown = base.where("same is not null")
    firsts = shown.groupBy("same").agg(F.min("doc").alias("first"))
    members = base.join(firsts, "same", "left").select("doc", F.coalesce("first", "doc").alias("first")).distinct()
    once = shown.groupBy("same").agg(F.min("doc").alias("doc")).select("doc", "same")
    # Rows of one id may differ in text; the id's first text in order of hash stands for it.
    distinct = shown.join(once, ["doc", "same"], "left_semi").groupBy("doc").agg(F.min(F.struct("same", "bands", "registers")).alias("it"))
    signed = stored(distinct.select("doc", "it.bands", "it.registers"), "signed")
    rows = signed.select("doc", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("hub")).where("n > 1")
    rows = stored(rows.join(buckets, "key"), "full-buckets")
    needed = rows.select("doc").distinct()
    # By merge at every size: a plan that only changes with the size cannot be tested small.
    bagged = texts.join(needed.hint("merge"), "doc", "left_semi").mapInArrow(_bag_rows, "doc long, bag binary")
    bag = stored(bagged, "bags")

    hub = rows.where("doc != hub").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()
    links = _check(hub, bag, least).where("linked").select("a", "b")
    component = components(links)
    named = rows.where("n > 2").select("key", "doc", "n").join(component, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    mixed = named.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p < q").select("key")
    parts = F.ceil(F.col("n") / block).cast("int")
    dealt = named.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("doc"), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select("key", "doc", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    dealt = dealt.join(signed.select("doc", "registers", "bands"), "doc").join(bag, "doc")
    dealt = stored(dealt, "open-buckets")
    # Small buckets share a call, about BLOCK rows each time; a pair of blocks of a large one has its own.
    size = dealt.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("bag")), F.lit(0))).first()
    calls = max(pieces(size[0], block), pieces(size[1], CALL_BYTES))
    call = F.pmod(F.xxhash64("key", "low", "high"), F.lit(calls)).cast("int")
    near = dealt.withColumn("call", call).groupBy("call").applyInArrow(lambda table: _near_links(table, least), "a long, b long")
    component = components(links.unionByName(stored(near, "near-links")))
    return members.join(component, members["first"] == component["doc"], "left").select(members["doc"], F.coalesce("component", "first").alias("class"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Add ``class_id`` to every row: the smallest id of its class; null where the id is null."""
    classes = near_classes(docs, id_column, text, least)
    kept, doc = docs.drop("class_id"), free_name(docs, "doc")
    joined = kept.join(classes.toDF(doc, "class_id"), kept[id_column].cast("long") == F.col(doc), "left")
    return joined.drop(doc)


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The row of smallest id of each class, once; rows without an id stay."""
    firsts = near_classes(docs, id_column, text, least).where(F.col("doc") == F.col("class")).select("doc")
    there = docs.where(F.col(id_column).isNotNull())
    kept = there.join(firsts, there[id_column].cast("long") == firsts["doc"], "left_semi").dropDuplicates([id_column])
    return kept.unionByName(docs.where(F.col(id_column).isNull()))
