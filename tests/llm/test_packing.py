"""Packing: every token once, best fit as a plain search does it, files that read back."""

import random

import numpy as np
import public_tokenizers

from tidewise.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def plain(sizes, length):
    rows, room = [], []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in range(len(rows)) if room[r] >= sizes[piece]]
        if fits:
            least = min(room[r] for r in fits)
            row = [r for r in fits if room[r] == least]
        else:
            rows.append([])
            room.append(length)
            row = [len(rows) - 1]
        rows[row[-1]].append(piece)
        room[row[-1]] -= sizes[piece]
    return rows


def test_best_fit_leaves_as_little_as_a_plain_search():
    random.seed(2)
    for _ in range(60):
        length = random.choice([1, 7, 8, 64, 100])
        sizes = [random.randint(1, length) for _ in range(random.randint(0, 80))]
        rows = packing.best_fit(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= length for r in rows)
        assert sorted(sum(sizes[i] for i in r) for r in rows) == sorted(sum(sizes[i] for i in r) for r in plain(sizes, length))


def rebuild(rows) -> dict:
    """Tokens of each document from packed rows."""
    parts = {}
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == r.n_tokens == r.cumulative[-1]
        for doc, start, a, b in zip(r.doc_ids, r.doc_starts, r.cumulative, r.cumulative[1:]):
            parts.setdefault(doc, []).append((start, ids[a:b].tolist()))
            assert positions[a:b].tolist() == list(range(b - a))
    return {d: sum((p for _, p in sorted(v)), []) for d, v in parts.items()}


def test_documents_come_back_whole(spark, tmp_path):
    texts = {1: "a b c " * 50, 2: "long " * 900, 3: "", 4: None, 5: "x", 6: "long " * 900}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, row int")
    packed = packing.pack(df, PATH, length=128)
    rows = packed.collect()
    merges = bpe.merges_of(bpe.read_ranks(PATH))
    expected = {i: np.frombuffer(bpe.encode_texts([t], merges)[0], "<u4").tolist() for i, t in texts.items() if t}
    assert rebuild(rows) == expected
    assert all(r.n_tokens <= 128 for r in rows) and sum(r.n_tokens < 128 for r in rows) <= 2
    packing.write_matrices(packed, str(tmp_path / "m"), length=128, pad=7)
    written = spark.read.parquet(str(tmp_path / "m")).collect()
    for r in written:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 128 and (ids[r.n_tokens :] == 7).all()
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_rows_without_an_id(spark):
    df = spark.createDataFrame([(None, "one two"), (None, "three"), (1, "one two")], "doc_id long, text string")
    assert sum(len(r.doc_ids) for r in packing.pack(df, PATH).collect()) == 3


def test_query_holds_every_token(spark, sf_dir):
    from tidewise.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = {r.doc_id: r.n_tokens for r in bpe.encode(docs, PATH).collect() if r.n_tokens}
    got = {}
    for r in QUERIES["op9_packing"](spark, sf_dir).collect():
        for doc, a, b in zip(r.doc_ids, r.cumulative, r.cumulative[1:]):
            got[doc] = got.get(doc, 0) + b - a
    assert got == counts
