"""The byte-level BPE against the reference library, and the round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row

from tidewise.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def raw():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(raw):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(raw), special_tokens={})


def same(texts, raw, library, merges=None):
    for text, got in zip(texts, bpe.encode_texts(texts, merges or bpe.merges_of(raw)), strict=True):
        ids = np.frombuffer(got, "<u4")
        assert ids.tolist() == library.encode_ordinary(text), text[:60]
        assert bpe.decode_ids(ids, bpe.token_ends(ids, raw), raw) == text.encode()


def test_random_texts(raw, library):
    random.seed(5)
    letters = list("ab1'' \n\tstmdrevl!.é٣ 　 ̀😀")
    same(["".join(random.choices(letters, k=random.randint(0, 40))) for _ in range(3000)], raw, library)


def test_every_code_point(raw, library):
    points = [p for p in range(0, 0x110000, 7) if not 0xD800 <= p < 0xE000]
    same(["".join(f"a{chr(p)}1 " for p in points[i : i + 2000]) for i in range(0, len(points), 2000)], raw, library)


def test_odd_texts(raw, library):
    same(["", " ", "\n", "'", "'s", "x's's'll 're''ve", "!" * 5000, "a" * 3000, " " * 300 + "x", "\x00\x00a"], raw, library)


def test_full_cache_starts_anew(raw, library):
    same([f"word{i} other{i}" for i in range(200)], raw, library, bpe.Merges(bpe.parse_ranks(raw), limit=50))


def test_slices_that_share_slots(raw, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLOTS", 2)
    random.seed(7)
    merges = bpe.Merges(bpe.parse_ranks(raw))
    # Lengths around eight and fifteen bytes, and slices that differ by zero bytes at the end only.
    texts = [" ".join("abcdefghijklmnopqrstuvwxyz"[i % 5 : i % 5 + random.randint(1, 18)] for i in range(40)) for _ in range(50)]
    texts += ["\x00" * n for n in range(1, 20)] + ["!" + "\x00" * n for n in range(20)] + ["é" * n for n in range(1, 12)]
    same(texts, raw, library, merges)
    same(texts[::-1], raw, library, merges)


def test_dataframe_keeps_rows_and_columns(spark, raw):
    rows = [Row(doc_id=1, text="it's", ids="x"), Row(doc_id=2, text=None, ids="y"), Row(doc_id=None, text="", ids=None), Row(doc_id=1, text="it's", ids="x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode(df, PATH, decoded=True)
    assert out.columns == ["doc_id", "text", "ids", "ends", "n_tokens", "decoded"]
    got = sorted(((r.doc_id or 0, r.n_tokens, bytes(r.decoded)) for r in out.collect()))
    assert got == [(0, 0, b""), (1, 2, b"it's"), (1, 2, b"it's"), (2, 0, b"")]
    again = bpe.decode(bpe.encode(df, PATH), PATH)
    assert sorted(bytes(r.decoded) for r in again.collect()) == [b"", b"", b"it's", b"it's"]
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, sf_dir, library):
    import hashlib

    from tidewise.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op6_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
