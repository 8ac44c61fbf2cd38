"""Suffix dedup against a plain scan over all strings."""

import hashlib
import random

import numpy as np
import pytest

from tidewise.llm import suffix


def plain(rows: list[tuple[int, bytes]], length: int = 100, by_text: bool = False) -> dict:
    """Kept bytes and removed runs of each document."""
    first: dict[bytes, tuple[int, int]] = {}
    for doc, text in rows:
        for at in range(len(text) - length + 1):
            window = text[at : at + length]
            first[window] = min((doc, at), first.get(window, (doc, at)))
    out = {}
    for doc, text in rows:
        gone = np.zeros(len(text), dtype=bool)
        for at in range(len(text) - length + 1):
            if first[text[at : at + length]] < (doc, at):
                gone[at : at + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0])))).reshape(-1, 2)
        out[(doc, text) if by_text else doc] = bytes(np.frombuffer(text, np.uint8)[~gone]), [tuple(e) for e in edges.tolist()]
    return out


def got(df, **options) -> dict[int, tuple[bytes, list[tuple[int, int]]]]:
    out = suffix.remove_repeats(df, **options).collect()
    return {r.doc_id: (bytes(r.kept), [(s.start, s.stop) for s in r.spans]) for r in out}


def word(n: int) -> str:
    return "".join(random.choices("abcdefg ", k=n))


def documents() -> list[tuple[int, str | None]]:
    random.seed(11)
    shared, line = word(400), word(130)
    texts = [word(random.randint(0, 300)) + shared[random.randint(0, 150) : random.randint(200, 400)] + word(50) for _ in range(40)]
    texts += [line + "\n" + word(20) + line for _ in range(10)] + [word(99), "é" * 60, "é" * 60, "a" * 700, "ab" * 400, "", None]
    texts += [texts[3], texts[3][:-1] + "#", (line[:80] + "x" + line[81:]) * 2]
    return list(enumerate(texts))


@pytest.mark.parametrize("group", [suffix.GROUP, 3])
def test_against_plain_scan(spark, group):
    rows = documents()
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = {}
    for r in suffix.repeat_spans(df, group=group).collect():
        spans.setdefault(r.doc_id, []).extend(np.frombuffer(r.spans, suffix.SPAN).tolist())
    expected = plain([(d, (t or "").encode()) for d, t in rows])
    for doc, text in rows:
        assert suffix._cut((text or "").encode(), spans.get(doc, [])) == expected[doc], doc


@pytest.mark.parametrize("group", [suffix.GROUP, 3])
def test_repeated_rows_take_nothing_from_each_other(spark, group):
    """Rows of one id, of equal and of different text, with passages they share with others."""
    random.seed(5)
    shared, own = word(300), word(400)
    rows = [(i, word(40) + shared[i * 10 : i * 10 + 180] + word(20)) for i in range(8)]
    rows += [(20, own), (20, own), (20, own + "!"), (20, "x" + own), (20, shared), (21, own), (21, own), (3, rows[3][1]), (4, rows[4][1] + shared)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = {}
    for r in suffix.repeat_spans(df, group=group).join(df.selectExpr("doc_id", "text", "xxhash64(text) twin").distinct(), ["doc_id", "twin"]).collect():
        spans.setdefault((r.doc_id, r.text.encode()), []).extend(np.frombuffer(r.spans, suffix.SPAN).tolist())
    expected = plain([(d, t.encode()) for d, t in rows], by_text=True)
    for doc, text in rows:
        assert suffix._cut(text.encode(), spans.get((doc, text.encode()), [])) == expected[doc, text.encode()], doc
    out = suffix.remove_repeats(df).collect()
    assert sorted((r.doc_id, r.text, bytes(r.kept)) for r in out) == sorted((d, t, expected[d, t.encode()][0]) for d, t in rows)
    assert all(r.n_removed == 0 for r in out if r.doc_id == 20 and r.text == own)


def test_names_of_extra_columns_do_not_clash(spark):
    text = word(200)
    names = ["_doc", "_twin", "_found", "_DOC_", "twin", "spans", "part", "bucket"]
    rows = [(1, text, *names), (2, text, *names)]
    out = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)))
    assert [n for n in names if n != "spans"] == out.columns[2:9]
    assert {(r.doc_id, r.n_removed, r._twin) for r in out.collect()} == {(1, 0, "_twin"), (2, 200, "_twin")}


def test_the_callers_session_stays(spark):
    before = spark.conf.getAll
    suffix.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect()
    assert spark.conf.getAll == before


def test_rows_and_columns_stay(spark):
    text = word(150)
    rows = [(2, text, "a"), (1, text, None), (3, None, "c"), (None, text, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = suffix.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "spans", "kept", "n_bytes", "n_removed"]
    assert {(r.doc_id, r.n_removed) for r in out.collect()} == {(1, 0), (2, 150), (3, 0), (None, 0)}
    assert suffix.remove_repeats(df.limit(0)).count() == 0


def test_suffixes_sort_within_groups():
    random.seed(2)
    data = bytes(random.choices(b"ab", k=3000))
    draw = np.random.default_rng(0)
    start, limit, group = np.sort(draw.integers(0, 2900, 500)), draw.integers(0, 100, 500), np.sort(draw.integers(0, 20, 500))
    order, shared = suffix.suffix_sort(np.frombuffer(data, np.uint8), start, limit, group)
    key = [(group[i], data[start[i] : start[i] + limit[i]]) for i in order]
    assert key == sorted(key)
    for (g, x), (h, y), n in zip(key, key[1:], shared[1:]):
        if g == h:
            assert n == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_query_against_plain_scan(spark, sf_dir):
    from tidewise.llm.queries import QUERIES

    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = plain(rows)
    result = QUERIES["op8_suffix_dedup"](spark, sf_dir).collect()
    assert len(result) == len(rows)
    for r in result:
        kept, runs = expected[r.doc_id]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (r.n_bytes - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
