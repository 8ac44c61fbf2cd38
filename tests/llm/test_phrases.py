"""Phrase mining against SQL over the whole tables and a plain count of every phrase."""

import random
import re
from collections import Counter

import duckdb
import pytest
from oracle_check import connect, differences

from tidewise.llm import phrases
from tidewise.llm.queries import ORACLE, QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least: int, top: int = 2000, absorb: int = 80) -> list[tuple]:
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", text or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    often = {key: a for key, a in counts.items() if a >= least}
    out = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        inside = any(
            lang == other and len(longer) > len(words) and 100 * b >= absorb * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in often.items()
        )
        if inside:
            continue
        cuts = [(k, often[lang, words[:k]], often[lang, words[k:]]) for k in range(1, len(words))]
        score, k, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, l, r in cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, i, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, found in out.items()
        for i, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    )


def got(df, **options) -> list[tuple]:
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def corpus(n: int = 120) -> list[tuple]:
    random.seed(3)
    words = ["The", "the", "of", "sea", "é", "Éa", "lll", "x\x0by", "sun", "\xa0k", "rain"]
    rows = [
        (random.choice(["en", "fr", None]), "".join(random.choice(words) + random.choice([" ", " ", "  ", "\t", ". ", "\n"]) for _ in range(random.randint(0, 80))))
        for _ in range(n)
    ]
    rows += [("en", "Red SEA Shore way")] * 9 + [("en", "red sea")] * 2 + [("fr", "a a a a a a")] * 4
    return rows + [("en", None), (None, None), ("en", ""), ("de", "?!. ,"), ("en", "a" * 3000), ("en", "sea " * 4000), ("en", "sea.sun," * 2000)]


@pytest.mark.parametrize("block_bytes,least", [(phrases.BLOCK_BYTES, 5), (300, 5), (300, 2)])
def test_against_plain_count(spark, block_bytes, least):
    rows = corpus(120 if least == 5 else 30)
    df = spark.createDataFrame([(*r, i, "p") for i, r in enumerate(rows)], "lang string, text string, id long, words string").repartition(3)
    assert got(df, least=least, block_bytes=block_bytes) == plain(rows, least)
    assert got(df, least=least, block_bytes=block_bytes, top=3) == plain(rows, least, 3)


def test_columns_and_empty_tables(spark):
    df = spark.createDataFrame([("en", "a b")], "lang string, text string")
    assert phrases.collocations(df).columns == COLUMNS and got(df) == []
    assert got(df.limit(0)) == [] and got(df.withColumn("text", df["text"].substr(1, 0))) == []
    assert got(df, least=1) == [("en", 1, "a b", 1, 1, 1, 2, 1_000_000)]


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 9_223_372_036_854_775_806, 9_223_372_036_854_775_806, 9_223_372_036_854_775_807
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    rule = f"({phrases._long('a')} * {phrases.SCALE}) div ({phrases._long('l')} + {phrases._long('r')})"
    assert df.selectExpr(rule).first()[0] == 2_000_000 * a // (l + r)


def test_long_texts_are_cut_where_pieces_end():
    text = b"ab cd. ef gh, ij" * 50
    parts = list(phrases._parts(text, 60))
    assert b"".join(parts) == text and len(parts) > 5 and all(p[-1:] in b".," for p in parts[:-1])
    assert list(phrases._parts(b"x" * 500, 60)) == [b"x" * 500]


def test_query_matches_sql(spark, sf_dir):
    assert differences(QUERIES["op11_phrases"](spark, sf_dir), connect(sf_dir), ORACLE["op11_phrases"]) == []


def test_sql_against_plain_count():
    rows = corpus(30)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    from tidewise.llm.oracle import phrases_sql

    found = connection.execute(phrases_sql(5, 80, 2000)).fetchall()
    assert sorted(found) == plain(rows, 5)


def test_a_reader_of_blocks_holds_few_of_them(spark, monkeypatch):
    """A file's blocks lie in pieces of some bytes, however much text went into the file: a reader has one piece in memory."""
    from pathlib import Path
    from urllib.parse import unquote, urlparse

    import pyarrow.parquet as pq

    from tidewise.llm import arrays

    rng, groups = random.Random(5), []
    rows = [("en", " ".join(f"w{rng.randrange(3000)}" for _ in range(2000))) for _ in range(40)]

    def watched(df, label, *args, **more):
        table = arrays.stored(df, label, *args, **more)
        if label == "phrases-1":
            for file in table.inputFiles():
                read = pq.ParquetFile(Path(unquote(urlparse(file).path))).metadata
                groups.extend(read.row_group(i).num_rows for i in range(read.num_row_groups))
        return table

    monkeypatch.setattr(arrays, "ROW_GROUP", 1 << 15)
    monkeypatch.setattr(phrases, "stored", watched)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    found, totals = phrases.frequent_phrases(docs, least=1, longest=1, block_bytes=10_000)
    assert totals.first().n == 80_000 and found.count() == len({w for _, text in rows for w in text.split(" ")})
    assert sum(groups) >= 20 and max(groups) <= 4
