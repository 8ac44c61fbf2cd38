"""The pipeline, stage by stage, against plain versions of each."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import functions as F
from test_probminhash import classes
from test_suffix import plain

import corpus_pipeline as pipeline
from tidewise.llm import bpe, mixing
from tidewise.llm.oracle import mixing_sql
from tidewise.llm.queries import EPOCHS, SEED, VOCABULARY, WEIGHTS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The documents before the first stage and after each, and the folder they lie in."""
    root = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(10_001, "", "en", "s", 0), (10_002, None, None, None, None), (10_003, "12345 $$$", "en", "s", 9), (10_004, "word", None, None, 4)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = {"input": docs}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = out[name] = spark.read.parquet(f"{root}/{name}")
    return out, root


def texts(df) -> dict:
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages):
    found, _ = stages
    assert [name for name, _ in pipeline.STAGES] == list(found)[1:]
    assert all(found[name].columns == COLUMNS for name, _ in pipeline.STAGES[:-1])


def test_language_id_drops_what_has_no_language(stages):
    found, _ = stages
    before, after = texts(found["input"]), texts(found["language_id"])
    assert after.items() <= before.items()
    assert set(before) - set(after) == {10_001, 10_002, 10_003}


def test_one_document_of_each_class_stays(stages):
    found, _ = stages
    before, after = texts(found["language_id"]), texts(found["near_dedup"])
    assert set(after) == set(classes(list(before.items())).values()) and after.items() <= before.items()


def test_repeated_passages_go(stages):
    found, _ = stages
    before = {i: (t or "").encode() for i, t in texts(found["near_dedup"]).items()}
    expected = {i: kept.decode("utf-8", "ignore") for i, (kept, _) in plain(list(before.items())).items()}
    got = {r.doc_id: r for r in found["suffix_dedup"].collect()}
    assert {i: r.text for i, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_mixture_is_what_sql_selects(stages):
    found, root = stages
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{root}/suffix_dedup/*.parquet')")
    rows = connection.execute(mixing_sql(pipeline.MIX_BUDGET, WEIGHTS, EPOCHS, SEED)).fetchall()
    assert Counter(r.doc_id for r in found["mixing"].collect()) == Counter(r[0] for r in rows)


def test_mixture_passes_no_more_words_than_its_budget(stages):
    found, root = stages
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{root}/suffix_dedup/*.parquet')")
    rows = connection.execute(f"SELECT doc_id, lang, source, take_tokens FROM ({mixing_sql(pipeline.MIX_BUDGET, WEIGHTS, EPOCHS, SEED)})").fetchall()
    before, got = texts(found["suffix_dedup"]), found["mixing"].collect()
    assert Counter((r.doc_id, len(r.text.split())) for r in got) == Counter((i, n) for i, _, _, n in rows)
    owed, kept = Counter(), Counter()
    for _, lang, source, n in rows:
        owed[lang, source] += n
    for r in got:
        kept[r.lang, r.source] += len(r.text.split())
    assert kept == owed and all(before[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in got)
    assert any(r.text != before[r.doc_id] for r in got)


def test_first_words(spark):
    cases = [("  a b\n c ", 2), ("a  b", 2), ("a b", 5), (" ", 1), ("", 1), (None, 1), ("x" * 100_000 + " y", 1), ("w " * 20_000, 10_000)]
    df = spark.createDataFrame(cases, "text string, n long")
    got = [r[0] for r in df.select(mixing.first_words(F.col("text"), F.col("n"))).collect()]
    assert got == ["  a b", "a  b", "a b", " ", "", None, "x" * 100_000, ("w " * 10_000)[:-1]]


def test_ids_are_those_of_the_mixture_s_texts(stages):
    """As above, but a document that one epoch takes whole and the next one cuts has two texts."""
    found, _ = stages
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.parse_ranks(bpe.read_ranks(VOCABULARY)), special_tokens={})
    expected = Counter((r.doc_id, tuple(library.encode_ordinary(r.text))) for r in found["mixing"].collect())
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found["bpe"].collect()) == expected


def test_decoding_gives_the_texts(stages):
    found, _ = stages
    expected = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in found["mixing"].collect())
    got = found["bpe"].collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in got) == expected
    assert all(len(r.ends) == len(r.ids) == 4 * r.n_tokens for r in got)


def test_run_gives_the_last_stage(spark, sf_dir):
    from __spark_entry__ import oracle_sql, queries

    out = queries()["pipeline"](spark, sf_dir)
    assert out.count() > 0 and "pipeline" not in oracle_sql() and pipeline.ORACLE_SQL is None
