"""Kneser-Ney models: probabilities that add up, predictions, rejection."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewise.llm import langid


@pytest.fixture(scope="module")
def model():
    grams = []
    for lang, text in (("aa", "abra kadabra abra abrakad ara"), ("bb", "zyx wzyx zzyw xyz wyx yyz")):
        points, owner, scored = langid.clean(*langid.plain_points([text] * 3))
        windows = np.lib.stride_tricks.sliding_window_view(points, langid.ORDER)
        for at in np.flatnonzero(scored):
            grams.append((lang, "".join(map(chr, windows[at - langid.ORDER + 1]))))
    counts = pd.DataFrame(grams, columns=["lang", "gram"]).value_counts().reset_index(name="n")
    built = langid.build(counts)
    built.typical = np.array([[1.0, 1.0], [1.0, 1.0]])
    return built


def test_probabilities_add_up(model):
    """For any context, seen or not, the letters' probabilities and the unseen rest sum to one."""
    letters = sorted(set("abrakadabra zyxw"))
    for context in ("abra", "kad ", "zzzz", "    ", "abrz"):
        for language in range(2):
            total = 0.0
            for letter in letters:
                points = np.array([ord(c) for c in " " * langid.ORDER + context + letter], dtype=np.uint32)
                hashes = langid.gram_hashes(points, langid.ORDER)
                value, last = 0.0, len(points) - 1
                for n in range(langid.ORDER, 0, -1):
                    place, found = model.grams[n - 1].find(hashes[n][[last]])
                    if found[0]:
                        value += model.values[n - 1][place[0], language]
                        break
                    place, known = model.contexts[n - 1].find(hashes[n - 1][[last - 1]])
                    value += model.backs[n - 1][place[0], language] if known[0] else 0.0
                else:
                    value += model.floor[language]
                total += np.exp(value)
            assert total <= 1 + 1e-5
            assert total > 0.5


def test_predictions_and_odd_texts(model):
    names, score, entropy, rejected = model.predict(["kadabra abra", "zyx wyx", None, "", "123 $$", "a" * 50_000, "ABRA"])
    assert names[:5] == ["aa", "bb", "und", "und", "und"] and names[6] == "aa"
    assert (score[:2] > 0.5).all() and (score[2:5] == 0).all() and rejected[2:5].all() and np.isnan(entropy[2])
    assert ((0 <= score) & (score <= 1)).all()


def test_sorted_hashes_find_as_a_set_does():
    draw = np.random.default_rng(0)
    keys = np.unique(draw.integers(0, 2**63, 1000).astype(np.uint64))
    hashes = langid.Hashes(keys)
    wanted = np.concatenate((keys[::3], draw.integers(0, 2**63, 500).astype(np.uint64), [np.uint64(0), np.uint64(2**64 - 1)]))
    place, found = hashes.find(wanted)
    assert found.tolist() == [w in set(keys.tolist()) for w in wanted.tolist()]
    assert (hashes.keys[place[found]] == wanted[found]).all()


def test_held_out_accuracy_and_shape(spark, sf_dir):
    from tidewise.llm.queries import QUERIES

    sf = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op5_language"](spark, sf)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    joined = found.join(docs, "doc_id").where("held_out")
    right, total, rejected = joined.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*"), F.count_if("rejected")).first()
    assert right / total > 0.98 and found.count() == docs.count() and rejected == 0


def test_calibration_reads_whole_texts(spark):
    """Texts that go on differently after 2000 characters are usual in their language, and none is rejected for it."""
    draw = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz ")
    rows = [(i, "abra kadabra " * 160 + "".join(draw.choice(letters, 6000)), "aa") for i in range(150)]
    rows += [(i, "zyx wzyx wyz " * 160 + "".join(draw.choice(letters, 6000)), "bb") for i in range(150, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, train_rows=1000)
    found = langid.detect(df, model)
    whole = found.where("lang = lang_pred").groupBy("lang").agg(F.min("entropy").alias("least"), F.max("entropy").alias("most")).collect()
    usual = dict(zip(model.languages, model.typical[:, 0].tolist()))
    assert len(whole) == 2 and all(r.least <= usual[r.lang] <= r.most for r in whole)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "x", None, "kept"), (2, None, None, None)], "doc_id long, text string, lang string, score string")
    model = langid.fit(df)
    out = langid.detect(df, model)
    assert model is None and [r.lang_pred for r in out.collect()] == ["und", "und"]
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "entropy", "rejected"]
    assert langid.detect(df.limit(0), model).count() == 0
