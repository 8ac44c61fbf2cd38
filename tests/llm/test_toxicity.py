"""The string kernel against its definition, and what the trained machine tolerates."""

import random
from itertools import combinations

import numpy as np
import pytest

from tidewise.llm import toxicity as X


def features(word: str) -> dict[tuple, float]:
    out = {}
    for i, j, k in combinations(range(len(word)), 3):
        if k - i < X.SPAN:
            key = (word[i], word[j], word[k])
            out[key] = out.get(key, 0) + X.DECAY ** (k - i + 1)
    return out


def norm(n: int) -> float:
    return sum(X.DECAY ** (2 * (k - i + 1)) for i, j, k in combinations(range(n), 3) if k - i < X.SPAN) ** 0.5


def test_kernel_is_what_it_says():
    landmarks, words = ["idiot", "clown", "abcabc"], ["idiot", "idxiot", "id", "clwn", "abcabcabc", "zzzz"]
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    end = np.cumsum([len(w) for w in words])
    got = X.Kernel(landmarks)(points, end - [len(w) for w in words], end)
    for i, w in enumerate(words):
        for j, m in enumerate(landmarks):
            a, b = features(w), features(m)
            expected = sum(a[u] * b[u] for u in a.keys() & b.keys()) / (norm(len(w)) * norm(len(m))) if len(w) > 2 else 0
            assert got[i, j] == pytest.approx(expected**X.POWER, abs=1e-5)


def test_words_are_read_through_signs_and_gaps():
    words = X.words_of(["I-d.i*O.t, you x y!\nNext. One", "", "$$$"])
    text = words.letters.tobytes().decode("utf-32-le")
    assert [text[a:b] for a, b in zip(words.start, words.end)] == ["idiot", "you", "xy", "next", "one"]
    assert words.document.tolist() == [0] * 5 and words.sentence.tolist() == [0, 0, 0, 1, 2]


@pytest.fixture(scope="module")
def trained(spark):
    random.seed(6)
    usual = ["house", "river", "walking", "green", "because", "table", "morning", "letter", "window", "summer"]
    insults = ["blockhead", "scoundrel", "numbskull"]

    def text(toxic):
        words = random.choices(usual, k=60)
        if toxic:
            words[random.randrange(60)] = random.choice(insults)
        return " ".join(w + ("." if random.random() < 0.15 else "") for w in words)

    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = X.fit(df.drop("toxic"), df.drop("text"))
    return model, usual


def test_gapped_and_inserted_insults_are_found(trained):
    model, usual = trained
    clean = " ".join(usual * 3)
    tricks = ["blockhead", "b l o c k h e a d", "bl*ock-he.ad", "bloxckhead", "blockheead", "BLOCKHEADS", "scoundrel!", "numbzskull"]
    assert (model.scores([f"{clean} {t} {clean}" for t in tricks]) > 0.5).all()
    assert (model.scores([clean, clean * 100, "", "window", "greenhouse walking letters"]) < 0.5).all()


def test_rows_and_columns_stay(spark, trained):
    model, _ = trained
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (2, "", "s"), (None, "blockhead", "s")], "doc_id long, text string, score string")
    out = X.score(df, model)
    assert out.columns == ["doc_id", "text", "score", "predicted"] and [r.predicted for r in out.collect()] == [0, 0, 0, 1]
    assert X.score(df.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    nothing = X.fit(df, labels)
    assert nothing is None and {r.score for r in X.score(df, nothing).collect()} == {0.0}


def test_held_out_ranking(spark, sf_dir):
    from tidewise.llm.queries import QUERIES

    sf = sf_dir.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    english = spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id")
    rows = QUERIES["op10_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").join(english, "doc_id").collect()
    bad, good = (np.array([r.score for r in rows if r.toxic == t]) for t in (1, 0))
    assert np.mean([(good < x).mean() for x in bad]) > 0.9 and (good >= 0.5).mean() < 0.05
