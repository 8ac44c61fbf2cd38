"""The field against all labellings of short chains, its gradient against differences, and the ranking of held-out rows."""

import itertools

import numpy as np
import pytest

from tidewise.llm import quality
from tidewise.llm.queries import QUERIES

PROSE = ["The sea was calm.", "We went home, and it rained for days.", "Nothing else happened.", "Then, at noon, a ship came by!"]
JUNK = ["BUY NOW!! CHEAP!! DEALS!! HERE!!", "a | b | c | d | e |", "click click click click click", "xx### yy$$$ zz%%%"]


def field(seed: int = 0) -> quality.Field:
    draw = np.random.default_rng(seed)
    pairs = draw.normal(0, 1, (2, 2))
    pairs[0, 0] = 0.0
    return quality.Field(draw.normal(0, 0.5, (3, len(quality.FEATURES), quality.BINS + 1)), pairs)


def enumerated(model: quality.Field, evidence: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    n = len(evidence)
    total, bad, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        weight = np.exp(sum(evidence[i] for i in range(n) if labels[i]) + sum(model.pairs[a, b] for a, b in zip(labels, labels[1:])))
        total += weight
        bad += weight * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += weight
    return bad / total, np.log(total), pairs / total


def test_marginals_are_sums_over_all_labellings():
    model, counts = field(1), np.array([3, 1, 8, 1, 5])
    evidence = np.random.default_rng(2).normal(0, 2, counts.sum())
    bad, z, pairs = model.marginals(evidence, counts)
    for k, (end, n) in enumerate(zip(np.cumsum(counts), counts)):
        mine = enumerated(model, evidence[end - n : end])
        assert np.allclose(bad[end - n : end], mine[0]) and np.isclose(z[k], mine[1]) and np.allclose(pairs[k], mine[2])


def test_gradient_is_the_slope_of_the_likelihood():
    draw, counts = np.random.default_rng(3), np.array([4, 1, 6])
    bins = draw.integers(0, quality.BINS, (11, len(quality.FEATURES))).astype(np.uint8)
    labels, weight, model = draw.integers(0, 2, 11), np.array([0.5, 2.0, 1.0]), field(4)
    _, by_weight, by_pair = quality.gradient(model, bins, counts, labels, weight)
    for held, slope in ((model.weights, by_weight), (model.pairs, by_pair)):
        for at in [tuple(draw.integers(0, s) for s in held.shape) for _ in range(12)] + [(0, 1), (1, 1)] * (held.ndim == 2):
            if held.ndim == 2 and at == (0, 0):
                continue
            values = []
            for step in (1e-5, -2e-5):
                held[at] += step
                values.append(quality.gradient(model, bins, counts, labels, weight)[0])
            held[at] += 1e-5
            assert np.isclose((values[0] - values[1]) / 2e-5, slope[at], atol=1e-6)


def test_lines_and_their_bins():
    texts = ["One two.\nTWO TWO TWO\n\nOne two.", "", "x\r\ny z", "a" * 9000]
    bins, length, counts = quality.lines(texts)
    assert counts.tolist() == [4, 1, 2, 1] and length.tolist() == [9, 12, 1, 9, 1, 3, 4, 9001]
    by_name = {n: bins[:, i].tolist() for i, n in enumerate(quality.FEATURES)}
    assert by_name["repeated line"] == [0, 0, 0, 1, 0, 0, 0, 0]
    assert by_name["no sentence end"] == [0, 1, 1, 0, 1, 1, 1, 1]
    assert by_name["upper"][1] == 7 and by_name["repeated word"][:2] == [0, 6] and by_name["length"][-1] == 7


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        text = [PROSE[j] for j in rng.integers(0, 4, rng.integers(1, 7))]
        bad = i % 3 == 0
        if bad:
            at = rng.integers(0, len(text) + 1)
            text[at:at] = [JUNK[i % 4] + f" {j}" for j in rng.integers(0, 9, rng.integers(2, 6))]
        rows.append((i, "\n".join(text), int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return quality.fit(docs.drop("quality"), docs.select("doc_id", "quality"))


def test_lines_of_bad_documents_are_told_apart(trained):
    for junk in JUNK:
        bins, _, counts = quality.lines(["\n".join([*PROSE, junk + " 1", junk + " 2", junk + " 3", *PROSE])])
        bad = trained.marginals(trained.evidence(bins, counts), counts)[0]
        assert (bad[:4] < 0.5).all() and (bad[4:7] > 0.5).all() and (bad[8:] < 0.5).all(), junk
    assert trained.slope < 20
    one, other = trained.scores(["\n".join(PROSE), "\n".join(JUNK)])
    assert one > 0.8 and other < 0.2


def test_rows_and_columns_stay(spark, trained):
    rows = [(1, PROSE[0], 0.0, "u"), (1, PROSE[0], None, "v"), (None, None, 1.0, None), (3, "", 1.0, "w"), (4, "b!!\n" * 30_000, 1.0, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, quality string")
    out = quality.score(df, trained)
    assert out.columns == ["doc_id", "text", "quality", "score", "predicted"]
    found = out.collect()
    assert sorted(str(r.quality) for r in found) == sorted(str(r[3]) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= quality.THRESHOLD) for r in found)
    assert len({r.score for r in found if r.doc_id == 1}) == 1
    assert quality.score(df.limit(0), trained).count() == 0
    assert {r.score for r in quality.score(df, None).collect()} == {0.5}


def test_no_model_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "A."), (2, "B."), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (9, 0)], "doc_id long, quality int")
    assert quality.fit(docs, labels) is None and quality.fit(docs, labels.limit(0)) is None
    twice = spark.createDataFrame([(1, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    assert quality.fit(docs, twice) is None


def test_names_of_extra_columns_do_not_clash(spark):
    rows = [(i, "\n".join(JUNK if i % 2 else PROSE), "x", "y", "z") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good string, id string, held string")
    labels = docs.selectExpr("doc_id", "1 - doc_id % 2 AS quality", "good", "'t' AS text", "id")
    model = quality.fit(docs, labels)
    assert {(r.doc_id % 2, r.predicted) for r in quality.score(docs, model).collect()} == {(0, 1), (1, 0)}


def test_held_out_ranking(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = QUERIES["op12_quality"](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = [(r.score, r.predicted, labels[r.doc_id]) for r in found if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [s for s, _, q in rows if q == 1], [s for s, _, q in rows if q == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert np.mean([p == q for _, p, q in rows]) > 0.95
