"""Near-duplicate classes against all pairs, and the signatures against exact similarity."""

import random
from collections import Counter

import numpy as np
import pytest

from tidewise.llm import probminhash as P


def exact(a: Counter, b: Counter) -> float:
    """Probability Jaccard index, straight from its definition."""
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys())
    return total


def bag(text: str | None) -> Counter:
    words = (text or "").lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def classes(rows) -> dict[int, int]:
    """Components over all pairs of similarity 0.8 or more."""
    bags = {i: bag(t) for i, t in rows if i is not None}
    name = {i: i for i in bags}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    ids = sorted(bags)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            shared = len(bags[i].keys() & bags[j].keys())
            if shared * 2 > max(len(bags[i]), len(bags[j])) and exact(bags[i], bags[j]) >= 0.8:
                p, q = root(i), root(j)
                name[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def sentence(n):
    return [random.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(random.randint(0, 30)) for _ in range(n)]


def fixture():
    random.seed(4)
    texts = []
    for size in (3, 30, 120, 300):
        base = sentence(size)
        for edits in (0, 0, 1, 2, 4, 8):
            words = list(base)
            for _ in range(edits):
                words[random.randrange(size)] = "changed" + str(random.randint(0, 99))
            texts.append(" ".join(words))
    base = sentence(200)  # a family of copies around the threshold
    texts += [" ".join(w if random.random() > 0.02 else "x" + str(random.randint(0, 9)) for w in base) for _ in range(30)]
    texts += ["same line again and again\n" * n for n in (1, 5, 50)] + ["", None, "one", "ONE", "two  words", "Two words "]
    return list(enumerate(texts))


def test_similarity_is_the_index():
    random.seed(1)
    for _ in range(200):
        a, b = (Counter(random.choices(range(12), k=random.randint(1, 30))) for _ in range(2))
        x, y = (np.array(sorted(c.elements()), dtype=np.uint32) for c in (a, b))
        assert P.similarity(x, y) == pytest.approx(exact(a, b))
    assert P.similarity(np.zeros(0, np.uint32), np.array([1], np.uint32)) == 0


def test_registers_agree_as_often_as_bags_are_similar():
    a = Counter({i: 1 + i % 4 for i in range(60)})
    b = Counter({i: 1 + i % 3 for i in range(10, 70)})
    agree = []
    for round_ in range(20):
        elements = [np.array(sorted(c), dtype=np.uint64) + np.uint64(1000 * round_) for c in (a, b)]
        weights = [np.array([c[k] for k in sorted(c)]) for c in (a, b)]
        owner = np.repeat([0, 1], [len(a), len(b)])
        found = P.signatures(owner, np.concatenate(elements), np.concatenate(weights), 2, 256)
        agree.append((found[0] == found[1]).mean())
    assert np.mean(agree) == pytest.approx(exact(a, b), abs=0.02)


@pytest.mark.parametrize("block", [P.BLOCK, 4])
def test_classes_against_all_pairs(spark, block):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc"]: r["class"] for r in P.near_classes(df, block=block).collect()}
    assert got == classes(rows)


def test_rows_and_columns_stay(spark):
    text = " ".join(sentence(40))
    rows = [(2, text, 1), (1, text, 2), (1, text, 2), (None, text, 3), (3, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id long")
    out = P.near_duplicates(df)
    assert out.columns == ["doc_id", "text", "class_id"]
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in out.collect()) == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 3)]
    assert sorted(r.doc_id or 0 for r in P.drop_near_duplicates(df).collect()) == [0, 1, 3]
    assert P.near_duplicates(df.limit(0)).count() == 0


def test_query_against_all_pairs(spark, sf_dir):
    from tidewise.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert {r.doc_id: r.class_id for r in QUERIES["op3_probminhash"](spark, sf_dir).collect()} == classes(rows)


def test_crowded_buckets_compare_what_is_four_deviations_below_the_threshold():
    """A pair of similarity 0.8, neither of them the hub, whose registers agree in 0.73 only."""
    import pyarrow as pa

    size = P.BANDS * P.ROWS + P.FURTHER
    agreeing = int(np.ceil((0.8 - 4 * np.sqrt(0.8 * 0.2 / size)) * size))
    registers = np.zeros((3, size), np.uint8)
    registers[1], registers[2, :agreeing], registers[2, agreeing:] = 1, 1, 2
    bands = np.tile(np.arange(P.BANDS), (3, 1)) + 100 * np.arange(3)[:, None]
    bands[:, 0] = 7
    table = pa.table(
        {
            "key": [7] * 3, "low": [0] * 3, "high": [0] * 3, "doc": [1, 2, 3], "component": [1, 2, 3], "block": [0] * 3,
            "registers": [r.tobytes() for r in registers], "bands": bands.tolist(),
            "bag": [np.arange(n, n + 50, dtype="<u4").tobytes() for n in (900, 0, 5)],
        }
    )
    assert P._near_links(table, 0.8).to_pylist() == [{"a": 2, "b": 3}]
    assert P._near_links(table, 0.9).to_pylist() == []


def test_a_block_sends_a_forest_of_links():
    """A hundred near copies in one bucket, none of them linked so far, and one document that only looks like them."""
    import pyarrow as pa

    n = 101
    bands = np.tile(np.arange(P.BANDS), (n, 1)) + 100 * np.arange(n)[:, None]
    bands[:, 0] = 7
    bag = np.arange(100, dtype="<u4")
    bags = [np.sort(np.append(np.delete(bag, i), 500 + i)).astype("<u4") for i in range(100)] + [np.arange(700, 800, dtype="<u4")]
    registers = np.ones((n, P.BANDS * P.ROWS + P.FURTHER), np.uint8)
    table = pa.table(
        {
            "key": [7] * n, "low": [0] * n, "high": [0] * n, "doc": list(range(n)), "component": list(range(n)), "block": [0] * n,
            "registers": [r.tobytes() for r in registers], "bands": bands.tolist(), "bag": [b.tobytes() for b in bags],
        }
    )
    links = P._near_links(table, 0.8).to_pylist()
    assert len(links) == 99 and {x for link in links for x in link.values()} == set(range(100))
