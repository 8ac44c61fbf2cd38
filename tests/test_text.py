import math

import pytest
from pyspark.sql import functions as F

from tidewise.functions.text import highlight, matches_all, query_terms, tokens


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t STRING").select(column.alias("c")).first().c


@pytest.mark.parametrize(
    "text, expected",
    [("Red  Plate-2", ["red", "plate", "2"]), ("", []), ("--", []), ("Ünï x", ["ünï", "x"]), (None, None)],
)
def test_tokens(spark, text, expected):
    assert one(spark, text, tokens(F.col("t"))) == expected


def test_ideographs_are_paired(spark):
    assert sorted(one(spark, "小米手机 X10 红", tokens(F.col("t"), cjk=True))) == sorted(["小米", "米手", "手机", "x10", "红"])


@pytest.mark.parametrize(
    "text, query, hit",
    [
        ("big red plate", "plate RED", True),
        ("big red plates", "red plate", False),
        ("plate", "red plate", False),
        ("anything", "", False),
        ("anything", ".*(", False),
        ("a .*( b", ".*( a", True),
        (None, "red", None),
    ],
)
def test_all_terms_match(spark, text, query, hit):
    assert one(spark, text, matches_all(F.col("t"), query_terms(spark, query))) == hit


def test_ideograph_match(spark):
    terms = query_terms(spark, "手机 小米", cjk=True)
    assert one(spark, "小米智能手机", matches_all(F.col("t"), terms, cjk=True))
    assert not one(spark, "小米电视", matches_all(F.col("t"), terms, cjk=True))
    assert one(spark, "小米智能手机", highlight(F.col("t"), terms, cjk=True)) == "<em>小米</em>智能<em>手机</em>"


def test_highlight_marks_whole_words_only(spark):
    terms = query_terms(spark, "red .*( plate")
    assert terms == ["red", "plate"]
    assert one(spark, "Red plate, redder", highlight(F.col("t"), terms)) == "<em>Red</em> <em>plate</em>, redder"


def test_bm25_against_the_formula(spark):
    from tidewise.operators.reports import item_scored

    names = ["red plate", "red red ring", "blue bolt", None, "plate red small"]
    docs = [(i, n, "2024-01-05") for i, n in enumerate(names)] + [(9, "red plate", "2024-01-06")]
    wide = spark.createDataFrame(docs, "detail_id LONG, sku_name STRING, dt STRING")
    got = {r.detail_id: r.score for r in item_scored(wide, "red", "2024-01-05").collect()}
    lengths = {0: (1, 2), 1: (2, 3), 4: (1, 3)}
    n, df, avg = 4, 3, (2 + 3 + 2 + 3) / 4
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    want = {i: idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg)) for i, (tf, dl) in lengths.items()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i]) for i in want)
