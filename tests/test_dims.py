import pytest
from pyspark.sql import functions as F

from tidewise.functions.rows import overlay
from tidewise.functions.scalars import age_years, gender_label, hour_part, date_part
from tidewise.operators import dims
from tidewise.schemas import DAU_INFO, PAGE_LOG, PROVINCE_DIM, USER_DIM


@pytest.mark.parametrize(
    "birthday, as_of, years",
    [
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
        ("2000-05-10", "2020-05-10", 20),
        ("2000-05-10", "2020-05-09", 19),
        ("2024-07-31", "2024-01-31", 0),
        ("2026-01-30", "2024-01-31", -1),
        ("nonsense", "2024-01-31", None),
        (None, "2024-01-31", None),
    ],
)
def test_age(spark, birthday, as_of, years):
    one = spark.sql("SELECT 1").select(age_years(F.lit(birthday).cast("string"), as_of).alias("age"))
    assert one.first().age == years


def test_create_parts_of_short_texts(spark):
    rows = spark.createDataFrame([("2024-01-05 14:27:36",), ("2024-01-05",), ("",), (None,)], "t STRING")
    out = rows.select(date_part(F.col("t")).alias("d"), hour_part(F.col("t")).alias("h")).collect()
    assert [tuple(r) for r in out] == [("2024-01-05", "14"), ("2024-01-05", None), ("", None), (None, None)]


def test_gender_labels(spark):
    rows = spark.createDataFrame([("F",), ("M",), ("X",), (None,)], "g STRING").select(gender_label(F.col("g")).alias("l"))
    assert [r.l for r in rows.collect()] == ["女", "男", "X", None]


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(1, "F", "2000-01-01"), (2, None, None)], USER_DIM)


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([("1", "7"), ("2", "8"), ("3", None), (None, "7")], "user_id STRING, province_id STRING")


def test_missing_user_keeps_the_fact(spark, facts, users):
    out = dims.enrich_user(facts, users, "2024-01-31").collect()
    assert len(out) == 4
    assert {(r.user_id, r.user_gender, r.user_age) for r in out} == {("1", "F", 24), ("2", None, None), ("3", None, None), (None, None, None)}


def test_strict_mode_fails_on_a_missing_user(spark, facts, users):
    with pytest.raises(Exception, match="no dimension row"):
        dims.enrich_user(facts, users, "2024-01-31", strict=True).collect()
    present = facts.where("user_id IN ('1', '2')")
    assert dims.enrich_user(present, users, "2024-01-31", strict=True).count() == 2


def test_misses_are_counted(spark, facts, users):
    provinces = spark.createDataFrame([(7, "P", "1", "A", "B")], PROVINCE_DIM)
    enriched = dims.enrich_province(dims.enrich_user(facts, users, keep_found=True), provinces, keep_found=True)
    assert tuple(enriched.agg(*dims.miss_counts()).first()) == (4, 2, 2)


def test_overlay_copies_equal_names_and_types(spark):
    row = ["mid1001", "uid101", "prov101", *[None] * 11, 123, 0]
    page = spark.createDataFrame([row], PAGE_LOG).alias("p")
    out = page.select(*overlay(DAU_INFO, [("p", PAGE_LOG)])).first().asDict()
    filled = {k: v for k, v in out.items() if v is not None}
    assert filled == {"mid": "mid1001", "user_id": "uid101", "province_id": "prov101", "during_time": 123, "ts": 0}
    assert len(out) == 23 and "last_page_id" not in out


def test_overlay_later_source_wins_with_its_nulls(spark):
    from pyspark.sql import types as T

    a = T.StructType().add("x", "string").add("y", "string").add("z", "long")
    b = T.StructType().add("x", "string").add("z", "string")
    both = spark.createDataFrame([(("a", "b", 1), (None, "c"))], T.StructType().add("a", a).add("b", b))
    assert tuple(both.select(*overlay(a, [("a", a), ("b", b)])).first()) == (None, "b", 1)
