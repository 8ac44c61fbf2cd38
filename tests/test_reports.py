import pytest

from tidewise.operators import reports
from tidewise.schemas import ORDER_WIDE


@pytest.fixture
def dau(spark):
    rows = [("a", "2024-01-15", "09"), ("b", "2024-01-15", "09"), ("c", "2024-01-15", "23"), ("a", "2024-01-14", "00")]
    return spark.createDataFrame(rows, "mid STRING, dt STRING, hr STRING")


def wide(spark, *rows):
    out = []
    for n, (name, age, gender, amount) in enumerate(rows):
        row = dict.fromkeys(ORDER_WIDE.names)
        row.update(detail_id=n, sku_name=name, user_age=age, user_gender=gender, split_total_amount=amount, create_date="2024-01-05")
        out.append(tuple(row.values()))
    return spark.createDataFrame(out, ORDER_WIDE)


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_daily_actives(dau):
    assert reports.dau_realtime_response(dau, "2024-01-15") == {"dauTotal": 3, "dauTd": {"09": 2, "23": 1}, "dauYd": {"00": 1}}
    assert sorted(pairs(reports.dau_realtime(dau, "2024-01-15")), key=str) == [
        ("dauTd", "09", 2), ("dauTd", "23", 1), ("dauTotal", None, 3), ("dauYd", "00", 1)
    ]
    assert reports.dau_total(dau, "2024-01-15").first().dau_total == 3


def test_day_without_documents(dau):
    assert reports.dau_realtime_response(dau, "2025-01-01") == {"dauTotal": 0, "dauTd": {}, "dauYd": {}}
    assert reports.dau_total(dau, "2025-01-01").first().dau_total == 0
    assert reports.dau_by_hour(dau, "2025-01-01").isEmpty()


def test_hours_are_filled_and_add_up(dau):
    hours = pairs(reports.fill_hours(reports.dau_by_hour(dau, "2024-01-15")))
    assert len(hours) == 24 and sum(n for _, n in hours) == 3 and dict(hours)["09"] == 2


def test_month_change():
    assert reports.day_before("2024-03-01") == "2024-02-29"


def test_age_bands_at_their_edges(spark):
    w = wide(spark, ("red", 19, "F", 1.1), ("red", 20, "F", 2.2), ("red", 29, "M", 3.3), ("red", 30, "M", 4.4), ("red", None, "M", 9.0))
    bands = pairs(reports.stats_by_item(w, "red", "2024-01-05", "age"))
    assert bands == [("20岁以下", 1.1), ("20到29岁", 5.5), ("30岁以上", 4.4)]


def test_empty_bands_are_zero_and_no_match_is_empty(spark):
    w = wide(spark, ("red", 40, "F", 1.0))
    assert pairs(reports.stats_by_item(w, "red", "2024-01-05", "age")) == [("20岁以下", 0.0), ("20到29岁", 0.0), ("30岁以上", 1.0)]
    assert reports.stats_by_item(w, "nosuch", "2024-01-05", "age").isEmpty()
    assert reports.stats_by_item(w, "nosuch", "2024-01-05", "gender").isEmpty()
    assert reports.stats_by_item(w, "red", "2024-03-01", "age").isEmpty()


def test_gender_labels_and_unknown_code(spark):
    w = wide(spark, ("red", 1, "F", 1.0), ("red", 1, "M", 2.0), ("red", 1, "M", 2.0), ("red", 1, "X", 4.0), ("red", 1, None, 8.0))
    assert sorted(pairs(reports.stats_by_item(w, "red", "2024-01-05", "gender"))) == [("X", 4.0), ("女", 1.0), ("男", 4.0)]


def test_unknown_grouping_is_refused(spark):
    with pytest.raises(ValueError):
        reports.stats_by_item(wide(spark, ("red", 1, "F", 1.0)), "red", "2024-01-05", "city")


def test_pages_cover_the_matches_once(spark):
    w = wide(spark, *[("red plate" if n % 3 else "red red plate", 20, "F", 1.0) for n in range(25)], ("blue", 1, "F", 1.0))
    seen = []
    for page in (1, 2, 3, 4):
        rows = reports.detail_by_item(w, "red", "2024-01-05", page, 10).collect()
        assert len(rows) == (10, 10, 5, 0)[page - 1]
        seen += rows
    assert len(seen) == 25 and all("<em>red</em>" in r.sku_name for r in seen)
    assert seen[0].sku_name == "<em>red</em> <em>red</em> plate"
    response = reports.detail_response(w, "2024-01-05", "red", 3, 10)
    assert response["total"] == 25 and len(response["detail"]) == 5
    assert sorted(response["detail"][0]) == sorted(reports.DETAIL_COLUMNS)
    assert reports.detail_response(w, "2024-03-01", "red") == {}
    with pytest.raises(ValueError):
        reports.detail_by_item(w, "red", "2024-01-05", 0)


def test_paging_is_a_top_k(spark):
    w = wide(spark, ("red", 1, "F", 1.0))
    plan = reports.detail_by_item(w, "red", "2024-01-05", 2, 20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_response_is_the_total_and_the_page(spark, sf_dir):
    from tidewise.plans import landing

    docs = landing.order_docs(spark, sf_dir, ["2024-01-05"], *reports.DETAIL_COLUMNS)
    for item, page_no in (("plate", 1), ("plate", 2), ("red plate", 1), ("nosuch", 1), ("", 1)):
        found = reports.detail_response(docs, "2024-01-05", item, page_no, 7)
        assert found["total"] == reports.detail_total(docs, item, "2024-01-05").first().total
        assert found["detail"] == [r.asDict() for r in reports.detail_by_item(docs, item, "2024-01-05", page_no, 7).collect()]
    assert reports.detail_response(docs, "2024-03-01", "plate") == {}
    with pytest.raises(ValueError):
        reports.detail_response(docs, "2024-01-05", "plate", 0)
