import json

from tidewise import schemas as S
from tidewise.operators import logs

COMMON = {"ar": "1", "uid": "u", "os": "iOS", "ch": "c", "is_new": "1", "md": "m", "mid": "d1", "vc": "v", "ba": "b"}
PAGE = {"page_id": "home", "item": "7", "item_type": "sku_id", "during_time": 5, "last_page_id": "x", "source_type": "q"}


def parsed(spark, *records):
    values = [(r if isinstance(r, str) or r is None else json.dumps(r),) for r in records]
    return logs.parse_logs(spark.createDataFrame(values, "value STRING"))


def counts(spark, *records):
    return {r.branch: r.n for r in logs.split_counts(parsed(spark, *records)).collect()}


def test_schemas_of_the_branches(spark):
    p = parsed(spark, {"common": COMMON, "page": PAGE, "ts": 1})
    assert logs.page_log(p).schema == S.PAGE_LOG and len(S.PAGE_LOG) == 16
    assert logs.page_display_log(p).schema == S.PAGE_DISPLAY_LOG and len(S.PAGE_DISPLAY_LOG) == 21
    assert logs.page_action_log(p).schema == S.PAGE_ACTION_LOG and len(S.PAGE_ACTION_LOG) == 20
    assert logs.start_log(p).schema == S.START_LOG and len(S.START_LOG) == 14
    assert "brand" not in S.START_LOG.names


def test_quoted_and_plain_numbers_read_alike(spark):
    rows = logs.page_log(
        parsed(
            spark,
            {"common": {**COMMON, "is_new": 1}, "page": {**PAGE, "during_time": "9"}, "ts": "1653177600000"},
            {"common": COMMON, "page": PAGE, "ts": 1653177600000},
        )
    ).collect()
    assert [r.ts for r in rows] == [1653177600000] * 2
    assert {r.during_time for r in rows} == {5, 9} and {r.is_new for r in rows} == {"1"}


def test_missing_number_stays_null(spark):
    row = logs.page_log(parsed(spark, {"common": COMMON, "page": {"page_id": "home"}})).first()
    assert row.ts is None and row.during_time is None and row.last_page_id is None


def test_error_wins_over_page_and_start(spark):
    record = {"common": COMMON, "page": PAGE, "start": {"entry": "icon"}, "err": {"error_code": 1, "msg": "m"}, "ts": 1}
    p = parsed(spark, record)
    assert logs.error_log(p).first().value == json.dumps(record)
    assert logs.page_log(p).isEmpty() and logs.start_log(p).isEmpty()
    assert [r.topic for r in logs.fan_out(p).collect()] == [S.ERROR_TOPIC]


def test_null_error_is_no_error(spark):
    assert logs.page_log(parsed(spark, {"common": COMMON, "page": PAGE, "err": None, "ts": 1})).count() == 1


def test_page_and_start_in_one_record_feed_both(spark):
    p = parsed(spark, {"common": COMMON, "page": PAGE, "start": {"entry": "icon", "loading_time": "3"}, "ts": 1})
    assert logs.page_log(p).count() == 1 and logs.start_log(p).first().loading_time == 3
    assert sorted(r.topic for r in logs.fan_out(p).collect()) == [S.PAGE_TOPIC, S.START_TOPIC]


def test_empty_and_null_arrays_give_no_rows(spark):
    p = parsed(
        spark,
        {"common": COMMON, "page": PAGE, "displays": [], "actions": None, "ts": 1},
        {"common": COMMON, "page": PAGE, "displays": None, "actions": [], "ts": 1},
    )
    assert logs.page_display_log(p).isEmpty() and logs.page_action_log(p).isEmpty()
    assert logs.fan_out(p).count() == 2


def test_items_without_page_are_ignored(spark):
    p = parsed(spark, {"common": COMMON, "displays": [{"item": "1"}], "actions": [{"action_id": "a"}], "ts": 1})
    assert logs.page_display_log(p).isEmpty() and logs.fan_out(p).isEmpty()


def test_display_order_number_is_text_and_context_is_kept(spark):
    p = parsed(spark, {"common": COMMON, "page": PAGE, "displays": [{"order": 2, "pos_id": "4", "item": "9"}], "ts": 8})
    row = logs.page_display_log(p).first()
    assert (row.display_order, row.display_pos_id, row.display_item, row.page_id, row.ts) == ("2", "4", "9", "home", 8)


def test_broken_text_goes_to_its_own_branch(spark):
    p = parsed(spark, "no json", "", None, "[1,2]", {"page": "text", "ts": 1}, {"common": COMMON, "page": PAGE, "ts": 1})
    assert logs.corrupt_log(p).count() == 5 and logs.page_log(p).count() == 1
    assert sorted(r.topic for r in logs.fan_out(p).collect()) == [S.CORRUPT_TOPIC] * 5 + [S.PAGE_TOPIC]


def test_missing_common_gives_null_columns_and_is_counted(spark):
    assert logs.page_log(parsed(spark, {"page": PAGE, "ts": 1})).first().mid is None
    assert counts(spark, {"page": PAGE, "ts": 1})["no_common"] == 1


def test_counts_add_up(spark):
    records = [
        {"common": COMMON, "page": PAGE, "displays": [{"item": "1"}, {"item": "2"}], "actions": [{"ts": 3}], "ts": 1},
        {"common": COMMON, "start": {"entry": "i"}, "ts": 1},
        {"common": COMMON, "err": {"msg": "m"}, "ts": 1},
        "broken",
    ]
    n = counts(spark, *records)
    assert n["parsed"] == n["error"] + n["clean"] + n["corrupt"] == 4
    assert (n["page"], n["display"], n["action"], n["start"]) == (1, 2, 1, 1)
    assert logs.fan_out(parsed(spark, *records)).count() == 1 + 2 + 1 + 1 + n["error"] + n["corrupt"]


def test_messages_leave_nulls_out_and_parse_back(spark):
    p = parsed(spark, {"common": COMMON, "page": {"page_id": "home", "during_time": 4}, "ts": 1})
    message = logs.fan_out(p).first()
    assert message.key == "d1" and "last_page_id" not in json.loads(message.value)
    assert logs.parse_page_log(logs.fan_out(p)).collect() == logs.page_log(p).collect()


def test_one_parse_per_record(spark):
    """Filters on parsed fields must not bring a second parse below them."""
    plan = logs.page_log(parsed(spark, {"ts": 1}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    plan = logs.fan_out(parsed(spark, {"ts": 1}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
