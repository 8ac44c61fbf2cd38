import pytest

from tidewise.operators import orders
from tidewise.schemas import ORDER_DETAIL, ORDER_INFO_WIDE, ORDER_WIDE


def info(id, time, **more):
    row = dict.fromkeys(ORDER_INFO_WIDE.names)
    row.update(id=id, create_time=time, total_amount=10.0, create_date=time[:10], user_age=30, **more)
    return tuple(row.values())


def detail(id, order, time, **more):
    row = dict.fromkeys(ORDER_DETAIL.names)
    row.update(id=id, order_id=order, create_time=time, split_total_amount=1.0, **more)
    return tuple(row.values())


@pytest.fixture
def frames(spark):
    def make(infos, details):
        return spark.createDataFrame(infos, ORDER_INFO_WIDE), spark.createDataFrame(details, ORDER_DETAIL)

    return make


def test_a_day_apart_joins_and_more_does_not(frames):
    i, d = frames(
        [info(1, "2024-01-02 12:00:00")],
        [
            detail(11, 1, "2024-01-03 11:00:00"),
            detail(12, 1, "2024-01-03 12:00:00"),
            detail(13, 1, "2024-01-03 13:00:00"),
            detail(14, 1, "2024-01-01 13:00:00"),
            detail(15, 1, "2024-01-01 11:00:00"),
            detail(16, 2, "2024-01-02 12:00:00"),
        ],
    )
    wide = orders.order_wide(i, d)
    assert wide.schema == ORDER_WIDE and len(ORDER_WIDE) == 30
    assert {r.detail_id for r in wide.collect()} == {11, 12, 14}
    assert {(r.detail_id, r.seconds_apart) for r in orders.late_pairs(i, d).collect()} == {(13, 90000), (15, 90000)}


def test_line_time_wins_even_when_null(frames):
    i, d = frames([info(1, "2024-01-02 12:00:00")], [detail(11, 1, None), detail(12, 1, "2024-01-02 13:00:00")])
    rows = {r.detail_id: r for r in orders.order_wide(i, d).collect()}
    assert rows[11].create_time is None and rows[12].create_time == "2024-01-02 13:00:00"
    assert {r.create_date for r in rows.values()} == {"2024-01-02"} and {r.order_id for r in rows.values()} == {1}


def test_copies_do_not_multiply(frames):
    i, d = frames([info(1, "2024-01-02 12:00:00")] * 50, [detail(11, 1, "2024-01-02 12:00:00")] * 50)
    assert orders.order_wide(i, d).count() == 1
    assert orders.order_pairs(i, d).count() == 50


def test_full_outer_keeps_both_sides(frames):
    i, d = frames(
        [info(1, "2024-01-02 12:00:00"), info(2, "2024-01-02 12:00:00")],
        [detail(11, 1, "2024-01-02 12:00:00"), detail(12, 1, "2024-01-02 12:00:00"), detail(31, 3, "2024-01-02 12:00:00")],
    )
    rows = {(r.order_id, r.info_id, r.detail_id) for r in orders.order_full_outer(i, d).collect()}
    assert rows == {(1, 1, 11), (1, 1, 12), (2, 2, None), (3, None, 31)}
