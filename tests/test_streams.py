"""Stream jobs against their batch forms: splits, restarts, replays, order of arrival."""

import json
import time
from itertools import count

import pytest
from pyspark.sql import functions as F

from tidewise.operators import dau, logs
from tidewise.schemas import DAU_INFO, DIM_ROW, ORDER_WIDE_STORED, PAGE_TOPIC, PROVINCE_DIM, TABLE_LIST, USER_DIM
from tidewise.sinks.upsert import read_current
from tidewise.sources import tables
from tidewise.sources.topics import file_topic, land
from tidewise.streaming import jobs

ONCE = {"availableNow": True}
DAY = 86_400_000
T0 = 1_704_067_200_000
_offsets = count()


def push(session, path, *records, at="2024-01-01 00:00:00"):
    rows = [("k", json.dumps(r) if not isinstance(r, str) else r, next(_offsets), at) for r in records]
    frame = session.createDataFrame(rows, "key STRING, value STRING, offset LONG, timestamp STRING").coalesce(1)
    land(frame, "t", path)
    time.sleep(0.01)


def dims(session):
    users = session.createDataFrame([(1, "F", "2000-01-01")], USER_DIM)
    provinces = session.createDataFrame([(1, "P", "1", "A", "B")], PROVINCE_DIM)
    return (lambda s, ids: users), (lambda s, ids: provinces)


def page(mid, ts, last=None, item="1"):
    record = {"mid": mid, "user_id": "1", "province_id": "1", "page_id": "home", "page_item": item, "ts": ts}
    return {**record, "last_page_id": last} if last is not None else record


def run_dau(session, root, seen=None, files=1):
    users, provinces = dims(session)
    jobs.dau_documents(
        file_topic(session, f"{root}/in", files), users, provinces, f"{root}/docs", f"{root}/cp", "2024-01-31", seen=seen, trigger=ONCE
    ).awaitTermination()
    return read_current(session, f"{root}/docs", DAU_INFO, "mid", "dt")


def test_missing_dimensions_are_reported(streams, tmp_path, caplog):
    root = str(tmp_path)
    stranger = {**page("b", T0), "user_id": "99"}
    push(streams, f"{root}/in", page("a", T0), stranger)
    with caplog.at_level("INFO", logger="tidewise.streaming.jobs"):
        assert run_dau(streams, root).where("user_gender IS NULL").count() == 1
    assert "'facts': 2, 'no_user': 1, 'no_province': 0" in caplog.text


def test_daily_actives_over_batches_and_restart(streams, tmp_path):
    root = str(tmp_path)
    push(streams, f"{root}/in", page("a", T0), page("a", T0 + 5), page("b", T0 + 7, last="x"), page("c", T0 + 8, last=""))
    push(streams, f"{root}/in", page("a", T0 + 9, item="late"), page("b", T0 + 10))
    run_dau(streams, root)
    push(streams, f"{root}/in", page("a", T0 + DAY), page("a", T0 + 11), page("b", T0 + 12))
    rows = run_dau(streams, root).collect()
    assert {(r.mid, r.dt) for r in rows} == {("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-02")}
    first = next(r for r in rows if (r.mid, r.dt) == ("a", "2024-01-01"))
    assert first.page_item == "1" and first.user_gender == "F" and first.user_age == "24" and first.province_name == "P"


def test_grace_of_one_day(streams, tmp_path):
    """A row of the previous day still counts after the next day has begun."""
    root = str(tmp_path)
    for r in (page("a", T0), page("b", T0 + DAY + 10), page("c", T0 + DAY - 1)):
        push(streams, f"{root}/in", r)
    assert {(r.mid, r.dt) for r in run_dau(streams, root).collect()} == {
        ("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-01")
    }


def test_lost_checkpoint_restored_from_documents(streams, tmp_path):
    root = str(tmp_path)
    push(streams, f"{root}/in", page("a", T0, item="first"))
    run_dau(streams, root)
    seen = jobs.restore_devices(streams, f"{root}/docs", "2024-01-01", f"{root}/seen")
    push(streams, f"{root}/in2", page("a", T0 + 5, item="again"), page("b", T0 + 6))
    users, provinces = dims(streams)
    jobs.dau_documents(
        file_topic(streams, f"{root}/in2"), users, provinces, f"{root}/docs", f"{root}/cp2", seen=seen, trigger=ONCE
    ).awaitTermination()
    rows = {r.mid: r.page_item for r in read_current(streams, f"{root}/docs", DAU_INFO, "mid", "dt").collect()}
    assert rows == {"a": "first", "b": "1"}


def test_stream_equals_batch_whatever_the_split(streams, sf_dir, tmp_path):
    from tidewise.sources import samples

    records = samples.raw_log_records(streams, sf_dir).where(F.col("offset") < 400)
    messages = logs.fan_out(logs.parse_logs(records)).where(F.col("topic") == PAGE_TOPIC)
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    timed = messages.withColumn("offset", ts).withColumn("timestamp", F.timestamp_millis(ts)).orderBy("offset").persist()
    entries = dau.with_day(dau.session_entries(logs.parse_page_log(timed)))
    want = {(r.mid, r.dt) for r in dau.first_seen(entries).collect()}
    cuts = timed.approxQuantile("offset", [0.3, 0.6], 0)
    bounds = [0, *[int(c) for c in cuts], 2**62]
    for low, high in zip(bounds, bounds[1:]):
        land(timed.where((F.col("offset") >= low) & (F.col("offset") < high)).coalesce(1), PAGE_TOPIC, f"{tmp_path}/in")
        time.sleep(0.01)
    got = run_dau(streams, str(tmp_path))
    assert {(r.mid, r.dt) for r in got.collect()} == want


def head(id, time):
    return {"id": id, "user_id": 1, "province_id": 1, "create_time": time, "total_amount": 5.0}


def line(id, order, time):
    row = {"id": id, "order_id": order, "sku_name": "red", "split_total_amount": 1.0}
    return {**row, "create_time": time} if time else row


def run_orders(session, root):
    users, provinces = dims(session)
    jobs.order_documents(
        file_topic(session, f"{root}/info", 1), file_topic(session, f"{root}/detail", 1), users, provinces,
        f"{root}/docs", f"{root}/cp", "2024-01-31", trigger=ONCE,
    ).awaitTermination()
    return {r.detail_id: r for r in read_current(session, f"{root}/docs", ORDER_WIDE_STORED, "detail_id", "dt").collect()}


def test_orders_join_in_any_order_of_arrival(streams, tmp_path):
    root = str(tmp_path)
    noon = "2024-01-02 12:00:00"
    push(streams, f"{root}/info", head(1, noon), head(2, noon))
    push(streams, f"{root}/detail", line(11, 1, noon), line(31, 3, noon), at=noon)
    run_orders(streams, root)
    # The line of 2 comes after its header, the header of 3 after its line, line 11 and header 1 once more.
    push(streams, f"{root}/detail", line(21, 2, "2024-01-03 11:00:00"), line(11, 1, noon), line(12, 1, "2024-01-03 13:00:00"))
    push(streams, f"{root}/info", head(3, noon), head(1, noon))
    # A line without a time of its own goes by its arrival.
    push(streams, f"{root}/detail", line(22, 2, None), at="2024-01-03 10:00:00")
    docs = run_orders(streams, root)
    assert set(docs) == {11, 21, 22, 31}
    assert docs[22].create_time is None and docs[21].create_time == "2024-01-03 11:00:00"
    assert {(d.dt, d.user_gender, d.user_age, d.province_name) for d in docs.values()} == {("2024-01-02", "F", 24, "P")}


def test_copies_in_the_stream_count_once(streams, tmp_path):
    root = str(tmp_path)
    noon = "2024-01-02 12:00:00"
    push(streams, f"{root}/info", *[head(1, noon)] * 40)
    push(streams, f"{root}/detail", *[line(11, 1, noon)] * 40, line(12, 1, noon))
    assert set(run_orders(streams, root)) == {11, 12}


def test_table_list_edit_counts_from_the_next_batch(streams, tmp_path):
    root = str(tmp_path)
    lists = f"{root}/lists"

    def set_lists(*rows):
        streams.createDataFrame(list(rows), TABLE_LIST).coalesce(1).write.mode("overwrite").parquet(lists)

    def change(id, table, ts):
        return {"table": table, "type": "insert", "ts": ts, "data": {"id": id, "gender": "F", "birthday": "2000-01-01"}}

    def run():
        jobs.cdc_route(
            file_topic(streams, f"{root}/in"), lambda s: tables.table_lists(s, lists), f"{root}/dims", f"{root}/cp",
            path=f"{root}/facts", trigger=ONCE,
        ).awaitTermination()

    set_lists(("FACT:TABLES", "order_info"))
    push(streams, f"{root}/in", change(1, "order_info", 1), change(1, "user_info", 1), "broken")
    run()
    set_lists(("FACT:TABLES", "order_info"), ("DIM:TABLES", "user_info"))
    push(streams, f"{root}/in", change(2, "order_info", 2), change(2, "user_info", 2), change(2, "user_info", 1))
    run()
    facts = streams.read.schema("key STRING, value STRING, topic STRING").parquet(f"{root}/facts").collect()
    assert sorted((r.topic, r.key or r.value) for r in facts) == [
        ("DWD_CORRUPT_LOG_TOPIC_0522", "broken"), ("DWD_ORDER_INFO_I_0522", "1"), ("DWD_ORDER_INFO_I_0522", "2")
    ]
    assert [(r.id, r.ts) for r in read_current(streams, f"{root}/dims", DIM_ROW, "id", "table_name").collect()] == [("2", 2)]
    assert [tuple(r) for r in tables.users(streams, f"{root}/dims").collect()] == [(2, "F", "2000-01-01")]
    some = streams.createDataFrame([(2,), (9,)], "id LONG")
    assert [r.id for r in tables.users(streams, f"{root}/dims", some).collect()] == [2]
    assert tables.users(streams, f"{root}/dims", some.where("id = 9")).isEmpty()
    assert tables.provinces(streams, f"{root}/dims").isEmpty()


def test_log_split_restart_loses_and_doubles_nothing(streams, tmp_path):
    root = str(tmp_path)

    def run():
        query = jobs.log_split(file_topic(streams, f"{root}/in", 1), f"{root}/cp", path=f"{root}/out", trigger=ONCE)
        query.awaitTermination()
        return [p["observedMetrics"].get("log_quality") for p in query.recentProgress if p["numInputRows"]]

    push(streams, f"{root}/in", {"common": {"mid": "a"}, "page": {"page_id": "p"}, "displays": [{"item": "1"}], "ts": 1}, "bad")
    quality = run()[0]
    assert (quality["records"], quality["corrupt"], quality["no_common"]) == (2, 1, 0)
    push(streams, f"{root}/in", {"common": {"mid": "b"}, "err": {"msg": "m"}, "ts": 2})
    run()
    run()
    out = streams.read.schema("key STRING, value STRING, topic STRING").parquet(f"{root}/out").groupBy("topic").count()
    assert {r["topic"]: r["count"] for r in out.collect()} == {
        "DWD_PAGE_LOG_TOPIC_0522": 1, "DWD_PAGE_DISPLAY_TOPIC_0522": 1, "DWD_ERROR_LOG_TOPIC_0522": 1, "DWD_CORRUPT_LOG_TOPIC_0522": 1
    }


def test_kafka_needs_its_connector(streams):
    from tidewise.sources.topics import kafka_topic

    with pytest.raises(Exception, match="kafka"):
        kafka_topic(streams, "localhost:1", "t")


def test_jobs_chain_from_the_command_line(streams, tmp_path):
    """Raw logs and change records in, enriched documents out, then a compaction: no record in between is made by hand."""
    from tidewise import schemas as S
    from tidewise.streaming import main

    store = str(tmp_path)

    def job(name, *more):
        main.run(streams, main.arguments([name, "--store", store, "--checkpoint", f"{store}/cp/{name}", "--once", *more]))

    dims_, facts = ["user_info", "base_province"], ["order_info", "order_detail"]
    lists = [("DIM:TABLES", t) for t in dims_] + [("FACT:TABLES", t) for t in facts]
    streams.createDataFrame(lists, TABLE_LIST).write.parquet(f"{store}/lists")

    def change(table, data, type="insert"):
        return {"table": table, "type": type, "ts": 1, "data": data}

    noon = "2024-01-02 12:00:00"
    push(
        streams,
        f"{store}/topics/{S.RAW_CDC_TOPIC}",
        change("user_info", {"id": 1, "gender": "M", "birthday": "1990-01-01"}),
        change("base_province", {"id": 1, "name": "P", "area_code": "7"}, "bootstrap-insert"),
        change("order_info", head(1, noon)),
        change("order_detail", line(11, 1, noon)),
        "broken",
    )
    log = {"common": {"mid": "a", "uid": "1", "ar": "1"}, "page": {"page_id": "home"}, "ts": T0}
    push(streams, f"{store}/topics/{S.RAW_LOG_TOPIC}", log, {"common": {"mid": "a"}, "start": {"entry": "i"}, "ts": 1})
    for name in ("cdc-route", "log-split", "orders", "dau"):
        job(name, *(["--as-of", "2024-01-31"] if name in ("orders", "dau") else []))
    main.run(streams, main.arguments(["compact", "--store", store, "--table", "orders", "--day", "2024-01-02"]))
    order = read_current(streams, f"{store}/docs/orders", ORDER_WIDE_STORED, "detail_id", "dt").first()
    assert (order.user_gender, order.user_age, order.province_name, order.province_area_code) == ("M", 34, "P", "7")
    assert read_current(streams, f"{store}/docs/dau", DAU_INFO, "mid", "dt").first().user_gender == "M"
    written = streams.read.parquet(f"{store}/topics/_topic={S.START_TOPIC}")
    assert written.count() == 1 and set(S.TOPIC_RECORD.names) <= set(written.columns)
    assert streams.read.parquet(f"{store}/topics/_topic={S.CORRUPT_TOPIC}").first().value == "broken"


def test_missing_table_lists_fail_the_batch(streams, tmp_path):
    from tidewise import schemas as S
    from tidewise.streaming import main

    store = str(tmp_path)
    push(streams, f"{store}/topics/{S.RAW_CDC_TOPIC}", {"table": "user_info", "type": "insert", "ts": 1, "data": {"id": 1}})
    args = main.arguments(["cdc-route", "--store", store, "--checkpoint", f"{store}/cp", "--once"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        main.run(streams, args)


LATE = "2024-01-10 12:00:00"


def test_order_that_arrives_whole_but_late_is_stored(streams, tmp_path):
    root = str(tmp_path)
    for day in ("2024-01-10 10:00:00", "2024-01-10 11:00:00"):
        push(streams, f"{root}/info", head(1, day), at=day)
        push(streams, f"{root}/detail", line(11, 1, day), at=day)
        run_orders(streams, root)
    old = "2024-01-02 12:00:00"
    push(streams, f"{root}/info", head(2, old), at=LATE)
    push(streams, f"{root}/detail", line(21, 2, old), at=LATE)
    assert set(run_orders(streams, root)) == {11, 21}


def test_newest_header_wins_on_old_and_new_lines(streams, tmp_path):
    root = str(tmp_path)
    noon = "2024-01-02 12:00:00"
    push(streams, f"{root}/info", {**head(1, noon), "order_status": "A", "operate_time": noon}, at=noon)
    push(streams, f"{root}/detail", line(11, 1, noon), at=noon)
    run_orders(streams, root)
    newer = {**head(1, noon), "order_status": "B", "operate_time": "2024-01-02 13:00:00"}
    push(streams, f"{root}/info", newer, at=noon)
    push(streams, f"{root}/detail", line(12, 1, noon), at=noon)
    run_orders(streams, root)
    # The older header once more does not take the newer one's place.
    push(streams, f"{root}/info", {**head(1, noon), "order_status": "A", "operate_time": noon, "total_amount": 6.0}, at=noon)
    assert {d.order_status for d in run_orders(streams, root).values()} == {"B"}


def test_device_of_a_day_long_past_counts_once(streams, tmp_path):
    root = str(tmp_path)
    now = T0 + 9 * DAY
    push(streams, f"{root}/in", page("a", now), at="2024-01-10 12:00:00")
    run_dau(streams, root)
    push(streams, f"{root}/in", page("b", now - 5 * DAY, item="first"), at="2024-01-10 13:00:00")
    assert run_dau(streams, root).where("mid = 'b'").first().dt == "2024-01-05"
    # Days later the state has forgotten b; the stored document has not.
    push(streams, f"{root}/in", page("z", now + 5 * DAY), at="2024-01-15 12:00:00")
    run_dau(streams, root)
    push(streams, f"{root}/in", page("b", now - 5 * DAY + 1, item="again"), at="2024-01-15 13:00:00")
    assert [r.page_item for r in run_dau(streams, root).where("mid = 'b'").collect()] == ["first"]


def test_any_cut_into_batches_gives_the_same_dimensions(streams, tmp_path):
    def change(id, ts, name):
        return {"table": "user_info", "type": "update", "ts": ts, "data": {"id": id, "name": name}}

    changes = [change(1, 3, "new"), change(1, 2, "old"), change(2, 1, "x"), change(1, 1, "first"), change(2, 5, "y")]
    results = []
    for cut in ([5], [1, 4], [1, 1, 1, 1, 1]):
        root = str(tmp_path / "-".join(map(str, cut)))
        lists = streams.createDataFrame([("DIM:TABLES", "user_info")], TABLE_LIST)
        at = 0
        for n in cut:
            push(streams, f"{root}/in", *changes[at : at + n])
            at += n
            jobs.cdc_route(
                file_topic(streams, f"{root}/in"), lambda s: lists, f"{root}/dims", f"{root}/cp", path=f"{root}/facts", trigger=ONCE
            ).awaitTermination()
        rows = read_current(streams, f"{root}/dims", DIM_ROW, "id", "table_name").collect()
        results.append(sorted((r.id, r.ts) for r in rows))
    assert results == [[("1", 3), ("2", 5)]] * 3


def test_unreadable_records_are_counted(streams, tmp_path):
    root = str(tmp_path)
    push(streams, f"{root}/in", page("a", T0), "broken", {"mid": None, "ts": T0}, {"mid": "b"})
    users, provinces = dims(streams)
    query = jobs.dau_documents(
        file_topic(streams, f"{root}/in"), users, provinces, f"{root}/docs", f"{root}/cp", "2024-01-31", trigger=ONCE
    )
    query.awaitTermination()
    seen = next(p["observedMetrics"]["page_quality"] for p in query.recentProgress if p["numInputRows"])
    assert (seen["records"], seen["corrupt"], seen["no_key"]) == (4, 1, 2) and jobs.dropped(query) == 0
    assert read_current(streams, f"{root}/docs", DAU_INFO, "mid", "dt").count() == 1


def test_batches_that_leave_nothing(streams, tmp_path):
    """Batches whose rows are all filtered, repeated or unmatched must pass, and write nothing."""
    root = str(tmp_path)
    push(streams, f"{root}/in", page("a", T0, last="x"))
    assert run_dau(streams, root).isEmpty()
    push(streams, f"{root}/in", page("a", T0))
    push(streams, f"{root}/in", page("a", T0 + 1))
    assert run_dau(streams, root).count() == 1
    push(streams, f"{root}/o/info", head(1, "2024-01-02 12:00:00"))
    push(streams, f"{root}/o/detail", line(21, 2, "2024-01-02 12:00:00"), at="2024-01-02 12:00:00")
    orders_root = f"{root}/o"
    assert run_orders(streams, orders_root) == {}


def test_a_large_landed_file_is_read_by_several_tasks(streams, tmp_path):
    """Its row groups are small and a task takes some of them, so what one task reads does not grow with the topic."""
    import pyarrow.parquet as pq

    from tidewise.sources.topics import land

    noise = F.concat(*[F.sha2(F.concat("id", F.lit(n)), 512) for n in range(4)])
    rows = streams.range(150_000).select(F.col("id").alias("key"), noise.alias("value"), F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"))
    land(rows, "t", f"{tmp_path}/t", pieces=1)
    (file,) = [f for f in (tmp_path / "t").glob("*.parquet") if f.stat().st_size > 1_000_000]
    assert pq.ParquetFile(file).num_row_groups > 1
    assert streams.conf.get("spark.sql.files.maxPartitionBytes") == "32m"


def test_an_order_batch_leaves_no_shuffle_files_and_packed_state(spark, streams, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = blocks.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    root, noon, before = str(tmp_path), "2024-01-02 12:00:00", shuffles()
    push(streams, f"{root}/info", *[head(n, noon) for n in range(50)])
    push(streams, f"{root}/detail", *[line(100 + n, n, noon) for n in range(50)], at=noon)
    assert len(run_orders(streams, root)) == 50
    assert not shuffles() - before
    logs_of_state = list((tmp_path / "cp" / "state").rglob("*.changelog"))
    assert logs_of_state and {file.read_bytes()[:4] for file in logs_of_state} == {b"\x28\xb5\x2f\xfd"}  # zstd


def test_order_state_is_asked_in_the_order_in_which_it_lies(streams, tmp_path):
    """Rows come to the order job's state sorted as its store sorts keys, by the shuffle that the state asks for anyway."""
    import struct

    from tidewise.streaming import state

    root, noon = str(tmp_path), "2024-01-02 12:00:00"
    push(streams, f"{root}/info", head(1, noon))
    push(streams, f"{root}/detail", line(11, 1, noon), at=noon)
    users, provinces = dims(streams)
    before = streams.conf.getAll
    query = jobs.order_documents(
        file_topic(streams, f"{root}/info"), file_topic(streams, f"{root}/detail"), users, provinces, f"{root}/docs", f"{root}/cp", trigger=ONCE
    )
    query.awaitTermination()
    assert streams.conf.getAll == before
    plan = query._jsq.explainInternal(False).split("StreamingSymmetricHashJoin")[1]
    first = [text.strip(" :|+-").split(" ")[:2] for text in plan.splitlines()[1:]]
    steps = [words[1] if words[0].startswith("*") else words[0] for words in first if words[0]]
    assert steps.count("Exchange") == steps.count("Sort") == 3
    assert all(steps[i + 1] == "Exchange" for i, step in enumerate(steps) if step == "Sort")
    ids = [0, 1, 2, 127, 128, 255, 256, 257, 65_536, 1 << 40, (1 << 63) - 1, -1, -256]
    rows = streams.createDataFrame([(i,) for i in ids], "id LONG").coalesce(1).sortWithinPartitions(state.stored_order(F.col("id")))
    assert [r.id for r in rows.collect()] == sorted(ids, key=lambda i: struct.pack("<q", i))
    # No count of a store's rows is kept: it asks for each key once more before it is written.
    assert {op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]} == {0}
