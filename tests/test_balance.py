"""The kept account of records: what it takes from progress, replays, and that it adds up."""

from pyspark.sql import functions as F

from tidewise.operators import cdc, logs
from tidewise.schemas import RAW_CDC_TOPIC
from tidewise.sources import samples
from tidewise.sources.topics import land
from tidewise.streaming import balance, main


def progress(late=0, **observed):
    return {"observedMetrics": observed, "stateOperators": [{"numRowsDroppedByWatermark": late}]}


def test_counts_of_a_batch():
    assert balance.counts_of({"stateOperators": []}) == []
    assert balance.counts_of(progress(3)) == []
    got = balance.counts_of(progress(3, page_quality={"records": 9, "corrupt": 0, "no_key": None}))
    assert got == [("page_quality", "records", 9), ("page_quality", "corrupt", 0), ("late", "page_quality", 3)]


def test_a_replayed_batch_replaces_its_counts(spark, tmp_path):
    path = str(tmp_path / "account")
    entries = {"records": 5}
    for batch, read, late in ((0, 7, 0), (1, 90, 9), (1, 10, 1)):
        quality = {"records": read, "corrupt": 1, "no_key": 1}
        counts = balance.counts_of(progress(late, page_quality=quality, entries=entries, first_seen={"records": 2}))
        balance.write_counts(spark, path, "q", batch, counts, "progress")
    got = {(r.source, r.fate): r.n for r in balance.balance(spark, path).collect()}
    assert {fate: n for (source, fate), n in got.items() if source == "page"} == {
        "read": 17, "corrupt": 2, "no_key": 2, "later_page": 3, "first": 4, "late": 1, "repeated": 5
    }
    for source in ("raw log", "change", "page", "order header", "order line"):
        assert got[source, "read"] == sum(n for (of, fate), n in got.items() if of == source and fate != "read")
    assert got["change", "read"] == 0


def test_each_record_has_one_fate(spark):
    texts = ['{"err": {"error_code": 1}, "page": {"page_id": "p"}}', '{"page": {"page_id": "p"}, "start": {"entry": "icon"}}', '{"start": {"entry": "icon"}}']
    rows = spark.createDataFrame([(t,) for t in [*texts, "{}", "{broken", "", None]], "value string")
    assert logs.parse_logs(rows).agg(*logs.route_counts()).first().asDict() == {"corrupt": 3, "error": 1, "page": 1, "start": 1}
    changes = ['{"table": "user_info", "type": "insert"}', '{"table": "user_info", "type": "ddl"}', '{"table": "t", "type": "delete"}', '{"table": "sku_info", "type": "update"}']
    parsed = cdc.parse_cdc(spark.createDataFrame([(t,) for t in [*changes, "{broken", None]], "value string"))
    counts = cdc.route_counts(parsed, samples.table_lists(spark)).first().asDict()
    assert counts == {"records": 6, "corrupt": 2, "no_change": 1, "unlisted": 1}


def test_topics_are_made_in_many_tasks_however_few_read(spark, sf_dir):
    """What is read is dealt out before messages are made of it, and the messages are the same."""
    for records in (samples.raw_log_records, samples.cdc_records):
        dealt, whole = records(spark, sf_dir, 6), records(spark, sf_dir)
        assert dealt.rdd.getNumPartitions() == 6
        plan = dealt._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("RepartitionByExpression")
        assert "StructsToJson" in above and "StructsToJson" not in below
        assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()


def test_a_batch_of_few_files_is_read_by_many_tasks(spark, sf_dir, tmp_path):
    """A landed file of some MB has pieces enough for the tasks of a batch."""
    import pyarrow.parquet as pq

    records = samples.cdc_records(spark, sf_dir)
    many = records.crossJoin(spark.range(32).select("id")).drop("id").withColumn("timestamp", F.current_timestamp())
    wide = many.withColumn("value", F.concat("value", *[F.sha2(F.concat("offset", F.rand()), 512) for _ in range(4)]))
    land(wide, RAW_CDC_TOPIC, f"{tmp_path}/t", pieces=1)
    (file,) = [f for f in (tmp_path / "t").glob("*.parquet")]
    of = pq.ParquetFile(file).metadata
    assert of.num_row_groups > 1
    assert max(of.row_group(i).total_byte_size for i in range(of.num_row_groups)) < 24 << 20


def test_the_command_line_keeps_the_account(spark, tmp_path):
    store = str(tmp_path)
    samples.table_lists(spark).write.parquet(f"{store}/lists")
    texts = ['{"table": "user_info", "type": "insert", "ts": 1, "data": {"id": 1}}', "{broken", '{"table": "t", "type": "insert", "data": {"id": 2}}']
    rows = spark.createDataFrame([(None, t, i, 0.0) for i, t in enumerate(texts)], "key string, value string, offset long, timestamp double")
    land(rows, RAW_CDC_TOPIC, f"{store}/topics/{RAW_CDC_TOPIC}")
    options = ["cdc-route", "--store", store, "--checkpoint", f"{store}/cp", "--once", "--account", "--state-partitions", "2"]
    main.run(spark, main.arguments(options))
    got = {r.fate: r.n for r in balance.balance(spark, f"{store}/account").where("source = 'change'").collect()}
    assert got == {"read": 3, "corrupt": 1, "no_change": 0, "unlisted": 1, "routed": 1}
