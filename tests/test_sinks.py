import os

import pytest

from tidewise.schemas import TABLE_LIST
from tidewise.sinks import topics, upsert as table
from tidewise.sources import topics as source
from tidewise.sources.tables import table_lists
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC = T.StructType().add("id", "long").add("v", "string").add("n", "long").add("dt", "string")


@pytest.fixture
def write(spark, tmp_path):
    path = str(tmp_path / "docs")

    def put(rows, batch, **kwargs):
        table.upsert(spark.createDataFrame(rows, DOC), path, "id", "dt", batch, order=("n",), **kwargs)

    return path, put


def current(spark, path):
    return {(r.dt, r.id): r.v for r in table.read_current(spark, path, DOC, "id", "dt").collect()}


def test_upsert_and_replay(spark, write):
    path, put = write
    put([(1, "a", 1, "d1"), (1, "b", 2, "d1"), (2, "c", 1, "d2")], "q-0")
    put([(1, "z", 1, "d1"), (3, "d", 1, "d1")], "q-1")
    once = current(spark, path)
    assert once == {("d1", 1): "z", ("d2", 2): "c", ("d1", 3): "d"}
    put([(1, "z", 1, "d1"), (3, "d", 1, "d1")], "q-1")
    assert current(spark, path) == once
    assert table.read_current(spark, path, DOC, "id", "dt").schema == DOC


def test_mixed_days_are_filed_by_their_own_day(spark, write):
    path, put = write
    put([(1, "a", 1, "2024-01-01"), (1, "b", 1, "2024-01-02")], "q-0")
    assert current(spark, path) == {("2024-01-01", 1): "a", ("2024-01-02", 1): "b"}


def test_new_checkpoint_does_not_overwrite_old_batches(spark, write):
    path, put = write
    put([(1, "a", 1, "d")], "first-0")
    put([(2, "b", 1, "d")], "second-0")
    assert current(spark, path) == {("d", 1): "a", ("d", 2): "b"}


def test_compaction_keeps_the_current_rows(spark, write):
    path, put = write
    for n in range(4):
        put([(1, f"v{n}", n, "d"), (n + 10, "x", 0, "d"), (5, "other", 0, "e")], f"q-{n}")
    before = current(spark, path)
    table.compact(spark, path, DOC, "id", "dt", "d")
    assert current(spark, path) == before and before[("d", 1)] == "v3"
    assert len([f for f in os.listdir(f"{path}/dt=d") if f.startswith("_batch")]) == 1
    put([(1, "new", 9, "d")], "q-9")
    assert current(spark, path)[("d", 1)] == "new"


def test_crash_between_the_steps_of_a_compaction(spark, write):
    """Folded and unfolded folders side by side give the same rows."""
    path, put = write
    put([(1, "a", 1, "d")], "q-0", seq=5)
    put([(1, "a", 1, "d")], "compact-1", seq=5)
    assert current(spark, path) == {("d", 1): "a"}


def test_missing_table_is_empty(spark, tmp_path):
    assert table.read_current(spark, str(tmp_path / "none"), DOC, "id", "dt").isEmpty()
    assert table_lists(spark, str(tmp_path / "none")).schema == TABLE_LIST


def test_day_filter_prunes_folders_and_columns(spark, write):
    path, put = write
    put([(1, "a", 1, "d1"), (2, "b", 1, "d2")], "q-0")
    day = table.read_current(spark, path, DOC, "id", "dt", columns=["v"]).where("dt = 'd1'")
    assert [r.id for r in day.collect()] == [1]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "ReadSchema: struct<id:bigint,v:string,_seq:bigint,_version:string>" in plan


def test_batch_topic_files_replace_on_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("t1", "k", "v"), ("t2", "k", "w")], "topic STRING, key STRING, value STRING")
    for _ in range(2):
        topics.batch_to_files(rows, path, "q-0")
    topics.batch_to_files(rows.where("topic = 't1'").drop("key"), path, "q-1")
    written = spark.read.schema("key STRING, value STRING, topic STRING").parquet(path).collect()
    assert sorted((r.topic, r.key) for r in written if r.key) == [("t1", "k"), ("t2", "k")] and len(written) == 3


def test_kafka_options():
    assert source.kafka_options("h:1", "t")["startingOffsets"] == "latest"
    stored = source.kafka_options("h:1", "t", {("t", 1): 7, ("t", 0): 5}, max_offsets=100, min_partitions=8)
    assert stored["startingOffsets"] == '{"t": {"0": 5, "1": 7}}'
    assert stored["maxOffsetsPerTrigger"] == "100" and stored["minPartitions"] == "8"
    sink = topics.kafka_options("h:1")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_days_with_one_batch_need_no_shuffle(spark, write):
    path, put = write
    put([(1, "a", 1, "d1"), (2, "b", 1, "d2")], "q-0")
    put([(2, "c", 1, "d2"), (3, "d", 1, "d3")], "q-1")

    def read(*days):
        return table.read_days(spark, path, DOC, "id", "dt", days, columns=["v"])

    assert sorted(tuple(r) for r in read("d1", "d2", "d9").collect()) == [("d1", 1, "a"), ("d2", 2, "c")]
    assert read("d9").isEmpty() and table.read_days(spark, path + "x", DOC, "id", "dt", ["d1"]).isEmpty()
    assert "Exchange" not in read("d1", "d3")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in read("d2")._jdf.queryExecution().executedPlan().toString()
    table.compact(spark, path, DOC, "id", "dt", "d2")
    assert "Exchange" not in read("d2")._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in read("d2").collect()] == [("d2", 2, "c")]
    assert table.read_days(spark, path, DOC, "id", "dt", ["d1", "d2"]).schema.names == DOC.names


def buckets_of(path, value):
    return sorted(f for f in os.listdir(f"{path}/dt={value}") if f.startswith("_bucket="))


def test_buckets_open_only_what_may_hold_the_keys(spark, write):
    path, put = write
    put([(i, f"v{i}", 1, "d") for i in range(200)] + [(1, "e", 1, "e")], "q-0", buckets=16)
    put([(i, f"w{i}", 2, "d") for i in range(0, 200, 2)], "q-1", buckets=16)
    assert len(buckets_of(path, "d")) == 16 and len(buckets_of(path, "e")) == 1

    def read(ids, buckets=16):
        only = spark.createDataFrame([(i,) for i in ids], "id long")
        return table.read_current(spark, path, DOC, "id", "dt", only=only, values=["d"], buckets=buckets)

    few = read([7, 8, 999])
    assert {(r.id, r.v) for r in few.collect()} == {(7, "v7"), (8, "w8")}
    opened = {f.split("_bucket=")[1].split("/")[0] for f in few.inputFiles()}
    assert len(opened) <= 3 and all("dt=d/" in f for f in few.inputFiles())
    assert read([]).isEmpty() and current(spark, path)[("d", 8)] == "w8"
    assert {(r.id, r.v) for r in read([7, 8], buckets=0).collect()} == {(7, "v7"), (8, "w8")}
    # Another number of buckets from now on: the old folders are all read.
    put([(7, "x7", 3, "d")], "q-2", buckets=4)
    assert {(r.id, r.v) for r in read([7, 8], buckets=4).collect()} == {(7, "x7"), (8, "w8")}
    before = current(spark, path)
    table.compact(spark, path, DOC, "id", "dt", "d", buckets=4)
    assert current(spark, path) == before and {(r.id, r.v) for r in read([7, 8], buckets=4).collect()} == {(7, "x7"), (8, "w8")}
    assert all(f.startswith("_bucket=4-") for f in buckets_of(path, "d") if os.listdir(f"{path}/dt=d/{f}"))


def test_folded_folders_stay_for_those_who_have_listed_them(spark, write):
    path, put = write
    for n in range(3):
        put([(1, f"v{n}", n, "d"), (n + 10, "x", 0, "d")], f"q-{n}")
    listed = table.read_days(spark, path, DOC, "id", "dt", ["d"])
    table.compact(spark, path, DOC, "id", "dt", "d", grace=3600)
    after = table.read_days(spark, path, DOC, "id", "dt", ["d"])
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, after.collect()))
    assert len([f for f in os.listdir(f"{path}/dt=d") if f.startswith("_batch")]) == 4
    assert len({f.rsplit("/", 1)[0] for f in after.inputFiles()}) == 1
    assert current(spark, path) == {("d", 1): "v2", ("d", 10): "x", ("d", 11): "x", ("d", 12): "x"}
    # A replay of a folded batch puts it back with the rows that it had: the folded ones are as new.
    put([(1, "v2", 2, "d"), (12, "x", 0, "d")], "q-2", seq=1)
    assert current(spark, path)[("d", 1)] == "v2"
    table.compact(spark, path, DOC, "id", "dt", "d", grace=3600)
    table.compact(spark, path, DOC, "id", "dt", "d")
    assert len([f for f in os.listdir(f"{path}/dt=d") if f.startswith("_batch")]) == 1
    assert current(spark, path)[("d", 1)] == "v2"


def test_readers_and_writers_go_on_during_compactions(spark, write):
    """A writer adds a batch after the other, a reader asks for all keys, while the partition is folded again and again."""
    import threading

    path, put = write
    put([(i, "0", 0, "d") for i in range(20)], "q-0", seq=0)
    done, failures, seen = threading.Event(), [], []

    def guarded(work):
        def run():
            try:
                work()
            except Exception as error:  # noqa: BLE001
                failures.append(error)
                done.set()

        return threading.Thread(target=run)

    def writes():
        for n in range(1, 9):
            put([(i, str(n), n, "d") for i in range(n % 3, 20, 3)], f"q-{n}", seq=n)
        done.set()

    def reads():
        while not done.is_set():
            rows = {r.id: int(r.v) for r in table.read_days(spark, path, DOC, "id", "dt", ["d"]).collect()}
            assert sorted(rows) == list(range(20))
            seen.append(rows)

    threads = [guarded(writes), guarded(reads)]
    for t in threads:
        t.start()
    while not done.is_set():
        table.compact(spark, path, DOC, "id", "dt", "d", grace=3600)
    for t in threads:
        t.join()
    assert not failures
    assert all(b[k] >= a[k] for a, b in zip(seen, seen[1:]) for k in a)
    expected = {("d", i): str(max(n for n in range(9) if n == 0 or i % 3 == n % 3)) for i in range(20)}
    assert current(spark, path) == expected
    table.compact(spark, path, DOC, "id", "dt", "d")
    assert current(spark, path) == expected and len([f for f in os.listdir(f"{path}/dt=d") if f.startswith("_batch")]) == 1


def test_whole_tables_of_one_batch_a_day_need_no_shuffle(spark, write, tmp_path):
    path, put = write
    put([(1, "a", 1, "d1"), (1, "b", 2, "d1"), (2, "c", 1, "d2")], "q-0")
    current = table.read_current(spark, path, DOC, "id", "dt", plain=True)
    assert "Exchange" not in current._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.v, r.dt) for r in current.collect()) == [(1, "b", "d1"), (2, "c", "d2")]
    copy = f"{tmp_path}/copy"
    table.upsert(current, copy, "id", "dt", "c-0", unique=True)
    table.upsert(current.where("id = 1").withColumn("v", F.lit("z")), copy, "id", "dt", "c-1", unique=True)
    again = table.read_current(spark, copy, DOC, "id", "dt", plain=True)
    assert sorted((r.id, r.v, r.dt) for r in again.collect()) == [(1, "z", "d1"), (2, "c", "d2")]
    assert again.columns == table.read_current(spark, copy, DOC, "id", "dt").columns
