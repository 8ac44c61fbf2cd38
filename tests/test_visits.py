"""Visits, the page table by day, device bitmaps, and the hourly stream."""

import random

import pytest
from pyspark.sql import functions as F
from test_skew import SMALL, final_plan, keep, settings
from test_streams import DAY, ONCE, T0, page, push

from tidewise.operators import dau, sessions, uv
from tidewise.plans.queries import QUERIES
from tidewise.schemas import DEVICES, HOURLY_ACTIVES, PAGE_DAY
from tidewise.sinks import days
from tidewise.sinks import uv as uv_store
from tidewise.sources.topics import file_topic
from tidewise.streaming import jobs

COLUMNS = "mid STRING, ts LONG, last_page_id STRING, page_id STRING, page_item STRING, channel STRING, is_new STRING, during_time LONG, dt STRING"


def log(n: int) -> list[tuple]:
    random.seed(n)
    rows = []
    for _ in range(n):
        ts = random.choice([None, *[random.randrange(0, 200)] * 20])
        last = random.choice([None, None, "", "home", "x"])
        rows.append((random.choice(["a", "b", "c", "", None]), ts, last, random.choice(["p", "q"]), random.choice(["1", None]), "ch", random.choice("01"), 10, "d"))
    return rows


def plain(rows: list[tuple]) -> list[tuple]:
    """(mid, visit, begin, pages, entry page, new, millis) one page after the other."""
    out = []
    for mid in {r[0] for r in rows if r[0] is not None}:
        mine = [r for r in rows if r[0] == mid and r[1] is not None]
        mine.sort(key=lambda r: (r[1], r[2] is not None, r[3], r[4] is not None, r[4] or "", r[2] or ""))
        visit, held = 0, {}
        for r in mine:
            visit += r[2] is None
            held.setdefault(visit, []).append(r)
        out += [(mid, v, rs[0][1], len(rs), rs[0][3], int(any(r[6] == "1" for r in rs)), 10 * len(rs)) for v, rs in held.items()]
    return sorted(out)


@pytest.mark.parametrize("slice_ms", [1, 7, 1000])
def test_visits_are_runs_between_entries(spark, slice_ms):
    rows = log(400)
    found = sessions.visits(spark.createDataFrame(rows, COLUMNS).repartition(3), slice_ms)
    got = found.select("mid", "visit", "begin", "pages", "entry_page", "is_new", "millis").collect()
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_no_visits_without_pages(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert sessions.visits(none).count() == 0 and sessions.with_visit(none).columns == [*none.columns, "visit"]


def test_hot_device_is_cut_into_slices(spark, tmp_path):
    """One device has all pages; no task puts more than a slice of them in order."""
    n = 20_000
    rows = spark.range(0, n, 1, 8).select(
        F.lit("bot").alias("mid"), (F.col("id") * 6_000).alias("ts"), F.when(F.col("id") % 10 > 0, "x").alias("last_page_id"),
        F.lit("p").alias("page_id"), F.lit("1").alias("page_item"), F.lit("c").alias("channel"), F.lit("0").alias("is_new"),
        F.lit(1).cast("long").alias("during_time"), F.lit("d").alias("dt"),
    )
    rows = keep(rows, f"{tmp_path}/pages")
    with settings(spark, {**SMALL, "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        numbered = sessions.with_visit(rows)
        spread = numbered.groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) >= 4 and max(r["count"] for r in spread) < n / 2
        assert sessions.visits(rows).agg(F.count("*"), F.min("pages"), F.max("pages")).first()[:] == (n // 10, 10, 10)


PAGE_FIGURES = ["pv_count", "new_visit_stats", "channel_pv", "channel_bounce", "page_path", "user_action_convert", "visit_sessions", "visit_total"]


@pytest.mark.parametrize("name", PAGE_FIGURES)
def test_page_figures_read_their_days_only(spark, sf_dir, name):
    plan = final_plan(QUERIES[name](spark, sf_dir))
    assert "from_json" not in plan and "jsontostructs" not in plan
    if name != "visit_sessions":
        assert "PartitionFilters: [isnotnull(dt" in plan
    files = QUERIES[name](spark, sf_dir).inputFiles()
    assert files and {f.split("dt=")[1][:10] for f in files if "dt=" in f} <= set(days.days_up_to("2024-01-15", 7))


@pytest.mark.parametrize("name", ["uv_count", "uv_period"])
def test_device_counts_read_bitmaps_only(spark, sf_dir, name):
    files = QUERIES[name](spark, sf_dir).inputFiles()
    assert files and all("/uv-" in f and "/days/dt=" in f for f in files)


def write_pages(spark, path, batch, *rows):
    columns = "mid STRING, is_new STRING, dt STRING"
    given = spark.createDataFrame(rows, columns)
    full = given.select(*[(F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in PAGE_DAY])
    days.write_days(full, path, batch)


def test_bitmaps_over_runs(spark, tmp_path):
    pages, store = f"{tmp_path}/pages", f"{tmp_path}/uv"
    rows = [(f"m{i}", "1" if i % 3 == 0 else "0", f"2024-01-0{1 + i % 2}") for i in range(300)]
    write_pages(spark, pages, "b-0", *rows, ("m0", "0", "2024-01-01"), (None, "1", "2024-01-01"), ("gone", "1", None))
    period = ["2024-01-01", "2024-01-02", "2024-01-03"]
    uv_store.add_days(spark, pages, store, period)
    first = {r.mid: r.number for r in uv_store.devices(spark, store).collect()}
    assert sorted(first.values()) == list(range(1, 301))
    more = [(f"m{i}", "0", "2024-01-03") for i in range(250, 350)] + [("m1", "1", "2024-01-01")]
    write_pages(spark, pages, "b-1", *more)
    for _ in range(2):
        uv_store.add_days(spark, pages, store, ["2024-01-01", "2024-01-03"])
    later = {r.mid: r.number for r in uv_store.devices(spark, store).collect()}
    assert uv_store.devices(spark, store).schema == DEVICES
    assert first.items() <= later.items() and sorted(later.values()) == list(range(1, 351))
    read = uv_store.bitmaps(spark, store, period)
    assert {r.dt: r.uv for r in uv.uv_by_day(read).collect()} == {"2024-01-01": 151, "2024-01-02": 150, "2024-01-03": 100}
    assert uv.uv_period(read).first()[:] == (350, 101)
    assert uv.uv_period(uv_store.bitmaps(spark, store, ["2024-02-01"])).first()[:] == (0, 0)


def test_numbers_go_beyond_one_bitmap(spark):
    fresh = spark.range(0, 70_000, 1, 5).select(F.concat(F.lit("m"), "id").alias("mid"), F.monotonically_increasing_id().alias("place"))
    devices = uv.numbered(fresh, 1000).persist()
    assert devices.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()[:] == (1001, 71_000, 70_000)
    seen = devices.select("mid", F.lit("1").alias("is_new"), F.lit("d").alias("dt")).where("number % 7 > 0")
    bitmaps = uv.day_bitmaps(seen, devices)
    assert bitmaps.where("kind = 'all'").count() == 3 and uv.uv_period(bitmaps).first()[:] == (60_000, 60_000)
    devices.unpersist()


def test_log_split_files_pages_by_day(streams, tmp_path):
    root = str(tmp_path)

    def run():
        stream = file_topic(streams, f"{root}/in", 1)
        jobs.log_split(stream, f"{root}/cp", path=f"{root}/topics", pages=f"{root}/pages", trigger=ONCE).awaitTermination()

    def record(mid, ts, **more):
        return {"common": {"mid": mid}, "page": {"page_id": "p"}, "ts": ts, **more}

    push(streams, f"{root}/in", record("a", T0), record("b", T0 + DAY, displays=[{"item": "1"}]), record("c", T0, err={"msg": "m"}), "bad")
    run()
    push(streams, f"{root}/in", record("a", T0 + 1), {"common": {"mid": "d"}, "start": {"entry": "i"}, "ts": T0})
    run()
    run()
    stored = days.read_days(streams, f"{root}/pages", PAGE_DAY, ["2024-01-01", "2024-01-02", "2024-01-03"])
    assert stored.columns == PAGE_DAY.names
    assert sorted((r.mid, r.dt, r.hr) for r in stored.collect()) == [("a", "2024-01-01", "00"), ("a", "2024-01-01", "00"), ("b", "2024-01-02", "00")]
    topics = streams.read.schema("value STRING, topic STRING").parquet(f"{root}/topics").groupBy("topic").count()
    assert sum(r["count"] for r in topics.collect()) == 7


@pytest.fixture
def hourly(spark):
    from tidewise.session import stream_session

    return stream_session(spark, 2, idle_batches=True)


def test_hours_of_a_day_are_written_once_it_is_over(hourly, tmp_path):
    root, hour = str(tmp_path), 3_600_000

    def run():
        query = jobs.hourly_actives(file_topic(hourly, f"{root}/in"), f"{root}/hours", f"{root}/cp", trigger=ONCE)
        query.awaitTermination()
        read = days.read_days(hourly, f"{root}/hours", HOURLY_ACTIVES, days.days_up_to("2024-01-05", 5))
        return sorted((r.dt, r.hr, r.n) for r in read.collect()), jobs.dropped(query)

    push(hourly, f"{root}/in", page("a", T0 + 5 * hour), page("b", T0 + 5 * hour), page("c", T0, last="x"), page("a", T0 + 9 * hour))
    assert run()[0] == []
    # Day two begins, yet day one is not closed: what comes late may still be earlier than what came first.
    push(hourly, f"{root}/in", page("a", T0 + DAY + hour), page("a", T0 + 3 * hour), page("d", T0 + 23 * hour))
    assert run()[0] == []
    push(hourly, f"{root}/in", page("e", T0 + DAY + 3 * hour))
    day_one = [("2024-01-01", "03", 1), ("2024-01-01", "05", 1), ("2024-01-01", "23", 1)]
    assert run()[0] == day_one
    push(hourly, f"{root}/in", page("z", T0 + 4 * hour), page("a", T0 + 2 * DAY), page("a", T0 + 3 * DAY))
    found, late = run()
    assert found == [*day_one, ("2024-01-02", "01", 1), ("2024-01-02", "03", 1), ("2024-01-03", "00", 1)][: len(found)]
    assert late == 1 and ("2024-01-02", "01", 1) in found
    assert run()[0] == found


def test_days_are_in_the_session_zone(spark):
    assert dau.with_day(spark.createDataFrame([(T0,)], "ts LONG")).first()[1:] == ("2024-01-01", "00")
