"""Run one job from the command line or spark-submit.

    python -m tidewise.streaming.main dau --servers host:9092 --store /shared/store --checkpoint /shared/cp/dau
    python -m tidewise.streaming.main compact --store /shared/store --table dau --day 2024-01-15
    python -m tidewise.streaming.main uv --store /shared/store --day 2024-01-15 --days 2

Without ``--servers`` a topic is a folder below ``<store>/topics``, both for the jobs that write it and those that read it.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..session import build_session, stream_session
from ..sinks import postings
from ..sinks.days import days_up_to
from ..sinks.upsert import compact, read_days
from ..sinks.uv import add_days
from ..sources import tables
from ..sources.topics import file_topic, kafka_topic, topic_folder
from . import jobs
from .balance import Account
from .state import SLICES

# Table name -> (folder, schema, key, partition column, buckets) of the stored documents.
STORES = {
    "dau": ("docs/dau", S.DAU_INFO, "mid", "dt", 0),
    "orders": ("docs/orders", S.ORDER_WIDE_STORED, "detail_id", "dt", 0),
    "dims": ("dims", S.DIM_ROW, "id", "table_name", tables.DIM_BUCKETS),
}
JOBS = ["log-split", "cdc-route", "dau", "hourly", "orders"]


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=[*JOBS, "compact", "uv", "postings"])
    parser.add_argument("--store", required=True, help="shared folder of topics, dimensions, table lists and documents")
    parser.add_argument("--checkpoint", help="shared folder of this job's checkpoint")
    parser.add_argument("--servers", help="Kafka servers; without them topics are folders")
    parser.add_argument("--positions", help='JSON {"topic": {"partition": offset}} for a first start')
    parser.add_argument("--max-offsets", type=int, help="records per batch and topic")
    parser.add_argument("--state-partitions", type=int, help="fixed when the checkpoint is created")
    parser.add_argument("--restore-day", help="dau only: day whose stored devices stand in for a lost checkpoint")
    parser.add_argument("--delay", help="how much later than others a record may arrive, like '24 hours'")
    parser.add_argument("--keep", default="72 hours", help="orders only: how long headers and lines wait for each other")
    parser.add_argument("--slices", type=int, default=SLICES, help="orders only: state partitions an order's lines are spread over")
    parser.add_argument("--as-of", help="the date that ages are counted at; default: today")
    parser.add_argument("--account", action="store_true", help="keep what each batch read and where it went in <store>/account")
    parser.add_argument("--once", action="store_true", help="work off what is there, then stop")
    parser.add_argument("--table", choices=list(STORES), help="compact only")
    parser.add_argument("--day", help="compact: the partition to fold; uv, postings: the last of the days")
    parser.add_argument("--grace", type=float, default=3600, help="compact only: seconds that folded folders are kept for running queries")
    parser.add_argument("--days", type=int, default=1, help="uv, postings: how many days up to --day got rows since the last run")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "compact":
        folder, schema, key, part, buckets = STORES[args.table]
        compact(spark, f"{args.store}/{folder}", schema, key, part, args.day, args.grace, buckets)
        return
    if args.job == "uv":
        add_days(spark, f"{args.store}/pages", f"{args.store}/uv", days_up_to(args.day, args.days))
        return
    if args.job == "postings":
        folder, schema, key, part, _ = STORES["orders"]
        docs = read_days(spark, f"{args.store}/{folder}", schema, key, part, days_up_to(args.day, args.days), ["sku_name"])
        postings.add_days(docs, f"{args.store}/postings")
        return
    session = stream_session(spark, args.state_partitions, idle_batches=args.job == "hourly")
    account = Account(session, f"{args.store}/account") if args.account else None
    if account:
        session.streams.addListener(account)
    trigger = {"availableNow": True} if args.once else jobs.FIVE_SECONDS
    positions = {
        (topic, int(partition)): offset
        for topic, offsets in json.loads(args.positions or "{}").items()
        for partition, offset in offsets.items()
    }

    def topic(name: str) -> DataFrame:
        if not args.servers:
            return file_topic(session, topic_folder(f"{args.store}/topics", name))
        known = {k: v for k, v in positions.items() if k[0] == name}
        return kafka_topic(session, args.servers, name, positions=known or None, max_offsets=args.max_offsets)

    dims, out = f"{args.store}/dims", {"path": f"{args.store}/topics", "servers": args.servers, "trigger": trigger}
    lookups = (lambda s, ids: tables.users(s, dims, ids)), (lambda s, ids: tables.provinces(s, dims, ids))
    if args.job == "log-split":
        query = jobs.log_split(topic(S.RAW_LOG_TOPIC), args.checkpoint, pages=f"{args.store}/pages", **out)
    elif args.job == "cdc-route":
        lists = f"{args.store}/lists"
        query = jobs.cdc_route(
            topic(S.RAW_CDC_TOPIC), lambda s: tables.required_lists(s, lists), dims, args.checkpoint,
            account=account.path if account else None, **out,
        )
    elif args.job == "dau":
        docs = f"{args.store}/{STORES['dau'][0]}"
        seen = jobs.restore_devices(spark, docs, args.restore_day, f"{args.checkpoint}-seen") if args.restore_day else None
        query = jobs.dau_documents(
            topic(S.PAGE_TOPIC), *lookups, docs, args.checkpoint, args.as_of, args.delay or "48 hours", seen, trigger
        )
    elif args.job == "hourly":
        hours = f"{args.store}/hours"
        query = jobs.hourly_actives(topic(S.PAGE_TOPIC), hours, args.checkpoint, args.delay or "2 hours", trigger)
    else:
        docs = f"{args.store}/{STORES['orders'][0]}"
        query = jobs.order_documents(
            topic(S.ORDER_INFO_TOPIC), topic(S.ORDER_DETAIL_TOPIC), *lookups, docs, args.checkpoint, args.as_of,
            args.delay or "24 hours", args.slices, args.keep, trigger,
        )
    query.awaitTermination()
    if account:
        account.settled(query)
        session.streams.removeListener(account)


if __name__ == "__main__":
    options = arguments()
    run(build_session(f"tidewise-{options.job}"), options)
