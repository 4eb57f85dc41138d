"""Command line: acquire pages, consume the log, look at what is published.

    python -m gleanstream acquire --captures DIR --log DIR --keyword "Data Science" --pages 3
    python -m gleanstream consume --log DIR --store DIR
    python -m gleanstream snapshot --documents DIR --store DIR
    python -m gleanstream compact --store DIR
    python -m gleanstream report  --log DIR
    python -m gleanstream show    --store DIR

With spark-submit, the session's own master and settings are used. ``--kafka`` in
place of ``--log`` takes broker addresses and needs the connector jar.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gleanstream.operators.page_order import linked_captures
from gleanstream.plans.acquire import acquire, listing_messages
from gleanstream.plans.documents import publish_documents
from gleanstream.schemas import TOPIC
from gleanstream.session import now_stamp, ship_code
from gleanstream.sinks.compaction import KEEP_SECONDS, compact_store
from gleanstream.sinks.log import delivery_report, publish_to_kafka
from gleanstream.sinks.snapshot import (
    FullSnapshot, GridSnapshot, IncrementalSnapshot, read_published, read_published_grid,
)
from gleanstream.sources.captures import read_captures, url_page_number
from gleanstream.sources.log import stream_kafka, stream_log
from gleanstream.streaming.consumer import BATCH_INTERVAL, ListingConsumer, run_until_stopped

SNAPSHOTS = ("incremental", "full", "grid")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gleanstream")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *log_options: str) -> argparse.ArgumentParser:
        one = commands.add_parser(name)
        if log_options:
            place = one.add_mutually_exclusive_group(required=True)
            for option in log_options:
                place.add_argument(option)
        return one

    one = command("acquire", "--log", "--kafka")
    one.add_argument("--captures", required=True)
    one.add_argument("--keyword", required=True)
    one.add_argument("--pages", type=int, default=None, help="pages per search; default all")
    one.add_argument("--pages-by", choices=("url", "links"), default="url",
                     help="what tells a page's place: page=N in its URL, or the next links")
    one.add_argument("--captured-at", default=None, help="yyyy-MM-dd HH:mm:ss")
    one.add_argument("--zip", choices=("pad", "strict", "block"), default="pad")
    one.add_argument("--block", default=None, help="selector of one listing, for --zip block")

    one = command("consume", "--log", "--kafka")
    one.add_argument("--store", required=True)
    one.add_argument("--topic", default=TOPIC)
    one.add_argument("--snapshot", choices=SNAPSHOTS, default="incremental")
    one.add_argument("--interval", default=BATCH_INTERVAL)
    one.add_argument("--until-drained", action="store_true")
    one.add_argument("--trace", action="store_true")
    one.add_argument("--bytes-per-batch", type=int, default=None, help="bound for --log")
    one.add_argument("--records-per-batch", type=int, default=None, help="bound for --kafka")
    one.add_argument("--group", default=None, help="consumer group, for --kafka")
    one.add_argument("--null-text", choices=("literal", "null"), default="literal")
    one.add_argument("--rejects", action="store_true", help="keep what does not decode, with reasons")
    one.add_argument("--stop-file", default=None, help="stop after the batch under way when it appears")
    one.add_argument("--idle-refresh", type=float, default=None, help="seconds")

    one = command("snapshot")
    one.add_argument("--documents", required=True, help="JSON documents, one a line")
    one.add_argument("--store", required=True)
    one.add_argument("--dedup", action="store_true")

    one = command("compact")
    one.add_argument("--store", required=True)
    one.add_argument("--keep", type=float, default=KEEP_SECONDS,
                     help="seconds that merged batches stay for readers that began before")

    command("report", "--log")
    one = command("show")
    one.add_argument("--store", required=True)
    one.add_argument("--grid", action="store_true")
    return parser.parse_args(argv)


def _acquire(spark: SparkSession, args: argparse.Namespace) -> None:
    captures = read_captures(spark, args.captures)
    moment = F.lit(args.captured_at or now_stamp()).cast("timestamp_ntz")
    page_no = url_page_number(F.col("url"))
    if args.pages_by == "links" and args.pages is not None:
        captures, page_no = linked_captures(captures), F.col("ordinal")
    options = {
        "page_no": page_no, "pages": args.pages,
        "zip_mode": args.zip, "block": args.block,
    }
    if args.kafka:
        ship_code(spark)
        publish_to_kafka(
            listing_messages(captures, args.keyword, moment, **options), args.kafka).show()
        return
    publish_id = acquire(captures, args.log, args.keyword, moment, **options)
    delivery_report(spark, args.log, publish_id).show(truncate=False)


def _consume(spark: SparkSession, args: argparse.Namespace) -> None:
    published, refreshes = f"{args.store}/published", f"{args.store}/refreshes"
    publisher = {
        "incremental": lambda: IncrementalSnapshot(published),
        "full": lambda: FullSnapshot(published),
        "grid": lambda: GridSnapshot(published),
    }[args.snapshot]()
    consumer = ListingConsumer(
        postings_dir=f"{args.store}/postings", log_dir=refreshes, publisher=publisher,
        checkpoint_dir=f"{args.store}/checkpoint", null_text=args.null_text,
        trace_dir=f"{args.store}/trace" if args.trace else None,
        rejects_dir=f"{args.store}/rejects" if args.rejects else None,
    )
    source = (
        stream_kafka(spark, args.kafka, args.topic, group=args.group,
                     records_per_batch=args.records_per_batch) if args.kafka
        else stream_log(spark, args.log, args.topic, bytes_per_batch=args.bytes_per_batch)
    )
    run_until_stopped(
        consumer.start(source, args.interval, args.until_drained), consumer, spark, args.stop_file,
        args.idle_refresh)


def _snapshot(spark: SparkSession, args: argparse.Namespace) -> None:
    documents = spark.read.text(args.documents).withColumnRenamed("value", "document")
    publish_documents(
        documents, args.store, now_stamp(), dedup=args.dedup)


def _show(spark: SparkSession, args: argparse.Namespace) -> None:
    read = read_published_grid if args.grid else read_published
    read(spark, f"{args.store}/published", f"{args.store}/refreshes").show()


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("gleanstream").getOrCreate()
    if args.command == "acquire":
        _acquire(spark, args)
    elif args.command == "consume":
        _consume(spark, args)
    elif args.command == "snapshot":
        _snapshot(spark, args)
    elif args.command == "compact":
        print(compact_store(spark, args.store, args.keep))
    elif args.command == "report":
        delivery_report(spark, args.log).show(truncate=False)
    else:
        _show(spark, args)


if __name__ == "__main__":
    main()
