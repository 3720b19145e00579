"""Keep running order totals from a message topic.

    spark-submit --packages <the Kafka connector of your Spark version> \\
        footfall/jobs/order_stream.py --brokers host:9092 --topics orders \\
        --totals /warehouse/order_totals --checkpoint /warehouse/checkpoints/orders
"""

from __future__ import annotations

import argparse

from footfall.session import build_session
from footfall.sources.orders import read_files, read_kafka
from footfall.streaming.order_stream import add_counts, start_order_stream, starting_offsets, store_lookups


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description="Running order totals")
    source = options.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers", help="bootstrap servers of the topic")
    source.add_argument("--files", help="folder where text files of messages arrive")
    options.add_argument("--topics", help="comma-separated topics")
    options.add_argument("--starting", default="latest", help="offsets of the very first start")
    options.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE",
        help="source option, such as minPartitions (splits a busy topic partition) or maxOffsetsPerTrigger",
    )
    options.add_argument("--totals", required=True, help="folder of the totals")
    options.add_argument("--rejects", help="folder of messages that are not counted; <totals>_rejects when left out")
    options.add_argument("--lookups", help="folder for counters and hash fields, written when the query stops")
    options.add_argument("--checkpoint", required=True)
    options.add_argument("--every", default="5 seconds", help="micro-batch interval")
    options.add_argument("--once", action="store_true", help="work off what has arrived, then stop")
    options.add_argument("--watermark", help="reject orders this much older than the newest, such as '2 days'")
    options.add_argument("--distinct", help="count an order id once within this time of arrival, such as '1 hour'")
    args = options.parse_args(argv)
    if args.brokers and not args.topics:
        options.error("--brokers needs --topics")

    spark = build_session("order_stream")
    extra = dict(option.split("=", 1) for option in args.option)
    if args.brokers:
        # Without a checkpoint, go on where the stored totals end.
        starting = starting_offsets(spark, args.totals) or args.starting
        messages = read_kafka(spark, args.brokers, args.topics.split(","), starting=starting, **extra)
    else:
        messages = read_files(spark, args.files, **extra)
    add_counts(spark, lambda batch, accepted, rejected: print(f"batch={batch} accepted={accepted} rejected={rejected}"))
    every = None if args.once else args.every
    query = start_order_stream(messages, args.totals, args.checkpoint, every, args.watermark, rejects=args.rejects, distinct=args.distinct)
    try:
        query.awaitTermination()
    finally:
        if args.lookups:
            store_lookups(spark, args.totals, args.lookups)


if __name__ == "__main__":
    main()
