"""Replay the CSV exports as keyed events into their topics.

``spark-submit freshet/jobs/replay.py --data-dir DIR`` sends to the broker, or
with ``--log-dir`` to a topic log.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from freshet.jobs import log_to_console
from freshet.operators.replay import replay_records, replay_schedule
from freshet.registry import registry
from freshet.session import build_session, scratch_scope
from freshet.sources import kafka, topic_log


# Fixed value: seconds between two rows of a topic.
DELAY = 0.05


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--data-dir", default="/data/raw")
    parser.add_argument(
        "--delay",
        type=float,
        help=f"seconds between a topic log's record times, {DELAY} unless given; a broker's"
        " readers are paced instead (--replay-delay of the bronze job)",
    )
    parser.add_argument("--keep-order", action="store_true", help="send each key's rows in order")
    parser.add_argument("--broker", default="localhost:9092")
    parser.add_argument("--log-dir", help="write a topic log instead of to the broker")
    parser.add_argument("--max-rows-per-file", type=int, default=0)
    parser.add_argument("--prefix", default="shop", help="topic and file name prefix")
    parser.add_argument("--random-ids", action="store_true", help="new event ids on every replay")
    args = parser.parse_args(argv)
    if args.delay is not None and not args.log_dir:
        parser.error("--delay needs --log-dir: a broker's records carry the time of sending")
    if args.keep_order and args.log_dir:
        parser.error("--keep-order is for a broker: a topic log always keeps the order")
    return args


def main(argv: list[str] | None = None, session: SparkSession | None = None) -> None:
    log_to_console()
    args = arguments(argv)
    specs = registry(args.prefix).values()
    spark = session or build_session("freshet-replay")
    try:
        with scratch_scope(spark):
            records = replay_records(spark, specs, args.data_dir, stable_ids=not args.random_ids)
            if args.log_dir:
                topic_log.create_topics(spark, args.log_dir, specs)
                delay = DELAY if args.delay is None else args.delay
                timed = replay_schedule(records, F.current_timestamp(), delay)
                sent = topic_log.append(
                    timed.withColumnRenamed("arrival_ts", "timestamp"),
                    args.log_dir,
                    specs,
                    max_rows_per_file=args.max_rows_per_file,
                )
            else:
                sent = kafka.publish(records, args.broker, specs, keep_order=args.keep_order)
        for topic, count in sent.items():
            logging.info("%s: %d records", topic, count)
    finally:
        if session is None:
            spark.stop()


if __name__ == "__main__":
    main()
