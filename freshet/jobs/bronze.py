"""Stream every topic into its bronze table until interrupted.

``spark-submit freshet/jobs/bronze.py`` with KAFKA_BROKER, LAKEHOUSE_PATH and
CHECKPOINT_PATH set; flags cover the rest.
"""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import SparkSession

from freshet.config import IngestConfig
from freshet.jobs import log_to_console
from freshet.registry import registry
from freshet.session import build_session
from freshet.streaming import runner


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--prefix", default="shop", help="topic name prefix")
    parser.add_argument("--log-dir", help="read a topic log instead of the broker")
    parser.add_argument("--table-format", choices=["parquet", "batches", "delta"], default="parquet")
    parser.add_argument("--trigger-seconds", type=float, default=30)
    parser.add_argument("--available-now", action="store_true", help="stop when caught up")
    parser.add_argument(
        "--max-offsets-per-trigger", type=int, default=10_000_000, help="of a broker; 0: no limit"
    )
    parser.add_argument(
        "--max-files-per-trigger", type=int, default=1_000, help="of a topic log; 0: no limit"
    )
    parser.add_argument("--max-bytes-per-trigger", help="of a topic log, instead of files")
    parser.add_argument(
        "--min-partitions", type=int, help="tasks to read a broker's topic with, if more than its own"
    )
    parser.add_argument("--starting-offsets", default="earliest", help="of a broker")
    parser.add_argument("--starting-time", help="leave out records before, ISO 8601 with a zone")
    parser.add_argument(
        "--id-filters", type=int, help="Bloom filters on event ids, for so many per row group"
    )
    parser.add_argument(
        "--fail-on-data-loss",
        action=argparse.BooleanOptionalAction,
        help="stop where records are gone (a topic log's default) or go on (a broker's)",
    )
    parser.add_argument("--max-file-age", default=IngestConfig.max_file_age, help="of a topic log")
    parser.add_argument(
        "--replay-delay", type=float, help="read a broker at one row per so many seconds and topic"
    )
    parser.add_argument("--keep-raw", action="store_true", help="keep each value's text")
    parser.add_argument(
        "--compact-dates",
        action=argparse.BooleanOptionalAction,
        default=True,
        help="few files per date, at one shuffle per batch",
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, session: SparkSession | None = None) -> None:
    log_to_console()
    settings = vars(arguments(argv))
    specs = registry(settings.pop("prefix")).values()
    source = "topic_log" if settings["log_dir"] else "kafka"
    delay = settings.pop("replay_delay")
    if settings["max_bytes_per_trigger"]:  # Spark takes one of the two limits
        settings["max_files_per_trigger"] = None
    cfg = IngestConfig.from_env(os.environ, source=source, **settings)
    if delay is not None:
        cfg = cfg.at_replay_rate(delay)
    spark = session or build_session("freshet-bronze", cfg.table_format)
    try:
        runner.run(spark, specs, cfg)
    except KeyboardInterrupt:
        logging.info("interrupted; all streams stopped")
    finally:
        if session is None:
            spark.stop()


if __name__ == "__main__":
    main()
