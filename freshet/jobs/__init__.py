"""Command-line jobs, for spark-submit."""

import logging


def log_to_console() -> None:
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
