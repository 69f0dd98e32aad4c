"""Audit fields and the partition date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 in UTC with microseconds, e.g. 2024-01-15T08:23:11.432000+00:00
INGESTED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def ingested_at() -> Column:
    """The batch's start as UTC text, in any session time zone."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, INGESTED_AT_FORMAT)


def ingested_instant(text: Column) -> Column:
    """The instant an ``_ingested_at`` text names, NULL where it names none."""
    return F.try_to_timestamp(text)


def bronze_date(text: Column) -> Column:
    """The date as written, unshifted by zone; NULL (never an error) on garbage."""
    return F.try_to_date(text)


def event_id(*identity: Column) -> Column:
    """A UUID derived from ``identity``: the same input keeps its id on replay.

    The parts are digested as a JSON array, in which a NULL, an empty text and the borders
    between parts cannot be taken for one another. The version digit is 8 (custom) and the variant digit 8.
    """
    digest = F.md5(F.to_json(F.array(*identity), {"ignoreNullFields": "false"}))
    return F.concat_ws(
        "-",
        F.substr(digest, F.lit(1), F.lit(8)),
        F.substr(digest, F.lit(9), F.lit(4)),
        F.concat(F.lit("8"), F.substr(digest, F.lit(14), F.lit(3))),
        F.concat(F.lit("8"), F.substr(digest, F.lit(18), F.lit(3))),
        F.substr(digest, F.lit(21), F.lit(12)),
    )


def random_event_id() -> Column:
    """A random UUID; it changes when a task or job is run again."""
    return F.uuid()
