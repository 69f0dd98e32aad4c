"""Settings of an ingestion run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import datetime


@dataclass(frozen=True)
class IngestConfig:
    """Where records come from, where tables go, and how fast batches run.

    ``source`` is ``kafka`` or ``topic_log``. ``table_format`` is ``parquet`` (Spark's own
    streaming sink), ``batches`` (plain Parquet, a folder per date and batch, with a ledger)
    or ``delta``. The rate limits are unset by default, as a first run then takes
    the whole backlog in one batch; set them for a large backlog.

    ``fail_on_data_loss`` left open means: a topic log fails where files are gone; a
    broker, whose topics expire by design, does not. ``max_file_age`` is how far a log
    file's time may lie behind the newest: files beyond it would be skipped without a
    word, so the default skips none. The price is an entry per file in the driver's
    memory; shorten it for logs whose old files are known to be read.
    ``starting_time`` leaves out records sent before it, in ISO 8601 with a zone.
    ``id_filters`` writes a Bloom filter on ``_event_id`` per row group, for so many ids.
    """

    lakehouse: str
    checkpoints: str
    source: str = "kafka"
    broker: str = "localhost:9092"
    log_dir: str | None = None
    table_format: str = "parquet"
    starting_offsets: str = "earliest"
    starting_time: str | None = None
    fail_on_data_loss: bool | None = None
    trigger_seconds: float = 30
    available_now: bool = False
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    max_file_age: str = "36500d"
    keep_raw: bool = False
    # Gather each date's rows into few files, at one shuffle per batch.
    compact_dates: bool = True
    id_filters: int | None = None

    def __post_init__(self) -> None:
        if self.source not in ("kafka", "topic_log"):
            raise ValueError(f"unknown source {self.source!r}")
        if self.source == "topic_log" and not self.log_dir:
            raise ValueError("source 'topic_log' needs log_dir")
        if self.table_format not in ("parquet", "batches", "delta"):
            raise ValueError(f"unknown table format {self.table_format!r}")
        if self.source == "topic_log" and self.starting_offsets != "earliest":
            raise ValueError("a topic log starts at its earliest record, or at starting_time")
        if self.starting_time and self.starting_offsets != "earliest":
            raise ValueError("give starting_offsets or starting_time, not both")
        if self.starting_time and datetime.fromisoformat(self.starting_time).tzinfo is None:
            raise ValueError("starting_time needs a time zone")
        if self.id_filters and self.table_format == "delta":
            raise ValueError("id_filters are for Parquet tables")

    @property
    def fails_on_data_loss(self) -> bool:
        if self.fail_on_data_loss is None:
            return self.source == "topic_log"
        return self.fail_on_data_loss

    @property
    def file_options(self) -> dict[str, str]:
        """Options of the Parquet writer; a Delta table has its own."""
        if self.table_format == "delta":
            return {}
        # Ids are hexadecimal digits, which only an entropy coder stores in half their bytes.
        packed = {"compression": "zstd"}
        if not self.id_filters:
            return packed
        return packed | {
            "parquet.bloom.filter.enabled#_event_id": "true",
            "parquet.bloom.filter.expected.ndv#_event_id": str(self.id_filters),
            # A column of ids gains nothing from a dictionary.
            "parquet.enable.dictionary#_event_id": "false",
        }

    def ledger_path(self, table: str) -> str:
        return f"{self.lakehouse}/ledger/{table}"

    def table_path(self, table: str) -> str:
        return f"{self.lakehouse}/bronze/{table}"

    def checkpoint_path(self, table: str) -> str:
        return f"{self.checkpoints}/bronze/{table}"

    def at_replay_rate(self, delay_seconds: float) -> "IngestConfig":
        """Read broker topics no faster than one row per ``delay_seconds`` and topic."""
        if self.source != "kafka":
            raise ValueError("a topic log is read by files or bytes per trigger, not by rows")
        rows = max(1, round(self.trigger_seconds / delay_seconds))
        return replace(self, max_offsets_per_trigger=rows)

    @classmethod
    def from_env(cls, env: Mapping[str, str], **overrides) -> "IngestConfig":
        """Settings from environment variables; keyword arguments win."""
        settings = {
            "broker": env.get("KAFKA_BROKER", cls.broker),
            "lakehouse": env.get("LAKEHOUSE_PATH", "/lakehouse"),
            "checkpoints": env.get("CHECKPOINT_PATH", "/checkpoints"),
        }
        return cls(**{**settings, **overrides})
