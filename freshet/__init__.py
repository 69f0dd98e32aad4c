"""Event ingestion for Spark: CSV replay, keyed topics, bronze tables, audits."""

from freshet.config import IngestConfig
from freshet.registry import AUDIT_FIELDS, TopicSpec, registry
from freshet.session import build_session, scratch_dir

__all__ = [
    "AUDIT_FIELDS",
    "IngestConfig",
    "TopicSpec",
    "build_session",
    "registry",
    "scratch_dir",
]
