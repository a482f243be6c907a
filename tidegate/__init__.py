"""Governed ingestion of topic logs into tables, on Spark."""

from .functions.coerce import PROFILES, coerce, to_json_text
from .functions.names import sanitize_name, sanitize_names
from .functions.types import ColumnSpec, Declared, SchemaError, TableSpec
from .operators.decode import (
    ENVELOPE,
    cast_fields,
    decode,
    decode_json,
    decode_typed,
    observed_columns,
    prune_null_columns,
    resolve_columns,
    unknown_attributes,
)
from .operators.merge import latest_per_key, merge_into, supports_merge, upsert
from .operators.metrics import IngestMetrics, compare_runs, ingest_rate, read_metrics, throughput
from .operators.offsets import advance_offsets, drop_processed, empty_ledger, high_water, read_high_water, register_partitions, start_high_water
from .operators.quarantine import BatchFailed, quarantine_oversize, split_valid, write_dead_letters
from .operators.route import filter_topics, parse_mapping, route, skipped, split_by_table
from .operators.sinks import append, write_parquet_batch
from .operators.verify import (
    bitmap_counts,
    check_checksum,
    check_count,
    check_distinct,
    checksum,
    id_bitmaps,
    merge_bitmaps,
    missing_from_bitmaps,
    missing_ids,
    spot_check,
)
from .plans.ingest import IngestConfig, PostProcess, Script, fill_defaults, plan_mixed, plan_rows, plan_tables, tag_batch
from .session import configure
from .sources.catalog import discover, missing_tables
from .sources.envelope import read_topic_log, stream_topic_log, to_envelope
from .sources.generate import random_log, sequence_log
from .sources.replay import csv_to_topic_log, replay_csv, replay_csv_stream
from .streaming.pipeline import ingest_batch, start_ingest
from .streaming.store import TableStore

__all__ = [name for name in dir() if not name.startswith("_")]
