"""Outbreak-surveillance tables as Spark jobs.

Every operator takes and returns DataFrames; nothing is collected except values
whose size is checked first (see :func:`panelspark.operators.grid.bounded_rows`).
"""

from .operators.dedupe import drop_all_duplicates, drop_duplicated_reports, first_per_key
from .operators.grid import ordered_pairs, product, with_years
from .operators.ingest import changed_rows, history_for, run_mode, unfetched
from .operators.network import augment, month_status, scale, score_logit
from .operators.panel import (
    append_absent,
    carry_forward,
    interpolate,
    trade_panel,
    yearly_panel,
)
from .operators.posts import aggregate_posts, flatten_posts
from .operators.qa import drop_empty_cols, field_check, schema_table
from .operators.quarantine import preprocess_events
from .operators.rollup import nowcast_summary
from .operators.upsert import merge
from .operators.views import nowcast_view, query_predictions
from .session import build_session
from .sources.files import export_all
from .sources.partitioned import PartitionedTable
from .sources.tables import Tables
from .streaming.ingest import stream_upsert

__all__ = [
    "PartitionedTable",
    "Tables",
    "aggregate_posts",
    "append_absent",
    "augment",
    "build_session",
    "carry_forward",
    "changed_rows",
    "drop_all_duplicates",
    "drop_duplicated_reports",
    "drop_empty_cols",
    "export_all",
    "field_check",
    "first_per_key",
    "flatten_posts",
    "history_for",
    "interpolate",
    "merge",
    "month_status",
    "nowcast_summary",
    "nowcast_view",
    "ordered_pairs",
    "preprocess_events",
    "product",
    "query_predictions",
    "run_mode",
    "scale",
    "schema_table",
    "score_logit",
    "stream_upsert",
    "trade_panel",
    "unfetched",
    "with_years",
    "yearly_panel",
]
