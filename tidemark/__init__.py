"""Finds stale tables, explains them, and sorts them by who should know."""

from tidemark.operators.enrichment import (
    enrichment,
    latest_job_stats,
    latest_source_tables,
    latest_sources,
    report,
)
from tidemark.operators.errors import classify_errors
from tidemark.operators.exclusion import exclude, ignore_datasets, ignore_tables
from tidemark.operators.export import (
    column_widths,
    empty_report,
    export_rows,
    publish_report,
    read_report,
    report_manifest,
    write_report,
    write_report_or_message,
)
from tidemark.operators.joins import spread_left_join
from tidemark.operators.latency import (
    describe,
    eligible_tables,
    evaluate,
    pick_threshold,
    stale_matches,
)
from tidemark.operators.latest import latest_per_key
from tidemark.operators.matching import match_regex, match_thresholds
from tidemark.operators.routing import dataset_id, route
from tidemark.operators.rules import check_rules, failure_channels, parse_rules, rules_from_json
from tidemark.operators.scope import live_tables, scope_filter
from tidemark.operators.summary import (
    dataset_counts,
    route_summary,
    summary_lines,
    summary_text,
    top_datasets,
    totals,
)
from tidemark.presets import MONITORED, Scope
from tidemark.sources.activity import (
    file_activity,
    listed_files,
    opt_out_datasets,
    read_source,
    require_rows,
    rows_per_file,
    table_activity,
    union_frames,
    union_sources,
)
from tidemark.sources.ledger import activity_state, fold_new_files, unseen_files
from tidemark.sources.staging import (
    read_table,
    read_violations,
    replace_table,
    row_counts,
)
from tidemark.sources.stored import scratch_folder

__all__ = [name for name in dir() if not name.startswith("_")]
