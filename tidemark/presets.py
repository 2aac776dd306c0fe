"""Values a deployment is configured with.

Everything here is data. The operators take these values as parameters, so
another deployment passes its own instead of editing code.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Scope:
    """Which tables are watched. Empty tuples put no restriction on that test.

    ``patterns`` and ``upper_patterns`` are LIKE patterns on the dataset name,
    the latter compared with the upper-cased name; ``datasets`` are exact names.
    A dataset is in scope when any of the three accepts it.
    """

    patterns: tuple[str, ...] = ()
    upper_patterns: tuple[str, ...] = ()
    datasets: tuple[str, ...] = ()
    excluded_datasets: tuple[str, ...] = ()
    excluded_pairs: tuple[tuple[str, str], ...] = ()  # (project, dataset)
    excluded_tables: tuple[str, ...] = ()
    # Datasets whose unmatched tables still get the default threshold.
    default_patterns: tuple[str, ...] = ()
    default_upper_patterns: tuple[str, ...] = ()


# Scope and exclusions of the monitored warehouse.
MONITORED = Scope(
    patterns=("%_prod_raw", "%daton%"),
    upper_patterns=("%BQ%",),
    datasets=("nexus_gds_raw",),
    excluded_datasets=(
        "daton_healthycell_kr",
        "DatonPearlWestGroup",
        "IH_Daton",
        "daton_eskiin_custom_backup",
        "lhappyinnov_daton_backup",
        "marketdefense_daton_staging",
        "wellbeam_daton_backup",
    ),
    excluded_pairs=(
        ("insightsprod", "Manta_Daton"),
        ("insightsprod", "daton_instanthydrati"),
        ("pulse-instanthydration", "daton_instanthydrati"),
        ("insightsprod", "daton_javvycofee"),
        ("insightsprod", "wellbeam_daton"),
    ),
    excluded_tables=("daton_metadata",),
    default_patterns=("%daton%",),
    default_upper_patterns=("%BQ%",),
)

# Evaluation.
DEFAULT_HOURS = 24
DISPLAY_ZONE = "Asia/Kolkata"
OPT_OUT_OPTION = "labels"
OPT_OUT_PATTERN = '%"latency_check_ignore", "true"%'

# Job history.
RUNTIME_COLUMN = "_daton_batch_runtime"
ACTIVE_STATUS = 2
STATUS_NAMES = {2: "Active", 11: "Rescheduled", 6: "Paused", 5: "Deleted"}
UNKNOWN_STATUS = "Unknown"

# Routing.
DATASET_ID_COLUMNS = ("dataset_id", "dataset", "dataset_name", "table_schema")
DEFAULT_RULE = "default"
FALLBACK_CHANNELS = ("C065MG2L63U",)

# Message texts and limits.
SUMMARY_BUDGET = 2800
NAME_LIMIT = 80
NAME_KEPT = 77
UNKNOWN_DATASET = "Unknown"
HEADER_FORMAT = "Found %d table violations across %d datasets:"
LINE_FORMAT = "• *%s*: %d tables violate threshold"
TAIL_ONE = "\n_...and %d more dataset (see attached file for complete list)_"
TAIL_MANY = "\n_...and %d more datasets (see attached file for complete list)_"
ALL_CLEAR_SUMMARY = "✅ No latency violations found - all tables are up to date!"
ALL_CLEAR_REPORT = "No latency violations found - all tables are up to date! ✅"
REPORT_TEMPLATE = "latency_report_success"
ALL_CLEAR_TEMPLATE = "latency_report_no_violations"
WIDTH_CAP = 50
WIDTH_PADDING = 2

# Error classes.
TRANSIENT_WORDS = (
    "rateLimitExceeded", "backendError", "internalError",
    "Timeout", "ServiceUnavailable", "503", "429",
    "ConnectionError", "ConnectionReset", "BrokenPipe",
    "deadline", "Unavailable", "UNAVAILABLE", "Retry",
)
# (word in the message, class, task to blame when none is named), first match wins.
ERROR_CLASSES = (
    ("bigquery", "bigquery_failure", "run_latency_check"),
    ("slack", "slack_failure", "convert_and_send_to_slack"),
)
OTHER_ERROR_CLASS = "dag_failure"
OTHER_ERROR_TASK = "unknown"
ERROR_MESSAGE_LIMIT = 500
