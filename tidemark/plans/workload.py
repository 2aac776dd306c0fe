"""One query per operator over the test tables, and the SQL that must agree with it.

Times and arrays are shown as text, so that two engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark as td
from tidemark import presets as P
from tidemark.functions.time import second_text
from tidemark.operators.routing import has_id
from tidemark.plans import daily
from tidemark.plans import fixtures as fx
from tidemark.sources.activity import listed_files, rows_per_file
from tidemark.sources.schemas import ACTIVITY, OPTIONS

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    query: Query
    oracle: str | None


ENTRIES: dict[str, Entry] = {}


def _register(oracle: str | None = None):
    def keep(query: Query) -> Query:
        ENTRIES[query.__name__] = Entry(query, None if oracle is None else _WITH + oracle)
        return query

    return keep


# ---------------------------------------------------------------- text for the oracle


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _list(texts) -> str:
    return ", ".join(_quoted(text) for text in texts)


_HAS_DEFAULT = "(table_schema LIKE '%daton%' OR upper(table_schema) LIKE '%BQ%')"


def _in_scope(scope: P.Scope) -> str:
    pairs = " ".join(
        f"AND NOT (source_project_id = {_quoted(p)} AND table_schema = {_quoted(d)})"
        for p, d in scope.excluded_pairs
    )
    return (
        "deleted = false AND (table_schema LIKE '%_prod_raw' OR table_schema LIKE '%daton%' "
        "OR upper(table_schema) LIKE '%BQ%' OR table_schema = 'nexus_gds_raw') "
        f"AND table_schema NOT IN ({_list(scope.excluded_datasets)}) {pairs} "
        f"AND table_name NOT IN ({_list(scope.excluded_tables)})"
    )


def _live(source: str) -> str:
    return (
        "SELECT table_schema, table_name, max(storage_last_modified_time) AS modified, "
        "array_to_string(list_sort(list(DISTINCT source_project_id)), ',') AS projects "
        f"FROM {source} WHERE {_in_scope(fx.SCOPE)} GROUP BY table_schema, table_name"
    )


def _matched(tables: str, rules: str) -> str:
    return (
        f"SELECT t.*, p.table_pattern, p.latency_threshold FROM {tables} t LEFT JOIN {rules} p "
        "ON lower(t.table_name) LIKE p.table_pattern AND p.latency_threshold IS NOT NULL"
    )


def _stale(matched: str, as_of: str, hours: str = "") -> str:
    hours = hours or f"date_sub('hour', modified, TIMESTAMP '{as_of}')"
    return (
        "SELECT table_schema, table_name, modified + INTERVAL 330 MINUTE AS last_update, "
        f"coalesce(latency_threshold, 24) AS latency_threshold, {hours} AS hours_since_last_update, projects "
        f"FROM {matched} WHERE (table_pattern IS NOT NULL OR {_HAS_DEFAULT}) "
        f"AND modified < TIMESTAMP '{as_of}' - to_hours(coalesce(latency_threshold, 24)) "
        "QUALIFY row_number() OVER (PARTITION BY table_schema, table_name "
        "ORDER BY length(table_pattern) DESC NULLS LAST, table_pattern, latency_threshold) = 1"
    )


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


_HOURS_ON_CLOCK = (
    f"date_diff('hour', modified + INTERVAL 330 MINUTE, TIMESTAMP '{fx.AS_OF}' + INTERVAL 330 MINUTE)"
)
_STALE_COLUMNS = (
    f"table_schema, table_name, {_text('last_update')} AS last_update, latency_threshold, "
    "hours_since_last_update, projects AS present_in_projects"
)


def _facts(tables: str) -> str:
    return (
        "SELECT t.companyid, s.type AS platform, s.status AS source_status, j.lasterrorcode, j.lasterror, "
        f"j.last_job_end_time, s.name || '_' || t.tablename AS table_name FROM {tables} t "
        "LEFT JOIN latest_s s ON s.sourceid = t.sourceid LEFT JOIN latest_j j ON j.tableid = t.tableid"
    )


def _report(stale: str) -> str:
    return (
        f"SELECT m.*, platform, source_status, lasterrorcode, lasterror, last_job_end_time "
        f"FROM {stale} m LEFT JOIN facts f ON m.table_name = f.table_name"
    )


_REPORT_COLUMNS = (
    f"{_STALE_COLUMNS}, platform, source_status, lasterrorcode, lasterror, "
    f"{_text('last_job_end_time')} AS last_job_end_time"
)


def _routed(records: str) -> str:
    return (
        f"SELECT r.*, 'default:C0' AS route, true AS is_default, 'C0' AS channels FROM {records} r "
        "UNION ALL SELECT r.*, 'match:' || x.channels, false, x.channels "
        f"FROM {records} r JOIN (VALUES ('daton|acme', 'C1'), ('acme', 'C1'), ('nexus', 'C2'), "
        "('^Acme', 'C3,C1'), ('zzz', 'C9')) x(pattern, channels) "
        "ON r.table_schema <> '' AND regexp_matches(r.table_schema, x.pattern)"
    )


def _summary(counts: str, by: str) -> str:
    """Lines of the summary, one per dataset that fits."""
    return (
        "SELECT *, CAST(length(header) + sum(length(line) + 1) OVER (PARTITION BY "
        f"{by} ORDER BY violations DESC, table_schema ROWS UNBOUNDED PRECEDING) AS BIGINT) AS length_so_far "
        "FROM (SELECT *, '• *' || CASE WHEN length(table_schema) > 80 THEN left(table_schema, 77) || '...' "
        "ELSE table_schema END || '*: ' || violations || ' tables violate threshold' AS line, "
        "'Found ' || total_violations || ' table violations across ' || total_datasets || ' datasets:' AS header, "
        f"row_number() OVER (PARTITION BY {by} ORDER BY violations DESC, table_schema) AS line_no "
        "FROM (SELECT *, CAST(sum(violations) OVER w AS BIGINT) AS total_violations, count(*) OVER w AS "
        f"total_datasets FROM {counts} WINDOW w AS (PARTITION BY {by})))"
    )


def _summary_text(lines: str, by: str) -> str:
    left_out = "(total_datasets - count(*) FILTER (WHERE length_so_far <= 2800))"
    return (
        f"SELECT {by}, total_violations, total_datasets, count(*) FILTER (WHERE length_so_far <= 2800) AS shown, "
        "header || coalesce(chr(10) || string_agg(line, chr(10) ORDER BY line_no) "
        "FILTER (WHERE length_so_far <= 2800), '') || "
        f"CASE WHEN {left_out} > 0 THEN chr(10) || chr(10) || '_...and ' || {left_out} || ' more dataset' || "
        f"CASE WHEN {left_out} > 1 THEN 's' ELSE '' END || ' (see attached file for complete list)_' ELSE '' END "
        f"AS summary_text FROM {lines} GROUP BY {by}, total_violations, total_datasets, header"
    )


def _route_summary(routed: str) -> str:
    by = "route, is_default, channels"
    counts = f"(SELECT {by}, table_schema, count(*) AS violations FROM {routed} GROUP BY ALL)"
    return (
        f"SELECT {by}, total_violations AS violations, 'latency_report_success' AS template, summary_text "
        f"FROM ({_summary_text('(' + _summary(counts, by) + ')', by)})"
    )


_STATUS = (
    "CASE status WHEN 2 THEN 'Active' WHEN 11 THEN 'Rescheduled' WHEN 6 THEN 'Paused' "
    "WHEN 5 THEN 'Deleted' ELSE 'Unknown' END"
)
_NEWEST = "ORDER BY batch_runtime DESC, event_id DESC) = 1"

# Relations every oracle query may use; those it does not use cost nothing.
_RELATIONS = {
    "activity": fx.relation_sql(fx.ACTIVITY),
    "shared_activity": fx.relation_sql(fx.SHARED_ACTIVITY),
    "unnamed": fx.relation_sql(fx.UNNAMED_TABLES),
    "lineitem_activity": fx.relation_sql(fx.LINEITEM_ACTIVITY),
    "ignored_tables": fx.relation_sql(fx.IGNORED_TABLES),
    "source_tables": fx.relation_sql(fx.SOURCE_TABLES),
    "sources": fx.relation_sql(fx.SOURCES),
    "job_stats": fx.relation_sql(fx.JOB_STATS),
    "configs": fx.relation_sql(fx.CONFIGS),
    "record_ids": fx.relation_sql(fx.RECORD_IDS),
    "named_records": fx.relation_sql(fx.NAMED_RECORDS),
    "job_log": fx.relation_sql(fx.JOB_LOG),
    "many_rules": fx.relation_sql(fx.MANY_RULES),
    "many_thresholds": fx.relation_sql(fx.MANY_THRESHOLDS),
    "thresholds": f"SELECT * FROM {fx.THRESHOLDS}",
    "dataset_options": f"SELECT * FROM {fx.OPTIONS}",
    "opted_out": "SELECT DISTINCT schema_name FROM dataset_options WHERE option_name = 'labels' "
    "AND option_value LIKE '%\"latency_check_ignore\", \"true\"%'",
    "live": _live("activity"),
    "not_ignored": "SELECT * FROM live l WHERE NOT EXISTS (SELECT 1 FROM ignored_tables i "
    "WHERE i.table_schema = l.table_schema AND i.table_name = l.table_name)",
    "not_excluded": "SELECT * FROM not_ignored l WHERE NOT EXISTS (SELECT 1 FROM opted_out o "
    "WHERE o.schema_name = l.table_schema)",
    "matched": _matched("not_ignored", "thresholds"),
    "matched_in": _matched("not_excluded", "thresholds"),
    "stale": _stale("matched", fx.AS_OF),
    "stale_in": _stale("matched_in", fx.AS_OF),
    "latest_t": "SELECT * FROM source_tables WHERE selected AND status = 2 "
    f"QUALIFY row_number() OVER (PARTITION BY sourceid, tableid {_NEWEST}",
    "latest_s": f"SELECT sourceid, companyid, type, {_STATUS} AS status, name FROM sources "
    f"QUALIFY row_number() OVER (PARTITION BY sourceid {_NEWEST}",
    "latest_j": "SELECT tableid, sourceid, lasterrorcode, lasterror, "
    "make_timestamp(TRY_CAST(lastendtime AS BIGINT) * 1000) + INTERVAL 330 MINUTE AS last_job_end_time "
    f"FROM job_stats QUALIFY row_number() OVER (PARTITION BY sourceid, tablename {_NEWEST}",
    "facts": _facts("latest_t"),
    "full_report": _report("stale"),
    "full_report_in": _report("stale_in"),
    "routed": _routed("stale"),
    "routed_report": _routed("full_report_in"),
    "named_counts": "SELECT table_schema, count(*) AS violations, 1 AS one FROM named_records GROUP BY table_schema",
    "config_kind": "SELECT *, CASE WHEN trim(config) = '' THEN 'empty_text' WHEN NOT json_valid(config) "
    "THEN 'bad_json' WHEN json_type(config) <> 'OBJECT' THEN 'not_an_object' END AS whole FROM configs",
    "config_entries": "SELECT config_id, key, value, row_number() OVER (PARTITION BY config_id ORDER BY e.id) AS place "
    "FROM config_kind, json_each(CASE WHEN whole IS NULL THEN config ELSE '{}' END) e",
    "config_rules": "SELECT config_id, CAST(row_number() OVER (PARTITION BY config_id ORDER BY min(place)) AS INT) "
    "AS rule_no, CASE WHEN key <> 'default' THEN trim(key) END AS pattern, key = 'default' AS is_default, "
    "json_type(arg_max(value, place)) AS kind, CASE WHEN json_type(arg_max(value, place)) = 'VARCHAR' THEN "
    "list_filter(list_transform(string_split(arg_max(value, place) ->> '$', ','), lambda c: trim(c)), "
    "lambda c: c <> '') END AS channels FROM config_entries GROUP BY config_id, key",
    "config_problems": "SELECT config_id, CAST(NULL AS INT) AS rule_no, CAST(NULL AS VARCHAR) AS pattern, "
    "coalesce(whole, 'no_default') AS problem FROM config_kind k WHERE whole IS NOT NULL OR NOT EXISTS "
    "(SELECT 1 FROM config_rules r WHERE r.config_id = k.config_id AND r.is_default) UNION ALL "
    "SELECT * FROM (SELECT config_id, rule_no, pattern, CASE WHEN NOT is_default AND pattern = '' THEN 'empty_pattern' "
    "WHEN kind = 'NULL' THEN 'null_value' WHEN kind <> 'VARCHAR' THEN 'not_a_string' WHEN len(channels) = 0 "
    f"THEN 'no_channel' WHEN pattern IN ({_list(fx.BAD_PATTERNS)}) THEN 'bad_regex' END AS problem FROM config_rules) "
    "WHERE problem IS NOT NULL",
}
_WITH = "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in _RELATIONS.items()) + " "


# ---------------------------------------------------------------- shared Spark inputs


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.relation(spark, sf_dir, fx.ACTIVITY)


def _ignored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.relation(spark, sf_dir, fx.IGNORED_TABLES)


def _live_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.live_tables(_activity(spark, sf_dir), fx.SCOPE)


def _stale_tables(spark: SparkSession, sf_dir: str, opted_out: bool = False, **options) -> DataFrame:
    ignored = td.opt_out_datasets(fx.options(spark)) if opted_out else None
    settings = {"as_of": fx.AS_OF, "scope": fx.SCOPE, **options}
    return td.evaluate(
        _activity(spark, sf_dir),
        fx.thresholds(spark),
        ignored,
        _ignored_tables(spark, sf_dir),
        **settings,
    )


def _histories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(
        fx.relation(spark, sf_dir, d) for d in (fx.SOURCE_TABLES, fx.SOURCES, fx.JOB_STATS)
    )


_ORDER = {"runtime": "batch_runtime", "tiebreak": ["event_id"]}


def _full_report(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    facts = td.enrichment(*_histories(spark, sf_dir), spread=spread, **_ORDER)
    return td.report(_stale_tables(spark, sf_dir, opted_out=True), facts, spread)


def _rules(spark: SparkSession) -> DataFrame:
    return td.rules_from_json(spark, fx.ROUTING)


def _many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.relation(spark, sf_dir, fx.MANY_RULES).select(
        "rule_no",
        "pattern",
        F.array(F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("channels"),
        F.lit(False).alias("is_default"),
    )


def _configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.relation(spark, sf_dir, fx.CONFIGS)


def _named_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.dataset_counts(fx.relation(spark, sf_dir, fx.NAMED_RECORDS))


def _projects(df: DataFrame) -> DataFrame:
    return df.withColumn("present_in_projects", F.array_join("present_in_projects", ","))


def _channels(df: DataFrame) -> DataFrame:
    return df.withColumn("channels", F.array_join("channels", ","))


def _modified(df: DataFrame) -> DataFrame:
    column = "storage_last_modified_time"
    return df.withColumn(column, second_text(F.col(column)))


def _stale_text(df: DataFrame) -> DataFrame:
    return _projects(df).withColumn("last_update", second_text(F.col("last_update")))


# ---------------------------------------------------------------- collection


@_register(
    "SELECT source_project_id, table_schema, table_name, deleted, "
    f"{_text('max(storage_last_modified_time)')} AS storage_last_modified_time FROM lineitem_activity "
    "GROUP BY source_project_id, table_schema, table_name, deleted"
)
def table_activity(spark, sf_dir):
    rows = fx.relation(spark, sf_dir, fx.LINEITEM_ACTIVITY)
    columns = ["source_project_id", "table_schema", "table_name", "storage_last_modified_time", "deleted"]
    return _modified(td.table_activity(rows, *(F.col(column) for column in columns)))


@_register(ENTRIES["table_activity"].oracle.removeprefix(_WITH))
def activity_in_batches(spark, sf_dir):
    """Two days of files; the second day reads its own only, and the state is that of both at once."""
    lake, state = f"{td.scratch_folder(spark)}/lake", td.scratch_folder(spark)
    rows = fx.relation(spark, sf_dir, fx.LINEITEM_ACTIVITY)
    for day in range(2):
        rows.where(F.crc32(F.col("table_name").cast("binary")) % 2 == day).unionByName(rows.where("deleted")).write.mode("append").parquet(lake)
        found = td.fold_new_files(spark, [lake], state, lambda files: files)
    return _modified(found)


@_register(
    "SELECT 'proj_x' AS source_project_id, table_schema, table_name, "
    f"{_text('storage_last_modified_time')} AS storage_last_modified_time, deleted FROM activity "
    "UNION ALL BY NAME SELECT 'proj_y' AS source_project_id, deleted, table_name, table_schema, "
    f"{_text('storage_last_modified_time')} AS storage_last_modified_time FROM lineitem_activity"
)
def union_sources(spark, sf_dir):
    sources = {
        "proj_x": [_activity(spark, sf_dir), f"{sf_dir}/no_such_region.parquet"],
        "proj_y": fx.relation(spark, sf_dir, fx.LINEITEM_ACTIVITY),
        "proj_z": "no_such_table",
    }
    return _modified(td.union_sources(spark, sources))


@_register(
    "SELECT DISTINCT 'set_' || p_brand AS schema_name FROM part WHERE p_size % 3 = 0 "
    "AND '[STRUCT(\"latency_check_ignore\", \"' || CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END || '\")]' "
    "LIKE '%\"latency_check_ignore\", \"true\"%'"
)
def opt_out_datasets(spark, sf_dir):
    options = fx.table(spark, sf_dir, "part").select(
        F.concat(F.lit("set_"), "p_brand").alias("schema_name"),
        F.when(F.col("p_size") % 3 == 0, "labels").otherwise("description").alias("option_name"),
        F.concat(
            F.lit('[STRUCT("latency_check_ignore", "'),
            F.when(F.col("p_size") % 2 == 0, "true").otherwise("false"),
            F.lit('")]'),
        ).alias("option_value"),
    )
    return td.opt_out_datasets(options)


@_register(
    "SELECT 'activity' AS input, count(*) AS row_count FROM activity UNION ALL "
    "SELECT 'source_tables', count(*) FROM source_tables UNION ALL SELECT 'configs', count(*) FROM configs"
)
def staging_counts(spark, sf_dir):
    return td.row_counts(
        {
            "activity": _activity(spark, sf_dir),
            "source_tables": fx.relation(spark, sf_dir, fx.SOURCE_TABLES),
            "configs": _configs(spark, sf_dir),
        }
    )


# File times differ per machine; that there is one, and for which tables, does not.
_FILES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders",
    "pages", "part", "region", "supplier",
)


@_register(
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count, true AS has_time FROM {name}" for name in _FILES)
)
def file_freshness(spark, sf_dir):
    paths = [f"{sf_dir}/{name}.parquet" for name in _FILES]
    files = listed_files(spark, paths).select("file", "table_name").join(rows_per_file(spark, paths), "file")
    rows = files.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))
    times = td.file_activity(spark, paths, "files").select("table_name", "storage_last_modified_time")
    return rows.join(times, "table_name").select("table_name", "row_count", F.col("storage_last_modified_time").isNotNull().alias("has_time"))


@_register("SELECT table_schema, table_name FROM stale")
def empty_options(spark, sf_dir):
    """No dataset opts out: the staged list is empty, and nothing is excluded by it."""
    target = td.scratch_folder(spark)
    td.replace_table(td.opt_out_datasets(spark.createDataFrame([], OPTIONS)), target)
    stale = td.evaluate(
        _activity(spark, sf_dir),
        fx.thresholds(spark),
        td.read_table(spark, target),
        _ignored_tables(spark, sf_dir),
        as_of=fx.AS_OF,
        scope=fx.SCOPE,
    )
    return stale.select("table_schema", "table_name")


@_register(f"SELECT table_schema, table_name FROM ({_stale('matched', '2026-01-01 00:00:00')})")
def stale_tables_now(spark, sf_dir):
    """As of now. All times are years old, so the tables are the same at any later time."""
    return _stale_tables(spark, sf_dir, as_of=None).select("table_schema", "table_name")


# ---------------------------------------------------------------- evaluation

# Every name the monitored warehouse treats specially, and some it does not.
_SPECIAL_DATASETS = [
    *P.MONITORED.excluded_datasets,
    *(dataset for _, dataset in P.MONITORED.excluded_pairs),
    "acme_prod_raw", "prod_raw", "aXprodYraw", "daton_acme", "Daton_acme", "acme_bq", "nexus_gds_raw",
    "Nexus_gds_raw", "scratch", None,
]
_SPECIAL_PROJECTS = [*dict.fromkeys(project for project, _ in P.MONITORED.excluded_pairs), "other", None]
_SPECIAL_TABLES = [*P.MONITORED.excluded_tables, "orders", None]


def _pick(names: list[str | None], number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {_quoted(name)}" for i, name in enumerate(names))
    return f"CASE {number} % {len(names)} {cases} END"


_SPECIAL = [
    f"{_pick(_SPECIAL_PROJECTS, 'user_id')} AS source_project_id",
    f"{_pick(_SPECIAL_DATASETS, 'event_id')} AS table_schema",
    f"{_pick(_SPECIAL_TABLES, '(event_id + user_id)')} AS table_name",
    "ts AS storage_last_modified_time",
    "CASE WHEN event_id % 13 <> 0 THEN value > 60 END AS deleted",
    "event_id",
]


@_register(
    f"SELECT event_id, source_project_id, table_schema, table_name FROM (SELECT {', '.join(_SPECIAL)} FROM events) "
    f"WHERE {_in_scope(P.MONITORED)}"
)
def scope_filter(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").selectExpr(*_SPECIAL)
    return td.scope_filter(rows).select("event_id", "source_project_id", "table_schema", "table_name")


@_register(
    f"SELECT table_schema, table_name, {_text('modified')} AS storage_last_modified_time, "
    f"projects AS present_in_projects FROM ({_live('shared_activity')})"
)
def live_tables(spark, sf_dir):
    shared = fx.relation(spark, sf_dir, fx.SHARED_ACTIVITY)
    return _projects(_modified(td.live_tables(shared, fx.SCOPE)))


@_register(
    "SELECT table_schema, table_name, table_pattern, latency_threshold FROM "
    f"({_matched('live', 'thresholds')})"
)
def threshold_match(spark, sf_dir):
    matched = td.match_thresholds(_live_tables(spark, sf_dir), fx.thresholds(spark))
    return matched.select("table_schema", "table_name", "table_pattern", "latency_threshold")


@_register(
    "SELECT table_schema, table_name, table_pattern, latency_threshold FROM "
    f"({_matched('(' + _live('lineitem_activity') + ')', 'many_thresholds')})"
)
def threshold_match_many(spark, sf_dir):
    tables = td.live_tables(fx.relation(spark, sf_dir, fx.LINEITEM_ACTIVITY), fx.SCOPE)
    matched = td.match_thresholds(tables, fx.relation(spark, sf_dir, fx.MANY_THRESHOLDS))
    return matched.select("table_schema", "table_name", "table_pattern", "latency_threshold")


@_register(
    "SELECT table_schema, table_name, table_pattern, latency_threshold FROM "
    f"({_matched('unnamed', 'many_thresholds')})"
)
def threshold_match_many_unnamed(spark, sf_dir):
    """Many patterns, and tables without a name: those fit nothing and stay."""
    tables = fx.relation(spark, sf_dir, fx.UNNAMED_TABLES)
    matched = td.match_thresholds(tables, fx.relation(spark, sf_dir, fx.MANY_THRESHOLDS))
    return matched.select("table_schema", "table_name", "table_pattern", "latency_threshold")


@_register(
    "SELECT table_schema, table_name FROM live l WHERE NOT EXISTS "
    "(SELECT 1 FROM opted_out o WHERE o.schema_name = l.table_schema)"
)
def ignore_datasets(spark, sf_dir):
    opted_out = td.opt_out_datasets(fx.options(spark))
    return td.ignore_datasets(_live_tables(spark, sf_dir), opted_out).select("table_schema", "table_name")


@_register("SELECT table_schema, table_name FROM not_ignored")
def ignore_tables(spark, sf_dir):
    return td.ignore_tables(_live_tables(spark, sf_dir), _ignored_tables(spark, sf_dir)).select(
        "table_schema", "table_name"
    )


@_register(
    "SELECT table_schema, table_name, table_pattern, coalesce(latency_threshold, 24) AS latency_threshold "
    f"FROM ({_matched('live', 'thresholds')}) WHERE table_pattern IS NOT NULL OR {_HAS_DEFAULT}"
)
def eligible_tables(spark, sf_dir):
    matched = td.match_thresholds(_live_tables(spark, sf_dir), fx.thresholds(spark))
    return td.eligible_tables(matched, fx.SCOPE).select(
        "table_schema", "table_name", "table_pattern", "latency_threshold"
    )


@_register(f"SELECT {_STALE_COLUMNS} FROM stale_in")
def stale_tables(spark, sf_dir):
    return _stale_text(_stale_tables(spark, sf_dir, opted_out=True))


@_register(f"SELECT {_STALE_COLUMNS} FROM ({_stale('matched', fx.AS_OF, _HOURS_ON_CLOCK)})")
def stale_tables_boundary(spark, sf_dir):
    return _stale_text(_stale_tables(spark, sf_dir, hour_mode="boundary"))


@_register(
    f"SELECT {_STALE_COLUMNS} FROM ("
    + _stale(
        f"({_matched('(' + _live('lineitem_activity') + ')', 'many_thresholds')})", fx.LINEITEM_AS_OF
    )
    + ")"
)
def lineitem_stale_tables(spark, sf_dir):
    return _stale_text(
        td.evaluate(
            fx.relation(spark, sf_dir, fx.LINEITEM_ACTIVITY),
            fx.relation(spark, sf_dir, fx.MANY_THRESHOLDS),
            as_of=fx.LINEITEM_AS_OF,
            scope=fx.SCOPE,
        )
    )


# ---------------------------------------------------------------- enrichment and report


@_register("SELECT tableid, sourceid, companyid, status, tablename FROM latest_t")
def latest_source_tables(spark, sf_dir):
    return td.latest_source_tables(fx.relation(spark, sf_dir, fx.SOURCE_TABLES), **_ORDER)


@_register("SELECT sourceid, companyid, type, status, name FROM latest_s")
def latest_sources(spark, sf_dir):
    return td.latest_sources(fx.relation(spark, sf_dir, fx.SOURCES), **_ORDER)


@_register(
    "SELECT tableid, sourceid, lasterrorcode, lasterror, "
    f"{_text('last_job_end_time')} AS last_job_end_time FROM latest_j"
)
def latest_job_stats(spark, sf_dir):
    latest = td.latest_job_stats(fx.relation(spark, sf_dir, fx.JOB_STATS), **_ORDER)
    return latest.withColumn("last_job_end_time", second_text(F.col("last_job_end_time")))


@_register(
    "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
)
def latest_order_per_customer(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    latest = td.latest_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


_FACT_COLUMNS = (
    "companyid, platform, source_status, lasterrorcode, lasterror, "
    f"{_text('last_job_end_time')} AS last_job_end_time, table_name"
)


def _facts_text(df: DataFrame) -> DataFrame:
    return df.withColumn("last_job_end_time", second_text(F.col("last_job_end_time")))


@_register(f"SELECT {_FACT_COLUMNS} FROM facts")
def enrichment(spark, sf_dir):
    return _facts_text(td.enrichment(*_histories(spark, sf_dir), **_ORDER))


@_register(
    f"SELECT {_FACT_COLUMNS} FROM ("
    + _facts("latest_t").replace("j.tableid = t.tableid", "j.tableid = t.tableid AND j.sourceid = t.sourceid")
    + ")"
)
def enrichment_strict(spark, sf_dir):
    return _facts_text(td.enrichment(*_histories(spark, sf_dir), strict_key=True, **_ORDER))


@_register(f"SELECT {_REPORT_COLUMNS} FROM full_report_in")
def full_report(spark, sf_dir):
    return _projects(_full_report(spark, sf_dir))


@_register(f"SELECT {_REPORT_COLUMNS} FROM full_report_in")
def full_report_spread(spark, sf_dir):
    return _projects(_full_report(spark, sf_dir, spread=True))


# ---------------------------------------------------------------- routing


@_register(
    "SELECT config_id, rule_no, pattern, array_to_string(channels, ',') AS channels, is_default FROM config_rules r "
    "WHERE NOT EXISTS (SELECT 1 FROM config_problems p WHERE p.config_id = r.config_id)"
)
def routing_rules(spark, sf_dir):
    return _channels(td.parse_rules(_configs(spark, sf_dir)))


@_register("SELECT config_id, rule_no, pattern, problem FROM config_problems")
def bad_rules(spark, sf_dir):
    return td.check_rules(_configs(spark, sf_dir))


@_register(
    "SELECT c.config_id, coalesce(array_to_string(r.channels, ','), "
    f"{_quoted(','.join(P.FALLBACK_CHANNELS))}) AS channels FROM configs c "
    "LEFT JOIN (SELECT * FROM config_rules WHERE is_default AND config_id NOT IN "
    "(SELECT config_id FROM config_problems)) r ON r.config_id = c.config_id"
)
def failure_channels(spark, sf_dir):
    return _channels(td.failure_channels(_configs(spark, sf_dir)))


@_register(
    "SELECT event_id, coalesce(dataset_id, dataset, table_schema) AS dataset_id FROM record_ids "
    "WHERE coalesce(dataset_id, dataset, table_schema) <> ''"
)
def dataset_id(spark, sf_dir):
    records = fx.relation(spark, sf_dir, fx.RECORD_IDS)
    found = records.select("event_id", td.dataset_id(records).alias("dataset_id"))
    return found.filter(has_id("dataset_id"))


@_register("SELECT table_schema, table_name, route, is_default, channels FROM routed")
def route_records(spark, sf_dir):
    routed = td.route(_stale_tables(spark, sf_dir), _rules(spark))
    return _channels(routed.select("table_schema", "table_name", "route", "is_default", "channels"))


@_register("SELECT DISTINCT table_schema, table_name, route, is_default, channels FROM routed")
def route_records_deduped(spark, sf_dir):
    routed = td.route(_stale_tables(spark, sf_dir), _rules(spark), dedupe=True)
    return _channels(routed.select("table_schema", "table_name", "route", "is_default", "channels"))


@_register(
    "SELECT table_schema, table_name, 'default:C0' AS route FROM live UNION ALL "
    "SELECT table_schema, table_name, 'match:N' || s_nationkey FROM live JOIN many_rules "
    "ON regexp_matches(table_name, pattern)"
)
def route_records_many_rules(spark, sf_dir):
    tables = _live_tables(spark, sf_dir).select("table_schema", "table_name")
    routed = td.route(tables, _many_rules(spark, sf_dir), id_columns=["table_name"], fallback_channels=["C0"])
    return routed.select("table_schema", "table_name", "route")


@_register(
    "SELECT table_schema, table_name, 'default:D' || d AS route FROM live, range(2) t(d) UNION ALL "
    "SELECT table_schema, table_name, 'match:N' || s_nationkey FROM live JOIN many_rules "
    "ON regexp_matches(table_name, pattern)"
)
def route_records_many_defaults(spark, sf_dir):
    """Many rules, two of them defaults: each record reaches both."""
    rules = _many_rules(spark, sf_dir)
    defaults = spark.range(2).select(
        F.lit(0).alias("rule_no"),
        F.lit(None).cast("string").alias("pattern"),
        F.array(F.concat(F.lit("D"), F.col("id").cast("string"))).alias("channels"),
        F.lit(True).alias("is_default"),
    )
    tables = _live_tables(spark, sf_dir).select("table_schema", "table_name")
    routed = td.route(tables, rules.unionByName(defaults), id_columns=["table_name"])
    return routed.select("table_schema", "table_name", "route")


@_register(_route_summary("routed"))
def route_summary(spark, sf_dir):
    rules = _rules(spark)
    return _channels(td.route_summary(td.route(_stale_tables(spark, sf_dir), rules), rules))


# ---------------------------------------------------------------- summaries


@_register("SELECT table_schema, count(*) AS violations FROM full_report_in GROUP BY table_schema")
def dataset_counts(spark, sf_dir):
    return td.dataset_counts(_full_report(spark, sf_dir))


@_register(
    "SELECT CAST(sum(violations) AS BIGINT) AS total_violations, count(*) AS total_datasets FROM named_counts"
)
def totals(spark, sf_dir):
    return td.totals(_named_counts(spark, sf_dir))


@_register(
    f"SELECT line_no, table_schema, violations, line, length_so_far FROM ({_summary('named_counts', 'one')}) "
    "WHERE length_so_far <= 2800"
)
def summary_lines(spark, sf_dir):
    return td.summary_lines(_named_counts(spark, sf_dir)).select(
        F.col("line_no").cast("bigint").alias("line_no"), "table_schema", "violations", "line", "length_so_far"
    )


@_register(
    "SELECT total_violations, total_datasets, shown, summary_text FROM "
    f"({_summary_text('(' + _summary('named_counts', 'one') + ')', 'one')})"
)
def summary_text(spark, sf_dir):
    return td.summary_text(_named_counts(spark, sf_dir))


@_register(
    "SELECT table_schema, violations FROM named_counts ORDER BY violations DESC, table_schema LIMIT 5"
)
def top_datasets(spark, sf_dir):
    return td.top_datasets(_named_counts(spark, sf_dir))


# ---------------------------------------------------------------- export


def _width(column: str, shown: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, least(greatest(length('{column}'), "
        f"coalesce(max(length({shown})), 0)) + 2, 50) AS width FROM full_report_in"
    )


_WIDTHS = {
    "table_schema": "table_schema",
    "table_name": "table_name",
    "last_update": _text("last_update"),
    "latency_threshold": "CAST(latency_threshold AS VARCHAR)",
    "hours_since_last_update": "CAST(hours_since_last_update AS VARCHAR)",
    "present_in_projects": "'[''' || replace(projects, ',', ''', ''') || ''']'",
    "platform": "platform",
    "source_status": "source_status",
    "lasterrorcode": "CAST(lasterrorcode AS VARCHAR)",
    "lasterror": "lasterror",
    "last_job_end_time": _text("last_job_end_time"),
}


@_register(
    "SELECT column_name, CAST(width AS INT) AS width FROM ("
    + " UNION ALL ".join(_width(*pair) for pair in _WIDTHS.items())
    + ")"
)
def column_widths(spark, sf_dir):
    return td.column_widths(_full_report(spark, sf_dir))


@_register(
    "SELECT table_schema, table_name, strftime(modified, '%Y-%m-%dT%H:%M:%S') || CASE WHEN "
    "microsecond(modified) % 1000000 = 0 THEN '' ELSE strftime(modified, '.%f') END AS storage_last_modified_time, "
    "'[\"' || replace(projects, ',', '\",\"') || '\"]' AS present_in_projects "
    f"FROM ({_live('shared_activity')})"
)
def export_rows(spark, sf_dir):
    shared = fx.relation(spark, sf_dir, fx.SHARED_ACTIVITY)
    return td.export_rows(td.live_tables(shared, fx.SCOPE), arrays_as_text=True)


@_register(
    f"SELECT {_quoted(P.ALL_CLEAR_REPORT)} AS message FROM "
    f"(SELECT count(*) AS n FROM ({_stale('matched', '2023-12-01 00:00:00')})) WHERE n = 0"
)
def empty_report(spark, sf_dir):
    return td.empty_report(_stale_tables(spark, sf_dir, as_of="2023-12-01 00:00:00"))


@_register(f"SELECT {_STALE_COLUMNS} FROM stale_in")
def violations_roundtrip(spark, sf_dir):
    target = td.scratch_folder(spark)
    td.replace_table(_stale_tables(spark, sf_dir, opted_out=True), target)
    return _stale_text(td.read_violations(spark, target))


def _run_day(spark: SparkSession, sf_dir: str) -> tuple[daily.Workspace, DataFrame]:
    work = daily.Workspace(td.scratch_folder(spark))
    rows = _activity(spark, sf_dir)
    activity = {
        project: rows.filter(F.col("source_project_id") == project).select(
            *(c for c in ACTIVITY.fieldNames() if c != "source_project_id")
        )
        for project in ("proj_a", "proj_b", "proj_c")
    }
    daily.collect(spark, work, activity, {"proj_a": fx.options(spark)})
    daily.check(
        spark,
        work,
        fx.thresholds(spark),
        _ignored_tables(spark, sf_dir),
        *_histories(spark, sf_dir),
        as_of=fx.AS_OF,
        scope=fx.SCOPE,
        **_ORDER,
    )
    return work, daily.publish(spark, work, fx.ROUTING)


@_register(_route_summary("routed_report"))
def daily_run(spark, sf_dir):
    return _channels(_run_day(spark, sf_dir)[1])


@_register(
    "SELECT route, table_schema, table_name, CAST(latency_threshold AS BIGINT) AS latency_threshold FROM routed_report"
)
def report_files(spark, sf_dir):
    """What the daily run wrote for each route, read back from the files."""
    work, _ = _run_day(spark, sf_dir)
    rows = td.read_report(spark, work.table("report"))
    return rows.select("route", "table_schema", "table_name", F.col("latency_threshold").cast("bigint").alias("latency_threshold"))


# ---------------------------------------------------------------- errors


def _holds(text: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), {_quoted(w.lower())})" for w in words) + ")"


def _error_columns(message: str, whole: str) -> str:
    return (
        f"{_holds(whole, P.TRANSIENT_WORDS)} AS is_transient, "
        f"CASE WHEN {_holds(message, ['bigquery'])} THEN 'bigquery_failure' "
        f"WHEN {_holds(message, ['slack'])} THEN 'slack_failure' ELSE 'dag_failure' END AS error_class"
    )


@_register(
    f"SELECT event_id, {_error_columns('message', "kind || ': ' || message")}, "
    f"CASE WHEN task <> '' THEN task WHEN {_holds('message', ['bigquery'])} THEN 'run_latency_check' "
    f"WHEN {_holds('message', ['slack'])} THEN 'convert_and_send_to_slack' ELSE 'unknown' END AS failed_task, "
    "left(message, 500) AS short_message FROM job_log"
)
def error_classes(spark, sf_dir):
    log = fx.relation(spark, sf_dir, fx.JOB_LOG)
    return td.classify_errors(log, "message", "kind", "task").drop("kind", "message", "task")


@_register(
    f"SELECT doc_id, {_error_columns('text', 'text')}, length(left(text, 500)) AS shown FROM documents"
)
def error_classes_of_documents(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return td.classify_errors(documents, "text").select(
        "doc_id", "is_transient", "error_class", F.length("short_message").cast("bigint").alias("shown")
    )
