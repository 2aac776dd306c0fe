"""The test tables read as a monitored warehouse.

Each relation is a list of SQL expressions over one table. Spark and the oracle run
the same text, so both see the same input; what is compared is what they do with it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tidemark.presets import MONITORED

# Declared, so that no job runs to read a schema from file footers.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

AS_OF = "2024-01-31 00:00:00"
LINEITEM_AS_OF = "2001-12-31 00:00:00"
ROUTING = (
    '{"daton|acme": "C1", "acme": "C1", "nexus": "C2", "^Acme": "C3,C1", "zzz": "C9", "default": "C0"}'
)

# As configured for the monitored warehouse, with exclusions that occur in the test tables.
SCOPE = replace(
    MONITORED, excluded_pairs=(("proj_a", "daton_acme"),), excluded_tables=("click_0",)
)

_PROJECT = "CASE user_id % 3 WHEN 0 THEN 'proj_a' WHEN 1 THEN 'proj_b' ELSE 'proj_c' END"
_DATASET = (
    "CASE event_type WHEN 'click' THEN 'acme_prod_raw' WHEN 'view' THEN 'daton_acme' "
    "WHEN 'purchase' THEN 'AcmeBq' WHEN 'signup' THEN 'nexus_gds_raw' ELSE 'scratch' END"
)
_STATUS = (
    "CASE WHEN value < 20 THEN 2 WHEN value < 40 THEN 6 WHEN value < 80 THEN 11 "
    "WHEN value < 120 THEN 5 ELSE 9 END"
)
_RUNTIME = "date_trunc('second', ts) AS batch_runtime"
_SOURCE = (
    "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 "
    "WHEN 'signup' THEN 4 ELSE 5 END AS sourceid"
)

ACTIVITY = (
    "events",
    f"{_PROJECT} AS source_project_id",
    f"{_DATASET} AS table_schema",
    "concat(event_type, '_', CAST(user_id AS VARCHAR(20))) AS table_name",
    "ts AS storage_last_modified_time",
    "value > 60 AS deleted",
)
# The same with tables that several projects hold.
SHARED_ACTIVITY = (
    "events",
    f"{_PROJECT} AS source_project_id",
    f"{_DATASET} AS table_schema",
    "concat(event_type, '_', CAST(user_id % 50 AS VARCHAR(20))) AS table_name",
    "ts AS storage_last_modified_time",
    "value > 60 AS deleted",
)
LINEITEM_ACTIVITY = (
    "lineitem",
    "CASE l_returnflag WHEN 'A' THEN 'proj_a' WHEN 'N' THEN 'proj_n' ELSE 'proj_r' END AS source_project_id",
    "CASE l_linestatus WHEN 'O' THEN 'daton_open' ELSE 'closed_prod_raw' END AS table_schema",
    "concat('part_', CAST(l_partkey AS VARCHAR(20))) AS table_name",
    "l_shipdate AS storage_last_modified_time",
    "l_quantity > 40 AS deleted",
)
# Tables, some without a name.
UNNAMED_TABLES = (
    "part",
    "concat('set_', CAST(p_partkey % 7 AS VARCHAR(20)), '_', CAST(p_partkey AS VARCHAR(20))) AS table_schema",
    "CASE WHEN p_partkey % 4 <> 0 THEN concat('part_', CAST(p_partkey AS VARCHAR(20))) END AS table_name",
)
# More thresholds than a nested loop should take.
MANY_THRESHOLDS = (
    "supplier",
    "concat(CASE s_suppkey % 5 WHEN 0 THEN 'part_' WHEN 1 THEN '%_' WHEN 2 THEN 'p%t_' WHEN 3 THEN '%art%' "
    "ELSE 'part___' END, CAST(s_suppkey % 97 AS VARCHAR(20)), CASE s_suppkey % 3 WHEN 0 THEN '%' WHEN 1 THEN '_' "
    "ELSE '' END) AS table_pattern",
    "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_suppkey % 50 AS INT) * 200 + 1 END AS latency_threshold",
)
IGNORED_TABLES = (
    "nation",
    "'daton_acme' AS table_schema",
    "concat('view_', CAST(n_nationkey AS VARCHAR(20))) AS table_name",
)
SOURCE_TABLES = (
    "events",
    "user_id AS tableid",
    _SOURCE,
    "user_id % 7 AS companyid",
    f"{_STATUS} AS status",
    "CAST(user_id AS VARCHAR(20)) AS tablename",
    "event_id % 5 <> 0 AS selected",
    _RUNTIME,
    "event_id",
)
SOURCES = (
    "events",
    _SOURCE,
    "user_id % 7 AS companyid",
    "event_type AS type",
    f"{_STATUS} AS status",
    "event_type AS name",
    _RUNTIME,
    "event_id",
)
# ``lastendtime`` is text; some of it is no number.
JOB_STATS = (
    "events",
    "user_id AS tableid",
    _SOURCE,
    "CAST(user_id AS VARCHAR(20)) AS tablename",
    f"{_STATUS} AS lasterrorcode",
    "concat('err ', event_type) AS lasterror",
    "ended AS lastendtime",
    _RUNTIME,
    "event_id",
)
JOB_ENDED = {
    "spark": "CASE WHEN event_id % 17 = 0 THEN 'n/a' "
    "ELSE CAST(CAST(CAST(ts - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND) AS BIGINT) * 1000 AS STRING) "
    "END AS ended",
    "oracle": "CASE WHEN event_id % 17 = 0 THEN 'n/a' "
    "ELSE CAST(epoch_ms(date_trunc('second', ts)) AS VARCHAR) END AS ended",
}
CONFIGS = (
    "customer",
    "c_custkey AS config_id",
    "CASE c_custkey % 14 "
    "WHEN 0 THEN '' "
    "WHEN 1 THEN '{\"a\": \"C1\", \"default\": C0}' "
    "WHEN 2 THEN '[\"C1\"]' "
    "WHEN 3 THEN '{\"' || c_mktsegment || '\": \"C1\"}' "
    "WHEN 4 THEN '{\"' || c_mktsegment || '\": null, \"default\": \"C0\"}' "
    "WHEN 5 THEN '{\"a\": 5, \"b\": {\"c\": \"d\"}, \"default\": [\"C0\"]}' "
    "WHEN 6 THEN '{\"a\": \", ,\", \"default\": \"C0\"}' "
    "WHEN 7 THEN '{\"  \": \"C1\", \"default\": \"C0\"}' "
    "WHEN 8 THEN '{\"a\": \"C1\", \"b\": \"C2\", \"a\": \"C3, C4,C3\", \"default\": \"C0\"}' "
    "WHEN 9 THEN '{\"default\": \"C' || c_nationkey || '\", \" default \": \"C1 ,C2\"}' "
    "WHEN 10 THEN '{\"x\": \"C1\", \"default\": \"C0\"} tail' "
    "WHEN 11 THEN '{\"(\": \"C1\", \"default\": \"C0\"}' "
    "WHEN 12 THEN '{\"a\": \"C1\", \"[z-a]\": \"C2\", \"default\": \"C0\"}' "
    "ELSE '{\"' || c_custkey || '|' || c_mktsegment || '\": \" C' || c_nationkey || ', C1,C1 \", "
    "\"default\": \"C0, C' || c_nationkey || '\"}' END AS config",
)
# Patterns of these configs that are no regular expressions.
BAD_PATTERNS = ("(", "[z-a]")
RECORD_IDS = (
    "events",
    "event_id",
    "CASE WHEN event_id % 4 = 0 THEN event_type END AS dataset_id",
    "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('ds_', CAST(user_id AS VARCHAR(20))) END AS dataset",
    "CASE WHEN event_id % 5 <> 0 THEN event_type END AS table_schema",
)
# Records per dataset, with names that are too long for a summary line.
NAMED_RECORDS = (
    "events",
    "concat(event_type, '_', CAST(user_id AS VARCHAR(20)), CASE WHEN user_id % 10 = 0 THEN repeat('x', 90) "
    "ELSE '' END) AS table_schema",
)
JOB_LOG = (
    "events",
    "event_id",
    "CASE event_id % 4 WHEN 0 THEN 'TimeoutError' WHEN 1 THEN 'BrokenPipeError' ELSE 'ValueError' END AS kind",
    "CASE event_id % 9 WHEN 0 THEN 'answer 503 from upstream' WHEN 1 THEN concat('job ', CAST(event_id AS "
    "VARCHAR(20)), ': RATELIMITEXCEEDED') WHEN 2 THEN 'BigQuery job failed' WHEN 3 THEN 'no reply from SLACK' "
    "WHEN 4 THEN concat(repeat('x', 600), ' deadline') WHEN 5 THEN NULL WHEN 6 THEN 'bigquery and slack' "
    "ELSE concat('bad value ', CAST(value AS VARCHAR(20))) END AS message",
    "CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN '' END AS task",
)
MANY_RULES = (
    "supplier",
    "CAST(s_suppkey AS INT) + 1 AS rule_no",
    "concat('^(click|view)_', CAST(s_suppkey AS VARCHAR(20)), '|', CAST(s_suppkey % 89 AS VARCHAR(20)), '7$') AS pattern",
    "s_nationkey",
)

# Thresholds: a satisfied longest pattern, a missing one, an upper-case one, a wildcard underscore.
THRESHOLDS = (
    "(VALUES ('click_%', 48), ('click_1%', 12), ('click_2%', 500), ('%_1_', 96), "
    "('signup_%', CAST(NULL AS INT)), ('signup_2%', 6), ('%purchase%', 30), ('View%', 1)) "
    "t(table_pattern, latency_threshold)"
)
# Only one dataset opts out; the others lack the blank, or are no labels.
OPTIONS = (
    "(VALUES ('nexus_gds_raw', 'labels', '[STRUCT(\"latency_check_ignore\", \"true\")]'), "
    "('AcmeBq', 'labels', '[STRUCT(\"latency_check_ignore\",\"true\")]'), "
    "('daton_acme', 'description', '\"latency_check_ignore\", \"true\"')) "
    "t(schema_name, option_name, option_value)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def relation(spark: SparkSession, sf_dir: str, definition: tuple[str, ...]) -> DataFrame:
    """A relation in Spark."""
    name, _, condition = definition[0].partition(" WHERE ")
    df = table(spark, sf_dir, name)
    if definition is JOB_STATS:
        df = df.selectExpr("*", JOB_ENDED["spark"])
    return (df.filter(condition) if condition else df).selectExpr(*definition[1:])


def relation_sql(definition: tuple[str, ...]) -> str:
    """The same relation as text for the oracle."""
    source = definition[0]
    if definition is JOB_STATS:
        source = f"(SELECT *, {JOB_ENDED['oracle']} FROM {source})"
    return f"SELECT {', '.join(definition[1:])} FROM {source}"


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM {THRESHOLDS}")


def options(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM {OPTIONS}")
