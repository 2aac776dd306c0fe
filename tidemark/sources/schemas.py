"""Input schemas, checked on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.presets import RUNTIME_COLUMN


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _LONG, _INT, _FLAG, _TIME = (
    T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType(),
)

ACTIVITY = _struct(
    source_project_id=_TEXT, table_schema=_TEXT, table_name=_TEXT,
    storage_last_modified_time=_TIME, deleted=_FLAG,
)
OPTIONS = _struct(schema_name=_TEXT, option_name=_TEXT, option_value=_TEXT)
IGNORED_DATASETS = _struct(schema_name=_TEXT)
IGNORED_TABLES = _struct(table_schema=_TEXT, table_name=_TEXT)
THRESHOLDS = _struct(table_pattern=_TEXT, latency_threshold=_INT)
SOURCE_TABLES = _struct(
    tableid=_LONG, sourceid=_LONG, companyid=_LONG, status=_INT, tablename=_TEXT,
    selected=_FLAG, **{RUNTIME_COLUMN: _TIME},
)
SOURCES = _struct(
    sourceid=_LONG, companyid=_LONG, type=_TEXT, status=_INT, name=_TEXT, **{RUNTIME_COLUMN: _TIME},
)
JOB_STATS = _struct(
    tableid=_LONG, sourceid=_LONG, tablename=_TEXT, lasterrorcode=_INT, lasterror=_TEXT,
    lastendtime=_TEXT, **{RUNTIME_COLUMN: _TIME},
)


def with_runtime(schema: T.StructType, runtime: str) -> T.StructType:
    """The schema of a history whose runtime column has another name."""
    return T.StructType([T.StructField(runtime if f.name == RUNTIME_COLUMN else f.name, f.dataType) for f in schema])


_FAMILIES = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.StringType, T.CharType, T.VarcharType),
    (T.TimestampType, T.TimestampNTZType),
)


def _agrees(found: T.DataType, wanted: T.DataType) -> bool:
    if type(found) is type(wanted):
        return True
    return any(isinstance(found, f) and isinstance(wanted, f) for f in _FAMILIES)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order. Raises TypeError on a missing or wrong one.

    Any width of integer and either kind of timestamp will do; nothing is cast.
    """
    found = {field.name: field.dataType for field in df.schema.fields}
    for field in schema.fields:
        if field.name not in found:
            raise TypeError(f"column {field.name} is missing")
        if not _agrees(found[field.name], field.dataType):
            raise TypeError(
                f"column {field.name} is {found[field.name].simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    return df.select(*schema.fieldNames())
