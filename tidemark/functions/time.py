"""Instants, display time and ages.

Inside the library an instant is a ``timestamp_ntz`` in UTC. That keeps every
comparison and age free of the session time zone, whatever the session has set.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _since_epoch(step: str, count: Column) -> Column:
    """The UTC instant ``count`` steps after 1970."""
    return F.expr(_EPOCH) + F.expr(f"INTERVAL '{step}' SECOND") * count


def utc_instant(df: DataFrame, column: str) -> Column:
    """``column`` as a UTC instant; a zone-less timestamp is taken to be UTC already."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(column)
    if isinstance(kind, T.TimestampType):
        return _since_epoch("0.000001", F.unix_micros(column))
    raise TypeError(f"{column} must be a timestamp, not {kind.simpleString()}")


def utc_from_millis(df: DataFrame, column: str) -> Column:
    """Epoch milliseconds as a UTC instant; text that is no whole number gives NULL."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        value = F.round(value)
    return _since_epoch("0.001", value.try_cast("bigint"))


def as_of_instant(as_of: datetime | str | Column | None) -> Column:
    """The evaluation time as a UTC instant; ``None`` is the query's own start time."""
    if as_of is None:
        return _since_epoch("0.000001", F.unix_micros(F.current_timestamp()))
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def hours(count: Column) -> Column:
    """An interval of ``count`` whole hours."""
    return F.expr("INTERVAL '1' HOUR") * count


def local_time(instant: Column, zone: str) -> Column:
    """A UTC instant as wall-clock time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)


def _whole_hours(interval: Column) -> Column:
    return interval.cast("interval hour").cast("bigint")


def elapsed_hours(earlier: Column, later: Column) -> Column:
    """Whole hours that have passed between two times."""
    return _whole_hours(later - earlier)


def hour_boundaries(earlier: Column, later: Column) -> Column:
    """How often the clock struck a full hour between two wall-clock times."""
    epoch = F.expr(_EPOCH)
    return _whole_hours(later - epoch) - _whole_hours(earlier - epoch)


def second_text(local: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a zone-less time, the fraction cut off."""
    return F.substring(local.cast("string"), 1, 19)


def iso_text(df: DataFrame, column: str) -> Column:
    """ISO text with a six-digit fraction if there is one; instants carry their offset."""
    plain = F.replace(utc_instant(df, column).cast("string"), F.lit(" "), F.lit("T"))
    text = F.when(F.contains(plain, F.lit(".")), F.rpad(plain, 26, "0")).otherwise(plain)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.concat(text, F.lit("+00:00"))
    return text
