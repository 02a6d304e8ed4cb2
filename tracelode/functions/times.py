"""Event times are UTC wall clock (TIMESTAMP_NTZ): arithmetic must not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_utc(instant: Column) -> Column:
    """An instant as UTC wall clock, whatever the session time zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def as_instant(utc: Column) -> Column:
    """The reverse, for operators that want instants (watermarks and windows)."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")


def since_epoch(utc: Column) -> Column:
    """Seconds since 1970 as an exact decimal. A cast to TIMESTAMP would bend times around a
    clock change of the session time zone."""
    elapsed = utc - F.lit("1970-01-01").cast("timestamp_ntz")
    return elapsed.cast("interval second").cast("decimal(20,6)")


def from_micros(micros: Column) -> Column:
    """UTC wall clock from microseconds since 1970, exactly."""
    seconds = micros.cast("decimal(24,6)") / F.lit(1_000_000)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + step


def epoch_seconds(utc: Column) -> Column:
    return F.floor(since_epoch(utc)).cast("bigint")


def utc_column(df: DataFrame, name: str) -> Column:
    """A time column as UTC wall clock, from either timestamp type."""
    is_instant = isinstance(df.schema[name].dataType, T.TimestampType)
    return as_utc(F.col(name)) if is_instant else F.col(name)
