"""Event-time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP or TIMESTAMP_NTZ column."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        # A cast to TIMESTAMP would go through the session zone, which skips and repeats hours.
        elapsed = F.col(name) - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
        seconds = elapsed.cast("interval second").cast("decimal(20,6)")
        return (seconds * F.lit(1_000_000)).cast("long")
    return F.unix_micros(F.col(name))


def seconds(df: DataFrame, name: str, shift: timedelta = timedelta()) -> Column:
    """Whole seconds since 1970 of a time column moved by `shift`, rounded down."""
    at = F.col(name) + F.lit(shift) if shift else F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        days = F.unix_date(at.cast("date")).cast("long")
        return days * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)
    return F.unix_seconds(at)


def length_micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def interval_text(span: timedelta) -> str:
    """The duration as `F.window` and `withWatermark` want it."""
    return f"{length_micros(span)} microseconds"


def above_watermark(flow, condition: Column) -> Column:
    """`condition` so that on a stream it is not evaluated below the watermark.

    The optimizer moves conditions that do not read the event time below it, and then the records
    they drop would not advance it.
    """
    if not flow.df.isStreaming or flow.ts is None:
        return condition
    return F.when(F.col(flow.ts).isNotNull(), condition)


def complete(flow, delay: timedelta | None = None) -> DataFrame:
    """Records with a key and a value, on a stream under a watermark that every record advances."""
    rows = flow.rows()
    if flow.df.isStreaming and delay is not None:
        rows = rows.withWatermark(flow.ts, interval_text(delay))
    return rows.where(above_watermark(flow, flow.has_key & flow.has_value))
