"""Window specifications for grouped streams."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relstream.functions.times import interval_text, length_micros

WINDOW = "window"


@dataclass(frozen=True)
class TimeWindows:
    """Windows of `size` that start every `slide`; `start` included, `end` excluded.

    `retention` is how long late records are still counted on a stream: its watermark delay.
    """

    size: timedelta
    slide: timedelta | None = None
    retention: timedelta | None = None

    @property
    def overlap(self) -> bool:
        return self.slide is not None and self.slide < self.size

    def panes(self) -> TimeWindows:
        """The longest windows that do not overlap and of which each of these is made up."""
        pane = math.gcd(length_micros(self.size), length_micros(self.slide or self.size))
        return TimeWindows(timedelta(microseconds=pane))

    def over(self, panes: DataFrame, pane: str) -> DataFrame:
        """Adds the window column to rows of panes; a pane is in every window that its start is in."""
        return TimeWindows(self.size, self.slide).assign(panes.withColumn("__at", F.col(f"{pane}.start")), "__at").drop("__at")

    def assign(self, df: DataFrame, ts: str) -> DataFrame:
        """Adds the window column; a record in several windows becomes several rows."""
        slide = interval_text(self.slide) if self.slide else None
        return df.withColumn(WINDOW, F.window(F.col(ts), interval_text(self.size), slide))


@dataclass(frozen=True)
class UnlimitedWindows:
    """One window that begins at `start` and never ends."""

    start: datetime
    retention: timedelta | None = None

    def assign(self, df: DataFrame, ts: str) -> DataFrame:
        kind = df.schema[ts].dataType
        start = F.lit(self.start.isoformat(sep=" ")).cast(kind)
        return df.where(F.col(ts) >= start).withColumn(
            WINDOW, F.struct(start.alias("start"), F.lit(None).cast(kind).alias("end"))
        )


@dataclass(frozen=True)
class SessionWindows:
    """Sessions: a record joins one if it is at most `gap` away from a record in it."""

    gap: timedelta
    retention: timedelta | None = None

    def of(self, ts: str) -> Column:
        return F.session_window(F.col(ts), interval_text(self.gap))


def tumbling(size: timedelta, retention: timedelta | None = None) -> TimeWindows:
    return TimeWindows(size, None, retention)


def hopping(size: timedelta, slide: timedelta, retention: timedelta | None = None) -> TimeWindows:
    return TimeWindows(size, slide, retention)


def unlimited(start: datetime, retention: timedelta | None = None) -> UnlimitedWindows:
    return UnlimitedWindows(start, retention)


def sessions(gap: timedelta, retention: timedelta | None = None) -> SessionWindows:
    return SessionWindows(gap, retention)
