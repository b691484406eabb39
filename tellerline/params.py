"""Job parameters: trailing windows, trigger modes, clocks and locations."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from enum import Enum
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


def today_in(zone: str = "UTC") -> dt.date:
    return dt.datetime.now(ZoneInfo(zone)).date()


def _parse(text: str, digits: int, pattern: str) -> dt.date:
    if len(text) != digits or not text.isdigit():
        raise ValueError(f"expected {digits} digits, got {text!r}")
    return dt.datetime.strptime(text, pattern).date()


def _add_months(first_of_month: dt.date, months: int) -> dt.date:
    index = first_of_month.year * 12 + first_of_month.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class DayWindow:
    """``anchor - lookback_days .. anchor``, both ends included.

    A lookback of 3 therefore covers four dates. The anchor is the *last* day.
    """

    anchor: dt.date
    lookback_days: int = 3

    @classmethod
    def resolve(
        cls, text: str = "CURRENT_DATE", lookback_days: int = 3, today: dt.date | None = None, zone: str = "UTC"
    ) -> DayWindow:
        """``''`` and ``CURRENT_DATE`` mean today in ``zone``, anything else is ``yyyyMMdd``."""
        if text in ("", "CURRENT_DATE"):
            return cls(today or today_in(zone), lookback_days)
        return cls(_parse(text, 8, "%Y%m%d"), lookback_days)

    @property
    def first(self) -> dt.date:
        return self.anchor - dt.timedelta(days=self.lookback_days)

    @property
    def days(self) -> list[str]:
        return [str(self.first + dt.timedelta(days=i)) for i in range(self.lookback_days + 1)]

    def contains(self, column: Column) -> Column:
        return column.between(F.lit(self.first), F.lit(self.anchor))


@dataclass(frozen=True)
class MonthWindow:
    """The ``lookback_months`` whole months before the anchor's month.

    The anchor's own month is excluded even when it is given explicitly. The
    predicate is a plain date range, so it prunes date partitions.
    """

    anchor: dt.date
    lookback_months: int = 1

    @classmethod
    def resolve(
        cls, text: str = "LAST_MONTH", lookback_months: int = 1, today: dt.date | None = None, zone: str = "UTC"
    ) -> MonthWindow:
        """``''`` and ``LAST_MONTH`` anchor at today in ``zone``, anything else is ``yyyyMM``."""
        if text in ("", "LAST_MONTH"):
            return cls(today or today_in(zone), lookback_months)
        return cls(_parse(text, 6, "%Y%m"), lookback_months)

    @property
    def end(self) -> dt.date:
        """First day after the window."""
        return self.anchor.replace(day=1)

    @property
    def first(self) -> dt.date:
        return _add_months(self.end, -self.lookback_months)

    @property
    def months(self) -> list[dt.date]:
        """First days of the window's months."""
        return [_add_months(self.first, i) for i in range(self.lookback_months)]

    def contains(self, column: Column) -> Column:
        return (column >= F.lit(self.first)) & (column < F.lit(self.end))


@dataclass(frozen=True)
class Stamp:
    """One fixed clock reading, so that all rows of a batch agree on it."""

    instant: dt.datetime

    @classmethod
    def at(cls, instant: dt.datetime | None = None) -> Stamp:
        """Naive datetimes are taken as UTC; no argument reads the clock."""
        if instant is None:
            instant = dt.datetime.now(dt.timezone.utc)
        elif instant.tzinfo is None:
            instant = instant.replace(tzinfo=dt.timezone.utc)
        return cls(instant.astimezone(dt.timezone.utc))

    @property
    def ts(self) -> Column:
        since_epoch = self.instant - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        return F.timestamp_micros(F.lit(since_epoch // dt.timedelta(microseconds=1)))

    @property
    def day(self) -> Column:
        """The stamp's date in the session time zone, like ``current_date``."""
        return F.to_date(self.ts)


class TriggerMode(Enum):
    """``Batch`` drains what has arrived and stops, ``Streaming`` keeps polling."""

    BATCH = "Batch"
    STREAMING = "Streaming"

    @property
    def options(self) -> dict[str, object]:
        return self.every(15)

    def every(self, seconds: int) -> dict[str, object]:
        # availableNow drains everything in rate-limited batches; once=True
        # would ignore the files-per-trigger limit and read a backlog in one go.
        if self is TriggerMode.BATCH:
            return {"availableNow": True}
        return {"processingTime": f"{seconds} seconds"}


@dataclass(frozen=True)
class JobConfig:
    """Locations and settings shared by the jobs of one pipeline.

    All roots must be on storage every executor can reach. The first limit is
    on staged files per micro-batch, the second on bronze files: merges cost
    less per row in larger batches. ``key_buckets``
    is fixed when a table is created: choose it so that one bucket of open
    dimension rows is a few hundred MB. A writer's lease on a table that was not renewed for ``publish_grace_seconds`` may
    be taken over; a reader waits as long for a publish under way. ``change_rows`` keeps, beside each table that a
    merge changes, the rows it took out and put in (for a fact, all rows a second time). ``poll_seconds`` is how
    often a streaming run looks for files. A bucket with more than ``split_rows`` open rows after a merge is split.
    """

    stage_root: str
    bronze_root: str
    silver_root: str
    gold_root: str
    checkpoint_root: str
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    trigger_mode: TriggerMode = TriggerMode.BATCH
    max_files_per_trigger: int = 20
    max_bronze_files_per_trigger: int = 1000
    key_buckets: int = 64
    time_zone: str = "UTC"
    publish_grace_seconds: float = 120
    change_rows: bool = False
    poll_seconds: int = 15
    split_rows: int | None = None

    @classmethod
    def under(cls, root: str, **overrides) -> JobConfig:
        """All locations as sub-folders of one root."""
        folders = {f"{name}_root": f"{root}/{name}" for name in ("stage", "bronze", "silver", "gold")}
        return cls(**{**folders, "checkpoint_root": f"{root}/_checkpoints", **overrides})

    @property
    def trigger(self) -> dict[str, object]:
        return self.trigger_mode.every(self.poll_seconds)

    def layer_root(self, layer: str) -> str:
        return getattr(self, f"{layer}_root")

    def layer_schema(self, layer: str) -> str:
        return getattr(self, f"{layer}_schema")
