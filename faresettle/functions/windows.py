"""Calendar windows, both for one as-of date and for columns of them.

Every window is a pure function of an explicit as-of date. The column forms
compute the windows of a whole backfill in one Spark job.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class DateWindow:
    """An inclusive range of days."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"window starts {self.start} after it ends {self.end}")

    @classmethod
    def of(cls, start: str | date, end: str | date) -> DateWindow:
        return cls(_day(start), _day(end))

    @property
    def iso(self) -> tuple[str, str]:
        return self.start.isoformat(), self.end.isoformat()

    @property
    def key(self) -> str:
        return f"{self.start:%Y%m%d}_{self.end:%Y%m%d}"

    def path(self, root: str, prefix: str, extension: str) -> str:
        """Where the files of this window lie, such as ``root/sales/sales_refund_…``."""
        return f"{root.rstrip('/')}/{prefix}_{self.key}.{extension}"

    def override(self, start: str | date | None = None, end: str | date | None = None) -> DateWindow:
        return replace(
            self,
            start=self.start if start is None else _day(start),
            end=self.end if end is None else _day(end),
        )

    def contains(self, day: Column) -> Column:
        """Inclusive at midnight: a time of day on the last day lies outside."""
        return day.between(F.lit(self.start), F.lit(self.end))

    def contains_text(self, iso_day: Column) -> Column:
        return iso_day.between(*(F.lit(bound) for bound in self.iso))


def _day(value: str | date) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def previous_month(as_of: date) -> DateWindow:
    last = as_of.replace(day=1) - timedelta(days=1)
    return DateWindow(last.replace(day=1), last)


def wed_tue_week(as_of: date, weeks_back: int = 1) -> DateWindow:
    """The Wednesday-to-Tuesday week ``weeks_back`` before the one of ``as_of``."""
    days_since_wednesday = (as_of.weekday() - 2) % 7
    start = as_of - timedelta(days=days_since_wednesday + 7 * weeks_back)
    return DateWindow(start, start + timedelta(days=6))


def previous_month_columns(as_of: Column) -> tuple[Column, Column]:
    inside = F.add_months(as_of, -1)
    return F.trunc(inside, "month"), F.last_day(inside)


def wed_tue_week_columns(as_of: Column, weeks_back: int = 1) -> tuple[Column, Column]:
    days_since_wednesday = F.pmod(F.weekday(as_of) - 2, F.lit(7))
    start = F.date_sub(as_of, days_since_wednesday + 7 * weeks_back)
    return start, F.date_add(start, 6)


def override_columns(
    window: tuple[Column, Column], start: Column | None = None, end: Column | None = None
) -> tuple[Column, Column]:
    """Per-row overrides; a null override keeps the computed bound."""
    first = window[0] if start is None else F.coalesce(start, window[0])
    last = window[1] if end is None else F.coalesce(end, window[1])
    out_of_order = F.raise_error(F.concat_ws(" ", F.lit("window starts after it ends:"), first, last))
    return F.when(first <= last, first).otherwise(out_of_order.cast("date")), last


def window_key_column(start: Column, end: Column) -> Column:
    return F.concat_ws("_", F.date_format(start, "yyyyMMdd"), F.date_format(end, "yyyyMMdd"))
