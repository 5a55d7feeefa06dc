"""Reporting period shared by every job of one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time


@dataclass(frozen=True)
class Period:
    """Inclusive range of calendar days."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError(f"period ends {self.end} before it starts {self.start}")

    @property
    def year_text(self) -> str:
        return f"{self.start:%Y}"

    @property
    def month_text(self) -> str:
        return f"{self.start:%m}"

    @property
    def first_instant(self) -> datetime:
        return datetime.combine(self.start, time(0, 0, 0))

    @property
    def last_instant(self) -> datetime:
        """23:59:59 of the last day; a fraction after it is outside the window."""
        return datetime.combine(self.end, time(23, 59, 59))


def month_to_date(as_of: date | None = None) -> Period:
    """From the first day of the month of `as_of` (default: today) up to it."""
    day = as_of or date.today()
    return Period(day.replace(day=1), day)
