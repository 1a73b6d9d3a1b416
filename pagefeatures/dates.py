"""Day arithmetic for run parameters (driver-side, pure Python)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

FMT = "%Y-%m-%d"


def parse(day: str) -> date:
    return datetime.strptime(day, FMT).date()


def shift(day: str, n: int) -> str:
    """``day`` moved by ``n`` days, as yyyy-MM-dd."""
    return (parse(day) + timedelta(days=n)).strftime(FMT)


def target_day(run_date: str) -> str:
    """A run on date T builds the rows of T-1."""
    return shift(run_date, -1)


def lookback_days(target: str, n: int = 3) -> list[str]:
    """The ``n`` days before ``target``, newest first; the target is excluded."""
    return [shift(target, -i) for i in range(1, n + 1)]


def day_range(lo: str, hi: str) -> list[str]:
    """All days lo..hi inclusive."""
    a, b = parse(lo), parse(hi)
    return [(a + timedelta(days=i)).strftime(FMT) for i in range((b - a).days + 1)]


def training_days(lo: str, hi: str, shift_days: int = 0) -> list[str]:
    """Days whose files feed training.

    ``shift_days=0`` gives lo..hi.  ``shift_days=1`` reproduces the original
    loop, which advanced the day before appending it and so read lo+1..hi+1.
    """
    return [shift(d, shift_days) for d in day_range(lo, hi)]
