"""Reporting windows (X15-X18): calendar ranges derived from the run clock,
applied as a half-open filter on a fact table's timestamp so that the
predicate reaches the Parquet scan (``PushedFilters``)."""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_date(as_of) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of)[:10])


def window_bounds(as_of, kind: str, start=None, days: tuple[int, int] = (19, 14)) -> tuple[_dt.date, _dt.date]:
    """``[first, last]`` calendar days (inclusive) of a reporting window.

    * ``prev_month`` (X15): first and last day of the month before ``as_of``;
    * ``interval`` (X16): ``start`` .. ``as_of`` - 1 day (a run's data
      interval, end exclusive);
    * ``trailing`` (X17): ``as_of`` - days[0] .. ``as_of`` - days[1].

    The bounds are computed once on the driver from the run clock (a
    constant per run), so the filter below is a literal range.
    """
    d = _as_date(as_of)
    if kind == "prev_month":
        first_this = d.replace(day=1)
        last_prev = first_this - _dt.timedelta(days=1)
        return last_prev.replace(day=1), last_prev
    if kind == "interval":
        if start is None:
            raise ValueError("interval window needs start")
        return _as_date(start), d - _dt.timedelta(days=1)
    if kind == "trailing":
        return d - _dt.timedelta(days=days[0]), d - _dt.timedelta(days=days[1])
    raise ValueError(f"unknown window kind {kind}")


def _utc_start(day: _dt.date, zone: str) -> _dt.datetime:
    """The UTC wall-clock instant at which ``day`` begins in ``zone``."""
    start = _dt.datetime.combine(day, _dt.time(), ZoneInfo(zone))
    return start.astimezone(_dt.timezone.utc).replace(tzinfo=None)


def reporting_window(df: DataFrame, ts_col: str, as_of, kind: str, start=None,
                     days: tuple[int, int] = (19, 14), zone: str | None = None) -> DataFrame:
    """Rows of ``df`` whose timestamp falls on a day of the window:
    ``first <= ts < last + 1 day`` - a literal range that Parquet can use
    for row-group skipping. With ``zone`` (X18) the day is the local day in
    that zone of a UTC wall-clock timestamp: the two bounds are moved to UTC,
    the column stays bare."""
    first, last = window_bounds(as_of, kind, start, days)
    after = last + _dt.timedelta(days=1)
    lo, hi = (first, after) if zone is None else (_utc_start(first, zone), _utc_start(after, zone))
    ts = F.col(ts_col)
    lo, hi = (F.lit(x.isoformat(" ") if isinstance(x, _dt.datetime) else x.isoformat()).cast("timestamp_ntz") for x in (lo, hi))
    return df.filter((ts >= lo) & (ts < hi))
