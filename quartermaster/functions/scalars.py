"""Scalar column functions (X1-X14). All are built-in expressions, so they
stay inside whole-stage code generation."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_lit(as_of) -> Column:
    """The run's clock as a literal (T9: one instant per run).

    A naive ``datetime`` / ISO string becomes ``TIMESTAMP_NTZ`` (wall clock,
    the type the landed tables carry); an aware ``datetime`` becomes an
    instant (``TIMESTAMP``). ``None`` falls back to ``current_timestamp()``,
    which Spark also fixes once per query.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            return F.lit(as_of)
        return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(as_of, _dt.date):
        return F.lit(as_of.isoformat()).cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def as_of_date(as_of) -> Column:
    return F.to_date(as_of_lit(as_of))


def prefixed_text(prefix: str, value) -> Column:
    """``'label' || value`` - NULL-propagating (``concat``, not
    ``concat_ws``), with the value cast to text so that branches of mixed id
    types union as strings."""
    return F.concat(F.lit(prefix), _c(value).cast("string"))


def composite_text(*parts, sep: str = "-", null_text: str | None = None) -> Column:
    """``f"{a}-{b}"``. With ``null_text=None`` a NULL part makes the
    key NULL (recommended); ``null_text='None'`` reproduces Python's
    printing of a missing value."""
    cols = []
    for i, p in enumerate(parts):
        c = _c(p).cast("string")
        if null_text is not None:
            c = F.coalesce(c, F.lit(null_text))
        if i:
            cols.append(F.lit(sep))
        cols.append(c)
    return F.concat(*cols)


def drop_last_chars(s, n: int) -> Column:
    """Python's ``s[:-n]`` - an empty string when ``s`` is shorter
    than ``n`` (never an error)."""
    s = _c(s)
    return F.left(s, F.greatest(F.length(s) - F.lit(n), F.lit(0)))


def falsy_to_null(c) -> Column:
    """Python truthiness on text - ``''`` becomes NULL."""
    return F.nullif(_c(c), F.lit(""))


def json_text(c, keep_nulls: bool = True) -> Column:
    """JSON text of a struct / array. ``keep_nulls`` keeps null
    fields (``json.dumps`` does). SQL NULL stays NULL; compare as parsed
    JSON, not as text (key order and escaping differ)."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(_c(c), opts)


def date_stamp(as_of, fmt: str = "yyyy-MM-dd") -> Column:
    """Zero-padded date stamp of the run clock."""
    return F.date_format(as_of_lit(as_of), fmt)


def weighted_sum(terms: list[tuple[object, float | int]], fill_zero: list[bool] | None = None) -> Column:
    """``sum(w_i * x_i)``; ``fill_zero[i]`` replaces NULL x_i by 0 (the
    others propagate NULL, so a NULL there makes the whole score NULL)."""
    fill_zero = fill_zero or [False] * len(terms)
    total = None
    for (x, w), fz in zip(terms, fill_zero):
        x = _c(x)
        if fz:
            x = F.coalesce(x, F.lit(0))
        term = x * F.lit(w)
        total = term if total is None else total + term
    return total


def local_date(ts, zone: str, source_zone: str = "UTC") -> Column:
    """The calendar date in ``zone`` of a wall-clock timestamp recorded
    in ``source_zone``. ``convert_timezone`` works on ``TIMESTAMP_NTZ`` and
    does not depend on the session time zone."""
    return F.to_date(F.convert_timezone(F.lit(source_zone), F.lit(zone),
                                        _c(ts).cast("timestamp_ntz")))
