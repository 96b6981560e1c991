"""Predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bag_key_count(raw_json) -> Column:
    """Number of top-level keys of a JSON object held as text; NULL for a
    NULL (or JSON ``null``) bag."""
    keys = F.json_object_keys(_c(raw_json))
    # size(NULL) is -1 outside ANSI mode: guard so NULL stays NULL everywhere
    return F.when(keys.isNotNull(), F.size(keys))


#: an object without members
_EMPTY_BAG = r"^\s*\{\s*\}\s*$"


def bag_nonempty(raw_json) -> Column:
    """C3 (T1): ``properties != {}`` - true for a non-empty object *and* for
    a NULL bag (NULL is not equal to ``{}``); false only for ``{}``. A struct
    read cannot tell ``{}`` from ``{"class": null}``, so the bag is kept as
    raw JSON text; the text alone decides, so that a bag is parsed once, by
    the target that decodes it, however many rules look at it."""
    return ~bag_empty(raw_json)


def bag_empty(raw_json) -> Column:
    """C4: ``properties == {}``."""
    return F.coalesce(_c(raw_json).rlike(_EMPTY_BAG), F.lit(False))


def at_least(c, bound) -> Column:
    """``c >= bound`` (NULL: neither this nor :func:`below`)."""
    return _c(c) >= F.lit(bound)


def below(c, bound) -> Column:
    return _c(c) < F.lit(bound)


def is_false(c) -> Column:
    """``flag = FALSE`` - as a filter; a NULL flag does not pass."""
    return _c(c) == F.lit(False)
