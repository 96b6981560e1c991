"""Helpers that several test modules import (a ``conftest`` of another folder
could hide this one's)."""
import os

FIXTURES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "fixtures")


def rows(df, *cols):
    """Rows as sorted tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
