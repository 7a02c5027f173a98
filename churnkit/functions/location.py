"""Location parsing (F5, F6): ``"City, ST1-ST2"`` -> ``ST1``.

``get`` returns null for a missing element where ``getItem`` would raise
under ANSI mode, so a location without ``", "`` yields a null state.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def city_of(location) -> Column:
    return F.get(F.split(_c(location), ", "), F.lit(0))


def state_of(location) -> Column:
    """the part after ``", "`` (null when absent)."""
    return F.get(F.split(_c(location), ", "), F.lit(1))


def first_state(state) -> Column:
    """first state of a multi-state area (``NY-NJ-PA`` -> ``NY``)."""
    return F.get(F.split(_c(state), "-"), F.lit(0))
