"""Predicates shared by loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def change_window(updated_at: Column, low: Column | str, high: Column | str) -> Column:
    """``low < updated_at <= high``: each change falls in exactly one run."""
    low = F.lit(low).cast("timestamp_ntz") if isinstance(low, str) else low
    high = F.lit(high).cast("timestamp_ntz") if isinstance(high, str) else high
    return (updated_at > low) & (updated_at <= high)


def any_changed(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any pair differs, NULL being equal to NULL."""
    return reduce(lambda a, b: a | b, [~old.eqNullSafe(new) for old, new in pairs])


def valid_at(day: Column, valid_from: Column, valid_to: Column, bounds: str = "closed") -> Column:
    """Is ``day`` inside a version's validity?  ``closed`` includes the last day, ``half_open`` does not."""
    if bounds == "closed":
        before_end = day <= valid_to
    elif bounds == "half_open":
        before_end = day < valid_to
    else:
        raise ValueError(f"bounds must be 'closed' or 'half_open', not {bounds!r}")
    return (day >= valid_from) & (before_end | valid_to.isNull())
