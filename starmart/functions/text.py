"""Text and price edits, JSON rendering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def suffix_once(name: Column, suffix: str) -> Column:
    """Append ``suffix`` after removing earlier copies, so repeating the edit changes nothing."""
    return F.concat(F.replace(name, F.lit(suffix), F.lit("")), F.lit(suffix))


def scale_price(price: Column, factor: str) -> Column:
    """``price * factor`` rounded back to DECIMAL(18,2)."""
    return (price * F.lit(factor).cast("decimal(4,2)")).cast("decimal(18,2)")


def row_json(columns: Sequence[str], text_columns: Sequence[str] = ()) -> Column:
    """One row as a JSON object; ``text_columns`` (types JSON lacks) are rendered as text."""
    fields = [F.col(c).cast("string").alias(c) if c in text_columns else F.col(c) for c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
