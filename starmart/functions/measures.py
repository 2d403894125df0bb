"""Bands, stage rates and numerically exact aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Ordered upper edges ``(edge, edge_belongs_to_band, label)``, then the open top."""

    edges: tuple[tuple[int, bool, str], ...]
    top: str
    unknown: str


# Band edges, labels and stage rates.
REVENUE_BANDS = Bands(
    edges=((1_000_000, False, "Under 1M"), (10_000_000, True, "1M-10M")),
    top="Over 10M",
    unknown="Unknown",
)
PRICE_BANDS = Bands(
    edges=((100, False, "Low"), (1000, True, "Medium")),
    top="High",
    unknown="Unknown",
)
STAGE_RATES = {"Won": 100.0, "Lost": 0.0, "Engaging": 75.0, "Prospecting": 25.0}
OTHER_STAGE_RATE = 10.0


def band(value: Column, bands: Bands) -> Column:
    """Label of the band holding ``value``; NULL values are labelled unknown."""
    out = F.when(value.isNull(), bands.unknown)
    for edge, closed, label in bands.edges:
        out = out.when(value <= edge if closed else value < edge, label)
    return out.otherwise(bands.top)


def stage_rate(stage_name: Column) -> Column:
    """Expected success rate by exact stage name; any other or missing name gets the default."""
    chain = F
    for name, rate in STAGE_RATES.items():
        chain = chain.when(stage_name == name, F.lit(rate))
    return chain.otherwise(F.lit(OTHER_STAGE_RATE))


def exact_sum(c: Column) -> Column:
    """Sum exactly (decimal or integer), report as DOUBLE; NULL when every input is NULL."""
    return F.sum(c).cast("double")


def exact_avg(c: Column) -> Column:
    """Exact sum over the non-NULL count; NULL when there is none."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))
