"""Star aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import exact_avg, exact_sum
from starmart.operators.lookup import BROADCAST_BYTES, fits

MONTHLY_GROUP = ("year", "month", "region", "dealstagekey")


@dataclass(frozen=True)
class Join:
    """A dimension of a star: ``fact_key = dim_key`` and the dimension columns to use.

    ``rows`` is the dimension's counted size (None: not counted); ``bounded`` marks one whose
    size has a fixed bound, such as the calendar.
    """

    dim: DataFrame
    fact_key: str
    dim_key: str
    columns: tuple[str, ...]
    rows: int | None = None
    bounded: bool = False

    def small(self, max_broadcast: int) -> bool:
        return self.bounded or (self.rows is not None and fits(self.dim.select(self.dim_key, *self.columns), self.rows, max_broadcast))


def _direct(measures: Mapping[str, tuple[str, str]]) -> list[Column]:
    make = {
        "count": lambda c: F.count(F.lit(1) if c == "*" else F.col(c)),
        "sum": lambda c: exact_sum(F.col(c)),
        "avg": lambda c: exact_avg(F.col(c)),
    }
    return [make[kind](column).alias(name) for name, (kind, column) in measures.items()]


def _partial(measures: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Mergeable parts of each measure: counts and sums only."""
    parts = []
    for name, (kind, column) in measures.items():
        if kind in ("sum", "avg"):
            parts.append(F.sum(column).alias(f"_s_{name}"))
        if kind in ("avg", "count"):
            what = F.lit(1) if column == "*" else F.col(column)
            parts.append(F.count(what).alias(f"_c_{name}"))
    return parts


def _merged(measures: Mapping[str, tuple[str, str]]) -> list[Column]:
    done = []
    for name, (kind, _) in measures.items():
        total, n = F.sum(f"_s_{name}").cast("double"), F.sum(f"_c_{name}")
        made = {"sum": total, "avg": total / F.nullif(n, F.lit(0)), "count": n}[kind]
        done.append(made.alias(name))
    return done


def star_aggregate(
    facts: DataFrame,
    joins: Sequence[Join],
    group: Mapping[str, Column],
    measures: Mapping[str, tuple[str, str]],
    max_broadcast: int = BROADCAST_BYTES,
) -> DataFrame:
    """Group facts by expressions over fact and dimension columns.

    ``measures`` maps a name to ``("count"|"sum"|"avg", column)``.  Small dimensions are
    joined by broadcast ahead of a single aggregation, whose map-side part leaves few rows to
    shuffle.  If a dimension is large, facts are first reduced to one row per large key and
    group, so what meets that dimension is the reduced table and a hot key is a few rows.
    """
    small = [j for j in joins if j.small(max_broadcast)]
    large = [j for j in joins if not j.small(max_broadcast)]
    # A name both sides have, such as a partition column of the facts, means the dimension's.
    out = facts.drop(*[c for j in joins for c in j.columns])
    for i, j in enumerate(small):
        side = j.dim.select(F.col(j.dim_key).alias(f"_s{i}"), *j.columns)
        out = out.join(F.broadcast(side), F.col(j.fact_key) == F.col(f"_s{i}"))
    labels = [c.alias(n) for n, c in group.items()]
    if not large:
        return out.groupBy(*labels).agg(*_direct(measures))
    held = [c for j in small for c in j.columns] + [c for c in group if c in out.columns]
    keys = list(dict.fromkeys([j.fact_key for j in large] + held))
    out = out.groupBy(*keys).agg(*_partial(measures))
    for i, j in enumerate(large):
        side = j.dim.select(F.col(j.dim_key).alias(f"_l{i}"), *j.columns)
        out = out.join(side, F.col(j.fact_key) == F.col(f"_l{i}"))
    return out.groupBy(*labels).agg(*_merged(measures))


SALES_MEASURES = {
    "totaldealcount": ("count", "*"),
    "totalclosevalue": ("sum", "closevalue"),
    "avgdealvalue": ("avg", "closevalue"),
    "avgdurationdays": ("avg", "durationdays"),
    "expectedsuccessrate": ("avg", "expectedsuccessrate"),
}


def calendar(dates: DataFrame, *columns: str) -> Join:
    """The date dimension in a star: never larger than the calendar."""
    return Join(dates, "datekey", "datekey", columns, bounded=True)


def monthly_sales(
    facts: DataFrame, dates: DataFrame, agents: DataFrame, agent_rows: int | None, **sizes
) -> DataFrame:
    """Deals, values and rates per month, region and stage."""
    return star_aggregate(
        facts,
        [
            calendar(dates, "year", "month"),
            Join(agents, "salesagentkey", "salesagentid", ("region",), agent_rows),
        ],
        {
            "year": F.col("year"),
            "month": F.col("month"),
            "region": F.coalesce(F.col("region"), F.lit("Unknown")),
            "dealstagekey": F.col("dealstagekey"),
        },
        SALES_MEASURES,
        **sizes,
    )


def in_months(year: Column, month: Column, months: Sequence[int]) -> Column:
    """Membership in a list of ``yyyymm`` months, as plain tests on partition columns."""
    by_year: dict[int, list[int]] = {}
    for m in months:
        by_year.setdefault(m // 100, []).append(m % 100)
    hit = F.lit(False)
    for y, ms in sorted(by_year.items()):
        hit = hit | ((year == y) & month.isin(sorted(ms)))
    return hit


def refresh_months(previous: DataFrame, recomputed: DataFrame, months: Sequence[int]) -> DataFrame:
    """The monthly aggregate with the given months replaced."""
    kept = previous.filter(~in_months(F.col("year"), F.col("month"), months))
    return kept.unionByName(recomputed)
