"""Resolve the business keys of shaped facts to warehouse keys, keeping what fails."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.lookup import BROADCAST_BYTES, SLICE_ROWS, fits, has_bit, key_bits, key_block, lookup, table_rows, with_slices
from starmart.schemas import FACT_COLUMNS

KEY_FLAGS = {
    "datekey": "missing_date",
    "accountkey": "missing_account",
    "productkey": "missing_product",
    "salesagentkey": "missing_agent",
    "dealstagekey": "missing_stage",
}

#: Where a reject holds the key that a flag says was not found.
FLAG_SOURCES = {
    "missing_date": "eventdate",
    "missing_account": "accountid",
    "missing_product": "productid",
    "missing_agent": "salesagentid",
    "missing_stage": "dealstageid",
}


@dataclass(frozen=True)
class Dimensions:
    """The five dimensions a fact refers to, with their row counts where already known."""

    date: DataFrame
    account: DataFrame
    product: DataFrame
    agent: DataFrame
    stage: DataFrame
    rows: Mapping[str, int] | None = None

    def counted(self) -> Mapping[str, int]:
        """Row counts but for the date dimension: those given, the others found in one job."""
        known = dict(self.rows or {})
        unknown = {
            n: getattr(self, n) for n in ("account", "product", "agent", "stage") if n not in known
        }
        return {**known, **table_rows(unknown)}


@dataclass(frozen=True)
class Resolved:
    """Shaped facts with the resolved keys beside them."""

    flagged: DataFrame

    @property
    def facts(self) -> DataFrame:
        """Rows whose keys were all found (key 0 is a key like any other)."""
        return self.flagged.filter(_all_found())

    @property
    def rejects(self) -> DataFrame:
        """Rows with a key that was not found, and a flag for each such key."""
        flags = [F.col(k).isNull().alias(flag) for k, flag in KEY_FLAGS.items()]
        source = [c for c in self.flagged.columns if c not in KEY_FLAGS]
        return self.flagged.filter(~_all_found()).select(*source, *flags)


#: Keys that are found by themselves: where the fact's own column holds them.
_SAME_KEYS = {"accountkey": "accountid", "salesagentkey": "salesagentid", "dealstagekey": "dealstageid"}


def packed(flagged: DataFrame) -> DataFrame:
    """Resolved rows for storing: a key that equals the row's own column is kept as whether it was found."""
    found = {key: F.col(key).isNotNull() for key in _SAME_KEYS}
    return flagged.withColumns(found)


def unpacked(stored: DataFrame, like: DataFrame) -> DataFrame:
    """The rows that ``packed`` was given, with the columns and types of ``like``."""
    types = {f.name: f.dataType for f in like.schema}
    return stored.withColumns({key: F.when(F.col(key), F.col(own)).cast(types[key]) for key, own in _SAME_KEYS.items()}).select(*like.columns)


def _all_found() -> Column:
    found = F.lit(True)
    for k in KEY_FLAGS:
        found = found & F.col(k).isNotNull()
    return found


def current_versions(product: DataFrame) -> DataFrame:
    """One row ``(_p_id, _p_sk)`` per product with a current version."""
    return (
        product.filter("iscurrent")
        .groupBy(F.col("productid").alias("_p_id"))
        .agg(F.min("productsk").alias("_p_sk"))
    )


def version_ranges(product: DataFrame, bounds: str = "closed") -> DataFrame:
    """``(_p_id, _p_sk, _p_from, _p_until)`` with ``_p_until`` exclusive and no overlap.

    An overlap in the dimension is cut at the start of the next version, so a fact can
    match one version at most.
    """
    if bounds not in ("closed", "half_open"):
        raise ValueError(f"bounds must be 'closed' or 'half_open', not {bounds!r}")
    until = F.date_add(F.col("validto"), 1) if bounds == "closed" else F.col("validto")
    by_start = Window.partitionBy("productid").orderBy("validfrom", "productsk")
    nonempty = product.withColumn("_until", until).filter(
        F.col("_until").isNull() | (F.col("_until") > F.col("validfrom"))
    )
    return nonempty.select(
        F.col("productid").alias("_p_id"),
        F.col("productsk").alias("_p_sk"),
        F.col("validfrom").alias("_p_from"),
        F.least(F.col("_until"), F.lead("validfrom").over(by_start)).alias("_p_until"),
    )


def as_of_join(
    facts: DataFrame,
    product: DataFrame,
    rows: int,
    bounds: str = "closed",
    emit: str = "sk",
    how: str = "left",
    max_broadcast: int = BROADCAST_BYTES,
    slice_rows: int = SLICE_ROWS,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Point-in-time product key: the version valid on each fact's ``eventdate``.

    An equi-join on the product with the validity as a residual condition, so it stays a
    hash join; ``emit`` picks the version's surrogate key or the natural key.
    """
    in_range = lambda: (F.col("eventdate") >= F.col("_p_from")) & (
        F.col("_p_until").isNull() | (F.col("eventdate") < F.col("_p_until"))
    )
    ranges = version_ranges(product, bounds).withColumn(
        "productkey", F.col("_p_sk") if emit == "sk" else F.col("_p_id")
    )
    return lookup(
        facts,
        ranges.drop("_p_sk"),
        "productid",
        "_p_id",
        rows,
        condition=in_range,
        how=how,
        max_broadcast=max_broadcast,
        slice_rows=slice_rows,
        key_source=key_source,
    ).drop("_p_from", "_p_until")


def as_of_merge(
    facts: DataFrame,
    product: DataFrame,
    bounds: str = "closed",
    emit: str = "sk",
    how: str = "left",
    slice_rows: int = SLICE_ROWS,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """``as_of_join`` by one ordered pass, for dimensions with many versions of a key.

    The equi-join compares every fact with every version of its product.  Here facts and versions are unioned, ordered
    by product and day, and the last version is carried forward, so the cost is one sort of both, whatever the number of versions.  A
    product with more than ``slice_rows`` facts is dealt to several tasks, each with all its versions.
    """
    ranges = version_ranges(product, bounds)
    key = F.col("_p_sk") if emit == "sk" else F.col("_p_id")
    versions = ranges.select(F.col("_p_id"), F.col("_p_from").alias("_day"), F.struct(key.alias("key"), F.col("_p_until").alias("until")).alias("_version"))
    events, versions = with_slices(facts, "productid", versions, "_p_id", slice_rows, key_source)
    both = events.select("*", F.col("eventdate").alias("_day"), F.lit(1).alias("_rank")).unionByName(
        versions.withColumnRenamed("_p_id", "productid").withColumn("_rank", F.lit(0)), allowMissingColumns=True)
    # On one day a version comes before the facts; facts without a day come before all versions.
    ordered = Window.partitionBy("productid", "_slice").orderBy(F.asc_nulls_first("_day"), "_rank").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("_held", F.last("_version", ignorenulls=True).over(ordered)).filter("_rank = 1")
    valid = F.col("productid").isNotNull() & (F.col("_held.until").isNull() | (F.col("eventdate") < F.col("_held.until")))
    out = held.withColumn("productkey", F.when(valid, F.col("_held.key"))).select(*facts.columns, "productkey")
    return out if how == "left" else out.filter(F.col("productkey").isNotNull())


def resolve_keys(
    shaped: DataFrame,
    dims: Dimensions,
    product: str = "current",
    bounds: str = "closed",
    emit: str = "sk",
    max_broadcast: int = BROADCAST_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> Resolved:
    """Look up all five keys of shaped facts in one plan.

    ``product="current"`` takes the current version (full load), ``"as_of"`` the version
    valid on the event date (incremental load).  Lookup sides are reduced to one row per key,
    so no fact is multiplied.
    """
    rows = dims.counted()
    size = {"max_broadcast": max_broadcast, "slice_rows": slice_rows, "key_source": shaped}

    def exists(df: DataFrame, dim: DataFrame, dim_key: str, key: str, name: str, n: int) -> DataFrame:
        keys = dim.select(F.col(dim_key).alias("_id"), F.col(dim_key).alias(name)).distinct()
        bits = None if fits(keys, n, max_broadcast) else key_bits(dim, dim_key, max_broadcast)
        if bits is None:
            return lookup(df, keys, key, "_id", n, **size)
        return df.join(F.broadcast(bits), key_block(key) == F.col("_block"), "left").withColumn(name, F.when(has_bit(key), F.col(key))).drop("_block", "_bits")

    # The date dimension covers the years of `operators.dates.YEARS` at most, so its size has a fixed bound.
    days = dims.date.groupBy(F.col("date").alias("_day")).agg(F.min("datekey").alias("datekey"))
    out = shaped.join(F.broadcast(days), F.col("eventdate") == F.col("_day"), "left").drop("_day")
    out = exists(out, dims.account, "accountid", "accountid", "accountkey", rows["account"])
    if product == "current":
        current = current_versions(dims.product).withColumn(
            "productkey", F.col("_p_sk") if emit == "sk" else F.col("_p_id")
        )
        out = lookup(out, current.drop("_p_sk"), "productid", "_p_id", rows["product"], **size)
    elif product == "as_of":
        out = as_of_join(out, dims.product, rows["product"], bounds, emit, **size)
    else:
        raise ValueError(f"product must be 'current' or 'as_of', not {product!r}")
    out = exists(out, dims.agent, "salesagentid", "salesagentid", "salesagentkey", rows["agent"])
    out = exists(out, dims.stage, "stageid", "dealstageid", "dealstagekey", rows["stage"])
    return Resolved(out)


def replay_rejects(rejects: DataFrame, dims: Dimensions, **how) -> Resolved:
    """Resolve kept rejects again, e.g. after a late dimension row has arrived."""
    return resolve_keys(rejects.drop(*KEY_FLAGS.values()), dims, **how)


def mark_retries(
    rejects: DataFrame,
    arrived: Mapping[str, tuple[DataFrame, int]],
    max_broadcast: int = BROADCAST_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Adds ``_retry``: does the reject wait for one of the keys that arrived?

    ``arrived`` maps a flag to the keys (one column) that dimension has gained and their number.  A reject
    that lacks several keys is tried when any of them arrives, and then flagged with what it still lacks; one without a
    key waits for none.  Rejects are only looked up here; resolving is left to those marked.
    """
    out, retry = rejects, F.lit(False)
    for flag, (keys, rows) in arrived.items():
        key, hit = f"_key_{flag}", f"_hit_{flag}"
        side = keys.select(F.col(keys.columns[0]).alias(key)).distinct().withColumn(hit, F.lit(True))
        out = lookup(out, side, FLAG_SOURCES[flag], key, rows, max_broadcast=max_broadcast, slice_rows=slice_rows)
        retry = retry | (F.col(flag) & F.coalesce(F.col(hit), F.lit(False)))
    return out.withColumn("_retry", retry).drop(*[f"_hit_{flag}" for flag in arrived])


def fact_columns(resolved: DataFrame) -> DataFrame:
    return resolved.select(*FACT_COLUMNS)
