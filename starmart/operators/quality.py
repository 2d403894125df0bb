"""Validation: every check is a plan that ends in one row ``(check_name, table_name, violations)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.lookup import BROADCAST_BYTES, lookup, table_rows


def _row(df: DataFrame, check: str, table: str, violations) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "violations"
    )


def repeated_keys(df: DataFrame, key: str, check: str, table: str) -> DataFrame:
    """Keys held by more than one row."""
    return _row(df.groupBy(key).count().filter("count > 1"), check, table, F.count(F.lit(1)))


def null_keys(df: DataFrame, columns: list[str], check: str, table: str) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return _row(df, check, table, F.count_if(missing))


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str, check: str, table: str) -> DataFrame:
    """Rows whose non-NULL ``key`` has no parent row; keys are counted before they are joined."""
    keys = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).count()
    known = parent.select(F.col(parent_key).alias("_k"))
    return _row(keys.join(known, "_k", "left_anti"), check, table, F.sum("count"))


def one_current_version(dim: DataFrame, key: str = "productid", table: str = "dimproduct") -> DataFrame:
    current = dim.groupBy(key).agg(F.count_if("iscurrent").alias("n"))
    return _row(current.filter("n <> 1"), "one_current_version", table, F.count(F.lit(1)))


def version_order(dim: DataFrame, key: str = "productid") -> DataFrame:
    """Versions numbered newest first with what follows each, for order checks.

    A key has at most one version per calendar day, which bounds each window group.
    """
    newest = Window.partitionBy(key).orderBy(F.desc("validfrom"), F.desc("iscurrent"))
    oldest = Window.partitionBy(key).orderBy(F.asc("validfrom"), F.asc("iscurrent"))
    return dim.select(
        key,
        "validfrom",
        "validto",
        "iscurrent",
        F.row_number().over(newest).alias("version_rank"),
        F.lead("validfrom").over(oldest).alias("next_from"),
    )


def version_checks(dim: DataFrame, key: str = "productid", table: str = "dimproduct") -> DataFrame:
    """Newest not current, older still current, older left open, overlaps and gaps, in one pass."""
    older = F.col("version_rank") > 1
    has_next = F.col("next_from").isNotNull()
    faults = {
        "newest_is_current": (F.col("version_rank") == 1) & ~F.col("iscurrent"),
        "older_is_closed": older & F.col("iscurrent"),
        "older_has_end": older & F.col("validto").isNull(),
        "versions_overlap": has_next & (F.col("validto") >= F.col("next_from")),
        "versions_gap": has_next & (F.date_add(F.col("validto"), 1) < F.col("next_from")),
        "ends_before_start": F.col("validto") < F.col("validfrom"),
    }
    counted = version_order(dim, key).agg(
        *[F.count_if(test).alias(name) for name, test in faults.items()]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        F.lit(table).alias("table_name"),
                        F.col(name).alias("violations"),
                    )
                    for name in faults
                ]
            )
        )
    )


def aggregate_total(monthly: DataFrame, facts: DataFrame, table: str = "factsalesmonthlyaggregate") -> DataFrame:
    """Difference between the deals counted in the aggregate and the facts themselves."""
    deals = monthly.agg(F.coalesce(F.sum("totaldealcount"), F.lit(0))).scalar()
    return facts.agg(F.abs(F.count(F.lit(1)) - deals).alias("violations")).select(
        F.lit("aggregate_total").alias("check_name"), F.lit(table).alias("table_name"), "violations"
    )


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def fact_checks(t: dict[str, DataFrame], max_broadcast: int = BROADCAST_BYTES, rows: dict[str, int] | None = None) -> DataFrame:
    """Missing keys, keys without a dimension row and the total, all counted in one pass over the facts.

    A dimension that may be broadcast is looked up; the keys of a larger one meet it in a shuffle.
    """
    table, out = "factsalesperformance", t["factsalesperformance"]
    parents = {
        "date": ("datekey", "dimdate", "datekey"), "account": ("accountkey", "dimaccount", "accountid"), "product": ("productkey", "dimproduct", "productsk"),
        "agent": ("salesagentkey", "dimsalesagent", "salesagentid"), "stage": ("dealstagekey", "dimdealstage", "stageid"),
    }
    rows = rows or table_rows({name: t[name] for _, name, _ in parents.values()})
    keys = ["opportunityid", *[key for key, _, _ in parents.values()]]
    tests = {"fact_null_key": reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])}
    for label, (key, name, parent) in parents.items():
        known = t[name].select(F.col(parent).alias(f"_{label}")).distinct().withColumn(f"_has_{label}", F.lit(True))
        out = lookup(out, known, key, f"_{label}", rows[name], max_broadcast=max_broadcast)
        tests[f"orphan_{label}"] = F.col(key).isNotNull() & F.col(f"_has_{label}").isNull()
    deals = t["factsalesmonthlyaggregate"].agg(F.coalesce(F.sum("totaldealcount"), F.lit(0))).scalar()
    archived = t["factsarchive"].agg(F.count(F.lit(1))).scalar()
    counted = out.agg(*[F.count_if(test).alias(name) for name, test in tests.items()], F.abs(F.count(F.lit(1)) + archived - deals).alias("aggregate_total"))
    lines = [(name, table) for name in tests] + [("aggregate_total", "factsalesmonthlyaggregate")]
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(of).alias("table_name"), F.col(name).cast("bigint").alias("violations")) for name, of in lines])))


def dimension_checks(t: dict[str, DataFrame]) -> DataFrame:
    """Every check over the dimensions of a loaded warehouse."""
    account, product = t["dimaccount"], t["dimproduct"]
    return all_checks(
        repeated_keys(account, "accountid", "account_key_unique", "dimaccount"),
        repeated_keys(t["dimsalesagent"], "salesagentid", "agent_key_unique", "dimsalesagent"),
        repeated_keys(t["dimdealstage"], "stageid", "stage_key_unique", "dimdealstage"),
        repeated_keys(t["dimdate"], "datekey", "date_key_unique", "dimdate"),
        repeated_keys(product, "productsk", "product_key_unique", "dimproduct"),
        orphans(account, "parentaccountid", account, "accountid", "orphan_parent", "dimaccount"),
        one_current_version(product),
        version_checks(product),
    )


def validate_warehouse(t: dict[str, DataFrame], max_broadcast: int = BROADCAST_BYTES, rows: dict[str, int] | None = None) -> DataFrame:
    """Every check over a loaded warehouse, from table name to table; the facts are read twice."""
    return all_checks(
        repeated_keys(t["factsalesperformance"], "opportunityid", "fact_key_unique", "factsalesperformance"),
        fact_checks(t, max_broadcast, rows),
        dimension_checks(t),
    )


def source_checks(accounts: DataFrame, products: DataFrame, pipeline: DataFrame) -> DataFrame:
    """Quality rules over source tables: one scan of each."""

    def scan(df: DataFrame, table: str, rules: dict) -> DataFrame:
        counted = df.agg(*[F.count_if(test).alias(name) for name, test in rules.items()])
        return counted.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("check_name"),
                            F.lit(table).alias("table_name"),
                            F.col(name).alias("violations"),
                        )
                        for name in rules
                    ]
                )
            )
        )

    return all_checks(
        scan(accounts, "accounts", {
            "account_without_revenue": F.col("revenue").isNull(),
            "negative_revenue": F.col("revenue") < 0,
        }),
        scan(products, "products", {
            "product_without_price": F.col("salesprice").isNull(),
            "negative_price": F.col("salesprice") < 0,
        }),
        scan(pipeline, "salespipeline", {
            "missing_key": F.col("accountid").isNull() | F.col("productid").isNull()
            | F.col("salesagentid").isNull() | F.col("dealstageid").isNull(),
            "missing_event_date": F.coalesce("closedate", "engagedate").isNull(),
            "closed_before_engaged": F.col("closedate") < F.col("engagedate"),
            "missing_value": F.col("closevalue").isNull(),
        }),
    )
