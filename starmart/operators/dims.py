"""Dimension rows from source tables.

The lookup sides (sectors, series, managers, locations) carry no hint: their size is
known to the optimizer from the files, which broadcasts them while they are small.
``extra`` names source columns to carry along, such as ``updated_at``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import PRICE_BANDS, REVENUE_BANDS, band
from starmart.operators.dedup import latest_per_key


def account_rows(accounts: DataFrame, sectors: DataFrame, *extra: str) -> DataFrame:
    return accounts.join(sectors, "sectorid", "left").select(
        "accountid",
        "accountname",
        F.col("sectorname").alias("sector"),
        band(F.col("revenue"), REVENUE_BANDS).alias("revenuerange"),
        "parentaccountid",
        *extra,
    )


def product_rows(products: DataFrame, series: DataFrame, *extra: str) -> DataFrame:
    return products.join(series, "seriesid", "left").select(
        "productid",
        "productname",
        "seriesname",
        F.col("salesprice").alias("price"),
        band(F.col("salesprice"), PRICE_BANDS).alias("pricerange"),
        *extra,
    )


def agent_rows(agents: DataFrame, managers: DataFrame, locations: DataFrame, *extra: str) -> DataFrame:
    return (
        agents.join(managers, "managerid", "left")
        .join(locations, F.col("regionalofficeid") == F.col("locationid"), "left")
        .select("salesagentid", "salesagentname", "managername", F.col("locationname").alias("region"), *extra)
    )


def stage_rows(stages: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per stage, the newest by ``by`` winning."""
    newest = latest_per_key(stages, "dealstageid", by)
    return newest.select(F.col("dealstageid").alias("stageid"), "stagename")
