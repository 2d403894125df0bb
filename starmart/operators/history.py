"""Version history listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import row_json


def version_json(dim: DataFrame) -> DataFrame:
    """Each product version as a JSON object with its rank, newest first within the product."""
    newest = Window.partitionBy("productid").orderBy(F.desc("validfrom"), F.desc("iscurrent"))
    columns = ("productid", "productname", "price", "validfrom", "validto", "iscurrent")
    return dim.select(
        "productid",
        F.row_number().over(newest).alias("version_rank"),
        row_json(columns, text_columns=("price", "validfrom", "validto")).alias("version_json"),
    )
