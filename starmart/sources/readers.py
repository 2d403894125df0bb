"""Source readers.  Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import SOURCE_DDL, schema_of


def read_files(spark: SparkSession, path: str, table: str, file_format: str = "parquet", **options) -> DataFrame:
    """Files of a declared table: parquet, orc, csv or json."""
    return spark.read.format(file_format).options(**options).schema(schema_of(table)).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 1,
    **options,
) -> DataFrame:
    """A database table or query.  ``split_on`` with ``bounds`` reads it in parallel key ranges.

    Bounds only place the split points; rows outside them are read too.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    if split_on is None:
        return (reader.option("dbtable", table) if table else reader.option("query", query)).load()
    source = table if table else f"({query}) q"
    if bounds is None:
        raise ValueError("split_on needs bounds")
    return (
        reader.option("dbtable", source)
        .option("partitionColumn", split_on)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", splits)
        .load()
    )


def read_source(spark: SparkSession, root: str, tables: Sequence[str] = tuple(SOURCE_DDL)) -> Mapping[str, DataFrame]:
    """All source tables below a root directory of parquet files."""
    return {t: read_files(spark, f"{root}/{t}", t) for t in tables}


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of an ordered listing, for people; loads read key ranges instead."""
    return df.orderBy(*order).offset(offset).limit(limit)


def key_range(df: DataFrame, key: str, low: int | None, high: int | None) -> DataFrame:
    """Rows with ``low < key <= high``; the test is pushed to the scan.  An open end is None.

    Rows without a key belong to the range that is open below.
    """
    if low is not None:
        df = df.filter(F.col(key) > low)
    if high is not None:
        upper = F.col(key) <= high
        df = df.filter(upper if low is not None else upper | F.col(key).isNull())
    return df


#: Most keys that text ranges are cut by.
SAMPLED_KEYS = 10_000


def text_edges(df: DataFrame, key: str, ranges: int, sample: int = SAMPLED_KEYS) -> list[tuple[str | None, str | None]]:
    """Split a text key into ``ranges`` consecutive ``(low, high]`` ranges of similar numbers of keys.

    The cuts are quantiles of the ``sample`` keys whose hashes are lowest: a fair sample of the distinct keys, of
    bounded size, and the same in every attempt.  The ends are open, so the ranges cover every key.
    """
    if ranges < 2:
        return [(None, None)]
    picked = df.filter(F.col(key).isNotNull()).select(key).distinct().orderBy(F.xxhash64(key), key).limit(sample)
    keys = sorted((r[0] for r in picked.collect()), key=lambda k: k.encode())  # as Spark compares texts: byte by byte
    inner = list(dict.fromkeys(keys[i * len(keys) // ranges - 1] for i in range(1, ranges) if i * len(keys) // ranges))
    return list(zip([None, *inner], [*inner, None]))


def range_edges(df: DataFrame, key: str, ranges: int) -> list[tuple[int | None, int | None]]:
    """Split a numeric key into ``ranges`` consecutive ``(low, high]`` ranges of similar row counts.

    The ends are open, so the ranges cover every key whatever the quantile error.
    """
    if ranges < 2:
        return [(None, None)]
    cuts = df.approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.001)
    inner = sorted({int(c) for c in cuts})
    return list(zip([None, *inner], [*inner, None]))
