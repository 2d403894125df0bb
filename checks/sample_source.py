"""The CRM source tables, derived from the given order tables (see FIXTURES.md)."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.dates import date_bounds, date_dimension
from starmart.operators.dims import account_rows, agent_rows, product_rows
from starmart.operators.dedup import first_per_key
from starmart.operators.facts import first_order, shape_pipeline
from starmart.operators.lookup import table_rows
from starmart.operators.resolve import Dimensions, Resolved, fact_columns, packed, resolve_keys, unpacked
from starmart.operators.scd import scd2_initialize
from starmart.session import shared_dir
from starmart.sources.warehouse import COMPRESSION

# The stages of the sample source.
STAGES = {1: "Prospecting", 2: "Engaging", 3: "Lost", 4: "Won", 5: "On Hold"}
# Columns of the given tables.
RAW_DDL = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
# Day an incremental run is simulated on.
RUN_DATE = "1998-12-22"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one."""
    return f"{shared_dir(spark)}/starmart-{uuid.uuid4().hex}"


def stage_of_line() -> Column:
    """Deal stage of an order line; 9 is a stage the stage table does not have."""
    flag = F.col("l_returnflag")
    return (
        F.when(F.col("l_quantity") == 50, 9)
        .when((F.col("l_linestatus") == "F") & (flag == "A"), 4)
        .when((F.col("l_linestatus") == "F") & (flag == "R"), 3)
        .when(flag == "A", 1)
        .when(flag == "R", 2)
        .otherwise(5)
        .cast("bigint")
    )


def pipeline_from(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales pipeline rows from order lines and their orders."""
    part, open_line = F.col("l_partkey"), F.col("open")
    # What the lines alone decide is decided before the join, which then shuffles numbers only.
    is_open = F.col("l_linestatus") == "O"
    value = F.when(is_open & (F.col("l_quantity") < 10), None).otherwise(F.col("l_extendedprice").cast("decimal(18,2)"))
    deals = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", is_open.alias("open"), stage_of_line().alias("dealstageid"), value.alias("closevalue"))
    return deals.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("opportunityid"),
        F.when(part % 101 == 5, None).otherwise(F.col("l_suppkey")).alias("salesagentid"),
        F.when(part % 103 == 5, part + 1_000_000).otherwise(part).alias("productid"),
        F.col("o_custkey").alias("accountid"),
        "dealstageid",
        F.when(open_line & (F.col("l_linenumber") == 7), None)
        .otherwise(F.least("o_orderdate", "l_shipdate").cast("date"))
        .alias("engagedate"),
        F.when(open_line, None)
        .otherwise(F.greatest("o_orderdate", "l_shipdate").cast("date"))
        .alias("closedate"),
        "closevalue",
        F.col("l_shipdate").alias("updated_at"),
    )


class Sample:
    """Lazy source tables, dimensions and facts over one directory of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(RAW_DDL[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    def _changed_at(self, key: str):
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col(key) % 30).cast("int"))
        return day.cast("timestamp_ntz").alias("updated_at")

    @cached_property
    def sectors(self) -> DataFrame:
        nation = self.raw("nation").filter("n_nationkey < 20")
        return nation.select(F.col("n_nationkey").cast("bigint").alias("sectorid"), F.col("n_name").alias("sectorname"))

    @cached_property
    def accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        revenue = ((F.col("c_acctbal").cast("decimal(12,2)") + 1000) * 1200).cast("decimal(18,2)")
        return self.raw("customer").select(
            key.alias("accountid"),
            F.col("c_name").alias("accountname"),
            F.col("c_nationkey").cast("bigint").alias("sectorid"),
            F.when(key % 11 != 0, revenue).alias("revenue"),
            F.when(key % 7 != 0, key - key % 7).alias("parentaccountid"),
            self._changed_at("c_custkey"),
        )

    @cached_property
    def productseries(self) -> DataFrame:
        size = F.col("p_size")
        return (
            self.raw("part").filter(size <= 45).select("p_size").distinct()
            .select(size.cast("bigint").alias("seriesid"), F.concat(F.lit("Series "), size).alias("seriesname"))
        )

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        price = (F.col("p_retailprice").cast("decimal(10,2)") * F.col("p_size") * F.expr("0.04")).cast("decimal(18,2)")
        return self.raw("part").select(
            key.alias("productid"),
            F.col("p_name").alias("productname"),
            F.col("p_size").cast("bigint").alias("seriesid"),
            F.when(key % 17 != 0, price).alias("salesprice"),
            self._changed_at("p_partkey"),
        )

    @cached_property
    def salesmanagers(self) -> DataFrame:
        nation = self.raw("nation").filter("n_nationkey <> 3")
        return nation.select(F.col("n_nationkey").cast("bigint").alias("managerid"), F.col("n_name").alias("managername"))

    @cached_property
    def locations(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("bigint").alias("locationid"), F.col("r_name").alias("locationname")
        )

    @cached_property
    def salesagents(self) -> DataFrame:
        nation = F.col("s_nationkey").cast("bigint")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("salesagentid"),
            F.col("s_name").alias("salesagentname"),
            nation.alias("managerid"),
            (nation % 6).alias("regionalofficeid"),
            self._changed_at("s_suppkey"),
        )

    @cached_property
    def dealstages(self) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(k).cast("bigint").alias("dealstageid"), F.lit(v).alias("stagename"))
                         for k, v in STAGES.items()])
        return self.spark.range(1).select(F.inline(rows))

    @cached_property
    def stage_feed(self) -> DataFrame:
        """Stage names as seen on every order line, upper case before 1998."""
        names = F.create_map(*[F.lit(x) for k, v in STAGES.items() for x in (k, v)])
        seen = self.raw("lineitem").select(
            stage_of_line().alias("dealstageid"),
            F.try_element_at(names, stage_of_line().cast("int")).alias("stagename"),
            F.col("l_shipdate").alias("updated_at"),
        )
        old = F.col("updated_at") < F.lit("1998-01-01").cast("timestamp_ntz")
        return seen.filter(F.col("stagename").isNotNull()).withColumn(
            "stagename", F.when(old, F.upper("stagename")).otherwise(F.col("stagename"))
        )

    @cached_property
    def salespipeline(self) -> DataFrame:
        lines = self.raw("lineitem")
        return pipeline_from(lines, self.raw("orders"))

    @cached_property
    def storedpipeline(self) -> DataFrame:
        """The pipeline as a table of its own, for loads: they read it several times, and each time would be a join."""
        return self._written(self.salespipeline, "pipeline")

    def stored(self) -> Sample:
        """The same tables with the pipeline, its resolved rows and the facts written once, for queries that read them several times."""
        out = Sample(self.spark, self.sf_dir)
        out.salespipeline = self.storedpipeline
        # What the keys and measures were made from is not written again.
        flagged = out.resolved.flagged.drop("engagedate", "closedate", "eventdate")
        out.resolved = Resolved(unpacked(self._written(packed(flagged), "resolved"), flagged))
        out.facts = self._written(out.facts, "facts")
        return out

    def _written(self, df: DataFrame, what: str) -> DataFrame:
        path = f"{shared_folder(self.spark)}-{what}"
        df.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)

    def tables(self) -> dict[str, DataFrame]:
        """``source`` with the stored pipeline."""
        return {**self.source(), "salespipeline": self.storedpipeline}

    def source(self) -> dict[str, DataFrame]:
        names = ("accounts", "sectors", "products", "productseries", "salesagents", "salesmanagers",
                 "locations", "dealstages", "salespipeline")
        return {n: getattr(self, n) for n in names}

    # Dimensions and facts of a full load.
    @cached_property
    def dimdate(self) -> DataFrame:
        return date_dimension(date_bounds(self.salespipeline))

    @cached_property
    def dimaccount(self) -> DataFrame:
        return account_rows(self.accounts, self.sectors)

    @cached_property
    def dimproduct(self) -> DataFrame:
        return scd2_initialize(product_rows(self.products, self.productseries))

    @cached_property
    def dimsalesagent(self) -> DataFrame:
        return agent_rows(self.salesagents, self.salesmanagers, self.locations)

    @cached_property
    def dimdealstage(self) -> DataFrame:
        return self.dealstages.select(F.col("dealstageid").alias("stageid"), "stagename")

    @cached_property
    def rows(self) -> dict[str, int]:
        """Sizes of the dimensions, from the tables they have one row for: file metadata only."""
        return {
            **table_rows({"account": self.accounts, "product": self.products, "agent": self.salesagents}),
            "stage": len(STAGES),
        }

    def dimensions(self, product: DataFrame | None = None) -> Dimensions:
        product = self.dimproduct if product is None else product
        return Dimensions(self.dimdate, self.dimaccount, product, self.dimsalesagent, self.dimdealstage, self.rows)

    @cached_property
    def factsource(self) -> DataFrame:
        return shape_pipeline(self.salespipeline, self.dealstages, len(STAGES))

    @cached_property
    def resolved(self) -> Resolved:
        return resolve_keys(self.factsource, self.dimensions())

    @cached_property
    def facts(self) -> DataFrame:
        first = first_per_key(self.resolved.facts, "opportunityid", first_order())
        return fact_columns(first)

    # Inputs of incremental runs.
    @cached_property
    def productchanges(self) -> DataFrame:
        key, columns = F.col("productid"), ("productname", "seriesname", "price", "pricerange")
        edited = self.dimproduct.filter((key % 10).isin(0, 1)).withColumn(
            "productname",
            F.when(key % 10 == 0, F.concat("productname", F.lit(" (v2)"))).otherwise(F.col("productname")),
        )
        added = self.dimproduct.filter(key % 100 == 2).withColumn("productid", key + 5_000_000)
        return edited.select("productid", *columns).unionByName(added.select("productid", *columns))

    @cached_property
    def accountchanges(self) -> DataFrame:
        key = F.col("accountid")
        edited = self.dimaccount.filter(key % 9 == 0).withColumns(
            {"accountname": F.concat("accountname", F.lit(" (renamed)")), "sector": F.lit(None).cast("string")}
        )
        added = self.dimaccount.filter(key % 50 == 3).withColumn("accountid", key + 900_000)
        return edited.unionByName(added)

    @cached_property
    def changelog(self) -> DataFrame:
        kind = F.col("event_type")
        return self.raw("events").select(
            F.col("user_id").alias("accountid"),
            F.col("event_id").alias("seq"),
            F.col("ts").alias("changed_at"),
            F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U").alias("op"),
            F.col("value").cast("decimal(18,2)").alias("balance"),
        )
