"""Column types of every source and warehouse table.

Instants are TIMESTAMP_NTZ holding UTC wall-clock time, so no result depends on
the session time zone.  Names are lower case throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SOURCE_DDL = {
    "accounts": "accountid BIGINT, accountname STRING, sectorid BIGINT, yearestablished INT, "
    "revenue DECIMAL(18,2), employees INT, headquartersid BIGINT, parentaccountid BIGINT, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    "sectors": "sectorid BIGINT, sectorname STRING",
    "products": "productid BIGINT, productname STRING, seriesid BIGINT, salesprice DECIMAL(18,2), "
    "updated_at TIMESTAMP_NTZ",
    "productseries": "seriesid BIGINT, seriesname STRING",
    "salesagents": "salesagentid BIGINT, salesagentname STRING, managerid BIGINT, "
    "regionalofficeid BIGINT, updated_at TIMESTAMP_NTZ",
    "salesmanagers": "managerid BIGINT, managername STRING",
    "locations": "locationid BIGINT, locationname STRING",
    "dealstages": "dealstageid BIGINT, stagename STRING",
    "salespipeline": "opportunityid STRING, salesagentid BIGINT, productid BIGINT, accountid BIGINT, "
    "dealstageid BIGINT, engagedate DATE, closedate DATE, closevalue DECIMAL(18,2), "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
}

WAREHOUSE_DDL = {
    "dimdate": "datekey INT, date DATE, day INT, month INT, quarter INT, year INT",
    "dimaccount": "accountid BIGINT, accountname STRING, sector STRING, revenuerange STRING, "
    "parentaccountid BIGINT",
    "dimproduct": "productsk BIGINT, productid BIGINT, productname STRING, seriesname STRING, "
    "price DECIMAL(18,2), pricerange STRING, validfrom DATE, validto DATE, iscurrent BOOLEAN",
    "dimsalesagent": "salesagentid BIGINT, salesagentname STRING, managername STRING, region STRING",
    "dimdealstage": "stageid BIGINT, stagename STRING",
    "factsalesperformance": "opportunityid STRING, datekey INT, accountkey BIGINT, productkey BIGINT, "
    "salesagentkey BIGINT, dealstagekey BIGINT, closevalue DECIMAL(18,2), durationdays INT, "
    "expectedsuccessrate DOUBLE, updated_at TIMESTAMP_NTZ",
    "factsarchive": "opportunityid STRING, datekey INT, accountkey BIGINT, productkey BIGINT, "
    "salesagentkey BIGINT, dealstagekey BIGINT, closevalue DECIMAL(18,2), durationdays INT, "
    "expectedsuccessrate DOUBLE, updated_at TIMESTAMP_NTZ",
    "factsalesmonthlyaggregate": "year INT, month INT, region STRING, dealstagekey BIGINT, "
    "totaldealcount BIGINT, totalclosevalue DOUBLE, avgdealvalue DOUBLE, avgdurationdays DOUBLE, "
    "expectedsuccessrate DOUBLE",
    "factrejects": "opportunityid STRING, salesagentid BIGINT, productid BIGINT, accountid BIGINT, "
    "dealstageid BIGINT, closevalue DECIMAL(18,2), durationdays INT, expectedsuccessrate DOUBLE, "
    "eventdate DATE, updated_at TIMESTAMP_NTZ, missing_date BOOLEAN, missing_account BOOLEAN, "
    "missing_product BOOLEAN, missing_agent BOOLEAN, missing_stage BOOLEAN",
}

#: Columns of a stored fact; ``updated_at``, the instant of its source row, is kept so that only newer rows replace it.
STORED_FACT = [c.split()[0] for c in WAREHOUSE_DDL["factsalesperformance"].split(", ")]
FACT_COLUMNS = [c for c in STORED_FACT if c != "updated_at"]


def schema_of(table: str) -> StructType:
    """Declared schema of a source or warehouse table."""
    ddl = SOURCE_DDL.get(table) or WAREHOUSE_DDL[table]
    return StructType.fromDDL(ddl)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """A typed DataFrame with no rows: the 'create table' and 'truncate' content."""
    return spark.createDataFrame([], schema_of(table))

