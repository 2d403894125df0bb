"""One registered query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sample_source import RUN_DATE, Sample, pipeline_from, shared_folder
from starmart.functions import change_window, parse_date, parse_instant, scale_price, suffix_once
from starmart.operators import quality
from starmart.operators.aggregates import SALES_MEASURES, Join, calendar, monthly_sales, star_aggregate
from starmart.operators.changes import apply_changes, delete_by_key, last_processed, update_by_key
from starmart.operators.dates import date_bounds, date_dimension
from starmart.operators.dedup import first_per_key, latest_per_key
from starmart.operators.dims import account_rows, product_rows, stage_rows
from starmart.operators.facts import archive_split, fact_load, first_order, probe_facts
from starmart.operators.history import version_json
from starmart.operators.lookup import table_rows
from starmart.operators.resolve import (
    KEY_FLAGS,
    Dimensions,
    as_of_join,
    as_of_merge,
    fact_columns,
    replay_rejects,
    resolve_keys,
)
from starmart.operators.scd import insert_if_absent, scd1_upsert, scd2_apply, scd2_changes, scd2_initialize
from starmart.plans import (
    LoadOptions,
    apply_dimension_changes,
    apply_pipeline_changes,
    archive_facts,
    compact,
    fold_changes,
    incremental_load,
    initial_load,
    refresh_monthly,
)
from starmart.sources.readers import key_range, page, range_edges
from starmart.sources.warehouse import COMPRESSION, Warehouse
from starmart.streaming.incremental import Dedup, file_stream, stream_changes, stream_incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

SNAPSHOT_DIMS, SNAPSHOT_FACTS = "2024-01-15T00:00:00", "1999-01-01T00:00:00"


def query(fn: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    REGISTERED[fn.__name__] = lambda spark, sf_dir: fn(Sample(spark, sf_dir))
    return fn


# --- dimensions -----------------------------------------------------------------
@query
def dim_account(s: Sample) -> DataFrame:
    return s.dimaccount


@query
def dim_product_initial(s: Sample) -> DataFrame:
    return s.dimproduct


@query
def dim_sales_agent(s: Sample) -> DataFrame:
    return s.dimsalesagent


@query
def dim_deal_stage(s: Sample) -> DataFrame:
    """Newest name of each stage over every line; five keys hold all rows."""
    return stage_rows(s.stage_feed, ("updated_at",))


@query
def dim_date(s: Sample) -> DataFrame:
    return s.dimdate


# --- facts ----------------------------------------------------------------------
@query
def fact_source(s: Sample) -> DataFrame:
    return s.factsource


@query
def fact_resolved(s: Sample) -> DataFrame:
    return fact_columns(s.resolved.facts)


@query
def fact_rejects(s: Sample) -> DataFrame:
    return s.resolved.rejects.select("opportunityid", "productid", "dealstageid", *KEY_FLAGS.values())


@query
def fact_initial(s: Sample) -> DataFrame:
    return s.facts


@query
def monthly_aggregate(s: Sample) -> DataFrame:
    return monthly_sales(s.facts, s.dimdate, s.dimsalesagent, s.rows["agent"])


@query
def aggregate_by_quarter(s: Sample) -> DataFrame:
    group = {c: F.col(c) for c in ("year", "quarter", "dealstagekey")}
    return star_aggregate(s.facts, [calendar(s.dimdate, "year", "quarter")], group, SALES_MEASURES)


@query
def aggregate_by_product(s: Sample) -> DataFrame:
    joins = [
        Join(s.dimproduct, "productkey", "productsk", ("seriesname", "pricerange"), s.rows["product"]),
        calendar(s.dimdate, "year"),
    ]
    group = {c: F.col(c) for c in ("seriesname", "pricerange", "year")}
    return star_aggregate(s.facts, joins, group, SALES_MEASURES)


@query
def aggregate_by_account(s: Sample) -> DataFrame:
    joins = [Join(s.dimaccount, "accountkey", "accountid", ("sector", "revenuerange"), s.rows["account"])]
    group = {c: F.col(c) for c in ("sector", "revenuerange")}
    return star_aggregate(s.facts, joins, group, SALES_MEASURES)


@query
def load_counters(s: Sample) -> DataFrame:
    """Read, shaped, resolved and skipped rows of one load."""
    found = F.lit(True)
    for key in KEY_FLAGS:
        found = found & F.col(key).isNotNull()
    counted = s.resolved.flagged.agg(
        F.count(F.lit(1)).alias("rows_shaped"),
        F.count_if(found).alias("rows_resolved"),
        F.count_if(~found).alias("rows_skipped"),
    )
    rows_read = s.salespipeline.agg(F.count(F.lit(1))).scalar()
    return counted.select(rows_read.alias("rows_read"), "rows_shaped", "rows_resolved", "rows_skipped")


@query
def fact_probe(s: Sample) -> DataFrame:
    return probe_facts(s.facts, s.dimproduct, 3, dealstagekey=4)


@query
def archive_split_query(s: Sample) -> DataFrame:
    kept, archived = archive_split(s.facts, 19980101)
    columns = ["opportunityid", "datekey"]
    return kept.select(*columns, F.lit("kept").alias("part")).unionByName(
        archived.select(*columns, F.lit("archived").alias("part"))
    )


REGISTERED["archive_split"] = REGISTERED.pop("archive_split_query")


# --- versions and points in time --------------------------------------------------
def _changes(s: Sample) -> DataFrame:
    return scd2_changes(s.dimproduct, s.productchanges)


def _versions(s: Sample) -> DataFrame:
    return scd2_apply(s.dimproduct, _changes(s), RUN_DATE, first_version_from=RUN_DATE)


def _version_rows(s: Sample) -> int:
    """A run adds at most one version for each change."""
    return s.rows["product"] + table_rows({"changes": s.productchanges})["changes"]


@query
def scd2_changes_query(s: Sample) -> DataFrame:
    return _changes(s).drop("current_from")


REGISTERED["scd2_changes"] = REGISTERED.pop("scd2_changes_query")


@query
def scd2_apply_query(s: Sample) -> DataFrame:
    return _versions(s)


REGISTERED["scd2_apply"] = REGISTERED.pop("scd2_apply_query")


def _as_of(s: Sample, bounds: str) -> DataFrame:
    facts = s.factsource.select("opportunityid", "productid", "eventdate")
    return as_of_join(facts, _versions(s), _version_rows(s), bounds, how="inner")


@query
def asof_half_open(s: Sample) -> DataFrame:
    return _as_of(s, "half_open")


@query
def asof_closed(s: Sample) -> DataFrame:
    return _as_of(s, "closed")


def _as_of_merge(s: Sample, bounds: str) -> DataFrame:
    facts = s.factsource.select("opportunityid", "productid", "eventdate")
    return as_of_merge(facts, _versions(s), bounds, how="inner")


@query
def asof_merge_half_open(s: Sample) -> DataFrame:
    """Points in time by one ordered pass over facts and versions."""
    return _as_of_merge(s, "half_open")


@query
def asof_merge_closed(s: Sample) -> DataFrame:
    return _as_of_merge(s, "closed")


@query
def asof_many_versions(s: Sample) -> DataFrame:
    """Orders as versions of their day's priority: keys with thousands of versions, met by the deals' event dates."""
    day = F.col("o_orderdate").cast("date")
    firsts = s.raw("orders").groupBy((F.col("o_custkey") % 5).alias("productid"), day.alias("validfrom")).agg(F.min("o_orderkey").alias("productsk"))
    versions = firsts.select("productsk", "productid", "validfrom", F.when(F.col("productsk") % 3 == 0, F.date_add("validfrom", 4)).alias("validto"))
    facts = s.factsource.select("opportunityid", (F.col("productid") % 7).alias("productid"), "eventdate")
    return as_of_merge(facts, versions, "closed")


@query
def fact_resolved_as_of(s: Sample) -> DataFrame:
    """Incremental resolution with half-open bounds and the natural product key."""
    dims = s.dimensions(_versions(s))
    rows = {**s.rows, "product": _version_rows(s)}
    dims = Dimensions(dims.date, dims.account, dims.product, dims.agent, dims.stage, rows)
    return fact_columns(resolve_keys(s.factsource, dims, "as_of", "half_open", "natural").facts)


@query
def product_history_json(s: Sample) -> DataFrame:
    return version_json(_versions(s))


@query
def replay_rejects_query(s: Sample) -> DataFrame:
    """Facts rejected for want of late products, resolved once the products are there."""
    on_time = s.products.filter(F.col("updated_at") <= F.lit(SNAPSHOT_DIMS).cast("timestamp_ntz"))
    early = scd2_initialize(product_rows(on_time, s.productseries))
    rejects = resolve_keys(s.factsource, s.dimensions(early)).rejects
    return fact_columns(replay_rejects(rejects, s.dimensions()).facts)


REGISTERED["replay_rejects"] = REGISTERED.pop("replay_rejects_query")


# --- upserts and change logs -------------------------------------------------------
@query
def change_window_query(s: Sample) -> DataFrame:
    return s.salespipeline.filter(change_window(F.col("updated_at"), "1999-01-01T00:00:00", "2000-01-01T00:00:00"))


REGISTERED["change_window"] = REGISTERED.pop("change_window_query")


@query
def scd1_upsert_account(s: Sample) -> DataFrame:
    return scd1_upsert(s.dimaccount, s.accountchanges, "accountid")


@query
def insert_if_absent_account(s: Sample) -> DataFrame:
    return insert_if_absent(s.dimaccount, s.accountchanges, "accountid", [F.col("accountname")])


def _fact_mode(s: Sample, mode: str) -> DataFrame:
    seen = F.col("updated_at")
    rows = s.resolved.facts
    earlier = first_per_key(
        rows.filter(seen <= F.lit("1999-01-01").cast("timestamp_ntz")), "opportunityid", first_order()
    )
    batch = rows.filter(~(seen <= F.lit("1999-01-01").cast("timestamp_ntz")) | seen.isNull())
    return fact_load(earlier, batch, mode)


@query
def fact_insert_only(s: Sample) -> DataFrame:
    return _fact_mode(s, "insert_only")


@query
def fact_insert_if_absent(s: Sample) -> DataFrame:
    return _fact_mode(s, "insert_if_absent")


@query
def fact_upsert(s: Sample) -> DataFrame:
    return _fact_mode(s, "upsert")


def _balances(s: Sample) -> DataFrame:
    return s.raw("customer").select(
        F.col("c_custkey").alias("accountid"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance")
    )


@query
def apply_changes_query(s: Sample) -> DataFrame:
    return apply_changes(_balances(s), s.changelog, "accountid", ["changed_at", "seq"])


REGISTERED["apply_changes"] = REGISTERED.pop("apply_changes_query")


@query
def update_by_key_query(s: Sample) -> DataFrame:
    newest = latest_per_key(s.changelog, "accountid", ["changed_at", "seq"]).select("accountid", "balance")
    return update_by_key(_balances(s), newest, "accountid")


REGISTERED["update_by_key"] = REGISTERED.pop("update_by_key_query")


@query
def delete_by_key_query(s: Sample) -> DataFrame:
    return delete_by_key(_balances(s), s.changelog.filter("op = 'D'"), "accountid")


REGISTERED["delete_by_key"] = REGISTERED.pop("delete_by_key_query")


@query
def last_processed_query(s: Sample) -> DataFrame:
    return last_processed(s.changelog, "changed_at", "seq")


REGISTERED["last_processed"] = REGISTERED.pop("last_processed_query")


# --- scalar functions, paging ------------------------------------------------------
@query
def text_suffix(s: Sample) -> DataFrame:
    suffix, name = " (Updated Scenario 2)", F.col("productname")
    edited = F.when(F.col("productid") % 3 == 0, F.concat(name, F.lit(suffix))).otherwise(name)
    return s.products.select(
        "productid",
        suffix_once(edited, suffix).alias("productname"),
        scale_price(F.col("salesprice"), "1.1").alias("salesprice"),
        F.concat(F.lit("TEST_S1_"), F.right(name, F.lit(8))).alias("opportunityid"),
    )


@query
def high_water_marks(s: Sample) -> DataFrame:
    """Marks kept as text, with and without offset or unreadable, read back."""
    kind = F.col("event_type")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(kind == "error", F.lit("not a time"))
        .when(kind == "click", F.concat(text, F.lit("+02:00")))
        .when(kind == "view", F.concat(text, F.lit("Z")))
        .otherwise(text)
    )
    return s.raw("events").groupBy("user_id").agg(F.max(parse_instant(text)).alias("mark"))


@query
def parse_event_date(s: Sample) -> DataFrame:
    """Dates that come as text; what cannot be read is flagged, not fatal."""
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "P", F.lit("n/a"))
        .when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    day = parse_date(text)
    return s.raw("orders").select("o_orderkey", day.alias("eventdate"), day.isNull().alias("missing_date"))


@query
def page_query(s: Sample) -> DataFrame:
    return page(s.dimaccount, [F.col("accountid")], limit=100, offset=200)


REGISTERED["page"] = REGISTERED.pop("page_query")


@query
def key_ranges(s: Sample) -> DataFrame:
    """The account table read in four key ranges, which together are the table."""
    whole = s.accounts
    parts = [key_range(whole, "accountid", low, high) for low, high in range_edges(whole, "accountid", 4)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- validation ----------------------------------------------------------------------
@query
def validate(s: Sample) -> DataFrame:
    s = s.stored()
    monthly = monthly_sales(s.facts, s.dimdate, s.dimsalesagent, s.rows["agent"])
    account = s.dimaccount
    return quality.all_checks(
        quality.one_current_version(_versions(s)),
        quality.repeated_keys(s.resolved.facts, "opportunityid", "fact_key_unique", "factresolved"),
        quality.orphans(account, "parentaccountid", account, "accountid", "orphan_parent", "dimaccount"),
        quality.orphans(s.salespipeline, "productid", s.products, "productid", "orphan_product", "salespipeline"),
        quality.null_keys(s.salespipeline, ["salesagentid", "productid"], "null_key", "salespipeline"),
        quality.aggregate_total(monthly, s.facts),
    )


@query
def version_checks(s: Sample) -> DataFrame:
    """Orders read as versions of their customer, which break every rule somewhere."""
    day, current = F.col("o_orderdate").cast("date"), F.col("o_orderstatus") == "O"
    versions = s.raw("orders").select(
        F.col("o_custkey").alias("productid"),
        day.alias("validfrom"),
        F.when(~current, F.date_add(day, 30)).alias("validto"),
        current.alias("iscurrent"),
    )
    return quality.version_checks(versions, table="orders")


@query
def source_checks(s: Sample) -> DataFrame:
    return quality.source_checks(s.accounts, s.products, s.salespipeline)


# --- whole loads -----------------------------------------------------------------------
def _full(s: Sample) -> Warehouse:
    wh = Warehouse(s.spark, shared_folder(s.spark))
    initial_load(s.tables(), wh, "2024-02-01T00:00:00")
    return wh


@query
def initial_load_query(s: Sample) -> DataFrame:
    """Facts as loaded, with their partition columns."""
    return _full(s).table("factsalesperformance").drop("updated_at")


REGISTERED["initial_load"] = REGISTERED.pop("initial_load_query")


@query
def load_metadata(s: Sample) -> DataFrame:
    """What the log says of each table of a full load: rows read, written and rejected, and rows that cannot be facts."""
    log = _full(s).log()
    return log.filter("action = 'replace'").select("table_name", "rows_read", "rows_written", "rows_rejected", "message")


@query
def refresh_monthly_query(s: Sample) -> DataFrame:
    wh = _full(s)
    refresh_monthly(wh, "2024-02-02T00:00:00")
    return wh.table("factsalesmonthlyaggregate")


REGISTERED["refresh_monthly"] = REGISTERED.pop("refresh_monthly_query")


def _two_runs(s: Sample, run_ts: str = "2024-02-01T00:00:00") -> Warehouse:
    """A full load of an early snapshot, then an incremental load of everything since.

    By the second run every tenth product has been renamed, and accounts, products and
    pipeline rows have been added.
    """
    wh = Warehouse(s.spark, shared_folder(s.spark))
    now = s.tables()
    early = dict(now)
    for table, until in (
        ("accounts", SNAPSHOT_DIMS), ("products", SNAPSHOT_DIMS), ("salespipeline", SNAPSHOT_FACTS)
    ):
        early[table] = now[table].filter(F.col("updated_at") <= F.lit(until).cast("timestamp_ntz"))
    initial_load(early, wh, SNAPSHOT_DIMS)
    name = F.col("productname")
    renamed = F.when(F.col("productid") % 10 == 0, F.concat(name, F.lit(" (v2)"))).otherwise(name)
    now["products"] = now["products"].withColumn("productname", renamed)
    incremental_load(now, wh, run_ts)
    return wh


@query
def incremental_load_query(s: Sample) -> DataFrame:
    return fact_columns(_two_runs(s).table("factsalesperformance"))


REGISTERED["incremental_load"] = REGISTERED.pop("incremental_load_query")


@query
def offset_run_ts(s: Sample) -> DataFrame:
    """The same run with its instant given in another zone."""
    return fact_columns(_two_runs(s, "2024-02-01T02:00:00+02:00").table("factsalesperformance"))


@query
def compacted_facts(s: Sample) -> DataFrame:
    """Facts of two loads, written as one directory."""
    wh = _two_runs(s)
    compact(wh, "factsalesperformance", "2024-02-03T00:00:00")
    return fact_columns(wh.table("factsalesperformance"))


@query
def load_checks(s: Sample) -> DataFrame:
    """What the validation after a full load noted."""
    return _full(s).checks().select("check_name", "table_name", "violations")


@query
def dim_date_default(s: Sample) -> DataFrame:
    """The calendar of a pipeline without any date, with the events of each of its days."""
    days = date_dimension(date_bounds(s.salespipeline.filter("engagedate is null and closedate is null")))
    seen = s.raw("events").groupBy(F.col("ts").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("events"))
    return days.join(seen, "date", "left").withColumn("events", F.coalesce("events", F.lit(0)))


@query
def changelog_dimensions(s: Sample) -> DataFrame:
    """Agents after a change log over all of them: every fifth is deleted, the others are renamed."""
    wh = Warehouse(s.spark, shared_folder(s.spark))
    entry = wh.write("dimsalesagent", s.dimsalesagent, "agents")
    wh.commit("agents", "2024-02-01T00:00:00", [entry], {})
    key = F.col("salesagentid")
    log = s.salesagents.withColumn("op", F.when(key % 5 == 0, "D").when(key % 5 == 1, None).otherwise("U"))
    log = log.withColumn("salesagentname", F.concat("salesagentname", F.lit(" (log)")))
    apply_dimension_changes(s.source(), wh, "salesagents", log, ["updated_at"], "2024-02-02T00:00:00")
    return wh.table("dimsalesagent")


@query
def incremental_products(s: Sample) -> DataFrame:
    return _two_runs(s).table("dimproduct")


@query
def monthly_touched(s: Sample) -> DataFrame:
    """The aggregate after recomputing only the months the second run touched."""
    return _two_runs(s).table("factsalesmonthlyaggregate")


@query
def monthly_moved(s: Sample) -> DataFrame:
    """The aggregate after a third run that brings no deal: every third agent moves to a renamed office, whose lines move along."""
    wh = _two_runs(s)
    now = s.tables()
    moved = F.col("salesagentid") % 3 == 0
    renamed = now["locations"].select((F.col("locationid") + 1_000_000).alias("locationid"), F.concat("locationname", F.lit(" (moved)")).alias("locationname"))
    now["locations"] = now["locations"].unionByName(renamed)
    now["salesagents"] = now["salesagents"].withColumns({
        "regionalofficeid": F.when(moved, F.col("regionalofficeid") + 1_000_000).otherwise(F.col("regionalofficeid")),
        "updated_at": F.when(moved, F.lit("2024-02-02T00:00:00").cast("timestamp_ntz")).otherwise(F.col("updated_at")),
    })
    incremental_load(now, wh, "2024-02-03T00:00:00")
    return wh.table("factsalesmonthlyaggregate")


@query
def incremental_checks(s: Sample) -> DataFrame:
    """What the validation after the second of two runs noted: facts by the summaries that both runs kept."""
    found = _two_runs(s).checks()
    return found.filter("run_ts = '2024-02-01T00:00:00'").select("check_name", "table_name", "violations")


def _pipeline_log(s: Sample) -> DataFrame:
    """Every pipeline row as a change: lost deals are deleted, all others won."""
    changes = s.storedpipeline.withColumn("op", F.when(F.col("dealstageid") == 3, "D").otherwise("U"))
    return changes.withColumn("dealstageid", F.lit(4).cast("bigint"))


LOG_ORDER = ["updated_at", "productid", "salesagentid", "accountid", "closevalue", "engagedate", "closedate", "op"]


@query
def changelog_load(s: Sample) -> DataFrame:
    """A loaded warehouse after every pipeline row came again as a change."""
    wh = _full(s)
    apply_pipeline_changes(s.source(), wh, _pipeline_log(s), LOG_ORDER, "2024-02-02T00:00:00")
    return fact_columns(wh.table("factsalesperformance"))


@query
def changelog_rejects(s: Sample) -> DataFrame:
    """The same log's rejects: newest changes without a key or date, or with one that is not there."""
    wh = _full(s)
    apply_pipeline_changes(s.source(), wh, _pipeline_log(s), LOG_ORDER, "2024-02-02T00:00:00")
    return wh.table("factrejects").select("opportunityid", "productid", "dealstageid", *KEY_FLAGS.values())


@query
def changelog_ties(s: Sample) -> DataFrame:
    """The same changes in two runs: the first ends inside an instant, the second brings everything again."""
    wh = _full(s)
    changes = _pipeline_log(s)
    middle = changes.filter("updated_at < timestamp_ntz'1996-01-01'").agg(F.max("updated_at")).first()[0]
    part = changes.filter((F.col("updated_at") < F.lit(middle)) | (F.col("updated_at") == F.lit(middle)) & (F.crc32("opportunityid") % 2 == 0))
    apply_pipeline_changes(s.source(), wh, part, LOG_ORDER, "2024-02-02T00:00:00", at="updated_at")
    apply_pipeline_changes(s.source(), wh, changes, LOG_ORDER, "2024-02-03T00:00:00", at="updated_at")
    return fact_columns(wh.table("factsalesperformance"))


@query
def changelog_cuts(s: Sample) -> DataFrame:
    """The same changes in three runs: the newest first, then a half of the rest by a hash, then the other; the state is folded between."""
    wh = _full(s)
    changes = _pipeline_log(s)
    late, even = F.col("updated_at") >= F.lit("1999-07-01").cast("timestamp_ntz"), F.crc32(F.concat_ws("/", "opportunityid", "productid")) % 2 == 0
    for day, part in enumerate((changes.filter(late), changes.filter(~late & even), changes.filter(~late & ~even)), 2):
        apply_pipeline_changes(s.source(), wh, part, LOG_ORDER, f"2024-02-0{day}T00:00:00")
        if day == 3:
            fold_changes(wh, "2024-02-03T12:00:00")
    return fact_columns(wh.table("factsalesperformance"))


@query
def changelog_monthly(s: Sample) -> DataFrame:
    """The aggregate after the same changes in two runs by a hash."""
    wh = _full(s)
    changes, even = _pipeline_log(s), F.crc32(F.concat_ws("/", "opportunityid", "accountid")) % 2 == 0
    apply_pipeline_changes(s.source(), wh, changes.filter(even), LOG_ORDER, "2024-02-02T00:00:00")
    apply_pipeline_changes(s.source(), wh, changes.filter(~even), LOG_ORDER, "2024-02-03T00:00:00")
    return wh.table("factsalesmonthlyaggregate")


#: Files that a part of a stream is written as: no task writes or joins a whole part.
PART_FILES = 8


def _part_files(parts: Sequence[DataFrame]) -> int:
    """The number of files of each part. Rows are dealt in turn, so each file of a part this large has some; a smaller part is one file."""
    return PART_FILES if all(part.count() >= 1000 * PART_FILES for part in parts) else 1


@query
def stream_changelog(s: Sample) -> DataFrame:
    """The same changes as a stream of three parts, a part in each micro-batch, with a restart before the last."""
    wh = _full(s)
    files, changes = f"{wh.root}-changes", _pipeline_log(s)
    part = F.crc32(F.concat_ws("/", "opportunityid", "productid", "closevalue")) % 3
    parts = [changes.filter(part == k) for k in range(3)]
    n = _part_files(parts)
    for k, rows in enumerate(parts):
        rows.repartition(n).write.mode("append").parquet(files, compression=COMPRESSION)
        if k:
            stream = file_stream(s.spark, files, changes.schema, max_files=n)
            stream_changes(stream, s.source(), wh, LOG_ORDER, "2024-02-02T00:00:00", f"{wh.root}-checkpoint").awaitTermination()
    return fact_columns(Warehouse(s.spark, wh.root).table("factsalesperformance"))


@query
def scd2_reinsert(s: Sample) -> DataFrame:
    """Products deleted by a change log and brought back by a later one: the version valid at each event, none in between."""
    wh = Warehouse(s.spark, shared_folder(s.spark))
    wh.commit("products", "1996-01-01T00:00:00", [wh.write("dimproduct", s.dimproduct, "products")], {})
    some = s.products.filter("productid % 7 = 0")
    apply_dimension_changes(s.source(), wh, "products", some.withColumn("op", F.lit("D")), ["updated_at"], "1997-01-01T00:00:00")
    apply_dimension_changes(s.source(), wh, "products", some.withColumn("op", F.lit("I")), ["updated_at"], "1999-01-01T00:00:00")
    facts = s.factsource.select("opportunityid", "productid", "eventdate")
    return as_of_join(facts, wh.table("dimproduct"), wh.rows("dimproduct"), "closed", how="inner")


def _late_keys(s: Sample, replay: str) -> Warehouse:
    """A full load of an early snapshot that moves the marks, then a run that reads no deals but brings accounts and products
    that rejects wait for."""
    wh = Warehouse(s.spark, shared_folder(s.spark))
    now = s.tables()
    early = dict(now)
    for table, until in (("accounts", SNAPSHOT_DIMS), ("products", SNAPSHOT_DIMS), ("salespipeline", SNAPSHOT_FACTS)):
        early[table] = now[table].filter(F.col("updated_at") <= F.lit(until).cast("timestamp_ntz"))
    initial_load(early, wh, SNAPSHOT_DIMS, options=LoadOptions(marks_after_full="run_ts"))
    incremental_load(now, wh, "2024-02-01T00:00:00", options=LoadOptions(replay=replay))
    return wh


@query
def rejects_replayed(s: Sample) -> DataFrame:
    """Facts after a run that tries only rejects whose keys arrived."""
    return fact_columns(_late_keys(s, "arrived").table("factsalesperformance"))


@query
def rejects_replayed_all(s: Sample) -> DataFrame:
    """The same with every reject tried again."""
    return fact_columns(_late_keys(s, "all").table("factsalesperformance"))


@query
def lineage(s: Sample) -> DataFrame:
    """The batch that wrote each fact."""
    return _two_runs(s).table("factsalesperformance", lineage=True).select("opportunityid", "batch")


@query
def truncated(s: Sample) -> DataFrame:
    """Rows of each table before and after all tables are created anew."""
    wh = Warehouse(s.spark, shared_folder(s.spark))
    frames = {"dimaccount": s.dimaccount, "dimproduct": s.dimproduct, "dimsalesagent": s.dimsalesagent, "dimdate": s.dimdate}
    wh.commit("dims", "2024-02-01T00:00:00", list(wh.write_all(frames, "dims").values()), {})
    before = {name: wh.table(name) for name in frames}
    wh.create_all(run_ts="2024-02-02T00:00:00")
    one = [
        part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(when).alias("at"), "n")
        for name in frames for when, part in (("before", before[name]), ("after", wh.table(name)))
    ]
    return quality.all_checks(*one)


@query
def error_log(s: Sample) -> DataFrame:
    """A run that fails at its facts: what the error log says, and that none of its tables is there."""
    wh = Warehouse(s.spark, shared_folder(s.spark))
    try:
        incremental_load(s.source(), wh, "2024-02-01T00:00:00", options=LoadOptions(bounds="open"))
    except ValueError:
        pass
    count = F.count(F.lit(1))
    return wh.errors().select(
        "batch_id", "message", wh.table("factsalesperformance").agg(count).scalar().alias("facts"), wh.table("dimaccount").agg(count).scalar().alias("accounts"))


@query
def archive_load(s: Sample) -> DataFrame:
    """Facts and archived facts after the months before 1998 were archived."""
    wh = _full(s)
    archive_facts(wh, 199801, "2024-02-02T00:00:00")
    columns = ["opportunityid", "datekey"]
    kept = wh.table("factsalesperformance").select(*columns, F.lit("kept").alias("part"))
    return kept.unionByName(wh.table("factsarchive").select(*columns, F.lit("archived").alias("part")))


@query
def archive_then_incremental(s: Sample) -> DataFrame:
    """An archive is final: the next run, which reads everything again, brings nothing back."""
    wh = _full(s)
    archive_facts(wh, 199801, "2024-02-02T00:00:00")
    incremental_load(s.tables(), wh, "2024-02-03T00:00:00")
    columns = ["opportunityid", "datekey"]
    kept = wh.table("factsalesperformance").select(*columns, F.lit("kept").alias("part"))
    return kept.unionByName(wh.table("factsarchive").select(*columns, F.lit("archived").alias("part")))


@query
def ranged_facts(s: Sample) -> DataFrame:
    """The facts of a full load written in four ranges of the opportunity."""
    wh = Warehouse(s.spark, shared_folder(s.spark))
    initial_load(s.tables(), wh, "2024-02-01T00:00:00", options=LoadOptions(fact_ranges=4))
    return wh.table("factsalesperformance").drop("updated_at")


@query
def ranged_load(s: Sample) -> DataFrame:
    """Accounts loaded range by range; a later attempt writes only the ranges that no attempt with the same edges did."""
    wh = Warehouse(s.spark, shared_folder(s.spark))
    rows, run_ts = s.dimaccount, "2024-02-01T00:00:00"
    ranges = range_edges(s.accounts, "accountid", 4)
    wh.write_in_ranges("dimaccount", rows, "ranged", run_ts, "accountid", range_edges(s.accounts, "accountid", 3)[:2])
    wh.write_in_ranges("dimaccount", rows, "ranged", run_ts, "accountid", ranges[:2])
    entries = wh.write_in_ranges("dimaccount", rows, "ranged", run_ts, "accountid", ranges)
    wh.commit("ranged", run_ts, entries, {})
    return wh.table("dimaccount")


def _streamed(s: Sample, folder: str, checkpoint: str, lines_where: str = "true") -> Warehouse:
    wh = Warehouse(s.spark, f"{folder}/warehouse")
    lines = file_stream(s.spark, f"{s.sf_dir}/lineitem*.parquet", s.raw("lineitem").schema).filter(lines_where)
    pipeline = pipeline_from(lines, s.raw("orders"))
    stream_incremental(
        pipeline, s.source(), wh, "2024-02-01T00:00:00", f"{folder}/{checkpoint}"
    ).awaitTermination()
    return Warehouse(s.spark, wh.root)


@query
def stream_incremental_query(s: Sample) -> DataFrame:
    """The whole pipeline arriving as a stream of order lines into an empty warehouse."""
    return fact_columns(_streamed(s, shared_folder(s.spark), "checkpoint").table("factsalesperformance"))


@query
def stream_batches(s: Sample) -> DataFrame:
    """A stream held to the files of one part for each micro-batch: rows that each of its loads read."""
    folder = shared_folder(s.spark)
    deals, part = s.storedpipeline, F.col("accountid") % 2
    parts = [deals.filter(part == k) for k in range(2)]
    n = _part_files(parts)
    for rows in parts:
        rows.repartition(n).write.mode("append").parquet(f"{folder}/in")
    wh = Warehouse(s.spark, f"{folder}/warehouse")
    stream = file_stream(s.spark, f"{folder}/in", deals.schema, max_files=n)
    stream_incremental(stream, s.source(), wh, "2024-02-01T00:00:00", f"{folder}/checkpoint", options=LoadOptions(validate=False)).awaitTermination()
    return Warehouse(s.spark, wh.root).log().filter("table_name = 'factsalesperformance' and action = 'append'").select("rows_read")


@query
def stream_dedup(s: Sample) -> DataFrame:
    """Deals as a stream of three parts with a restart after each, loaded by appending: repeats in a part and within the delay
    are left out, those a year later count again."""
    folder = shared_folder(s.spark)
    at, deals = F.col("updated_at"), s.storedpipeline
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    first = deals.filter(at < day("1998-01-01"))
    second = deals.filter((at >= day("1998-01-01")) & (at < day("1999-01-01"))).unionByName(first.filter(at >= day("1997-12-01")))
    third = deals.filter((at >= day("1998-01-01")) & (at < day("1998-06-01"))).withColumn("updated_at", at + F.expr("interval 365 days"))
    wh = Warehouse(s.spark, f"{folder}/warehouse")
    dedup = Dedup(tuple(c for c in deals.columns if c != "updated_at"), delay="60 days")
    for rows in (first.unionByName(first), second, third):
        rows.write.mode("append").parquet(f"{folder}/in", compression=COMPRESSION)
        stream = file_stream(s.spark, f"{folder}/in", deals.schema)
        options = LoadOptions(fact_mode="insert_only", validate=False)
        stream_incremental(stream, s.source(), wh, "2024-02-01T00:00:00", f"{folder}/checkpoint", options=options, dedup=dedup).awaitTermination()
    return fact_columns(Warehouse(s.spark, wh.root).table("factsalesperformance"))


@query
def stream_second_checkpoint(s: Sample) -> DataFrame:
    """A second stream under the same name, with a checkpoint of its own, brings what the first left out."""
    folder = shared_folder(s.spark)
    _streamed(s, folder, "one", "l_linenumber <= 3")
    return fact_columns(_streamed(s, folder, "two").table("factsalesperformance"))


REGISTERED["stream_incremental"] = REGISTERED.pop("stream_incremental_query")
