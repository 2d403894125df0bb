"""Warehouse tables as plain Parquet directories with a load log.

Each load of a table writes its own directory ``<table>/batch=<id>``.  The load log says
which directories make up a table: a ``replace`` starts the list anew, an ``append`` adds to
it, a ``reset`` empties it.  All tables and high-water marks of a run become visible by one small append to the log,
made last.  A run that dies before that has changed nothing, and running it again overwrites
the directories it left.  Everything goes through the DataFrame API, so any file system
Spark can write to will do.  One writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from starmart.functions import parse_instant
from starmart.operators.aggregates import in_months
from starmart.schemas import WAREHOUSE_DDL, empty_table, schema_of
from starmart.sources.readers import key_range

LOG_DDL = (
    "seq BIGINT, batch_id STRING, table_name STRING, action STRING, path STRING, months ARRAY<INT>, "
    "rows_read BIGINT, rows_written BIGINT, rows_rejected BIGINT, mark STRING, run_ts STRING, message STRING"
)
MARKED_TABLES = ("accounts", "products", "salesagents", "salespipeline")
NO_MARK = "1970-01-01T00:00:00"
#: Of all that loads write.
COMPRESSION = "zstd"
PARTITIONED = {"factsalesperformance": ("year", "month"), "factsarchive": ("year", "month")}


@dataclass(frozen=True)
class Entry:
    """One line of the load log.  ``path`` is relative to the warehouse."""

    table_name: str
    action: str
    path: str | None = None
    months: tuple[int, ...] | None = None
    rows_read: int | None = None
    rows_written: int | None = None
    rows_rejected: int | None = None
    mark: str | None = None
    message: str | None = None

    @property
    def batch(self) -> str:
        return self.path.rsplit("batch=", 1)[1]


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    _state: dict | None = field(default=None, repr=False)
    _opened: bool = field(default=False, repr=False)

    # --- load log -----------------------------------------------------------
    def log(self) -> DataFrame:
        """The load metadata: every committed table load, mark and error."""
        path = f"{self.root}/_log"
        if not self._opened:
            # Creates the log if there is none, otherwise does nothing.
            self.spark.createDataFrame([], LOG_DDL).write.mode("ignore").parquet(path)
            self._opened = True
        return self.spark.read.schema(StructType.fromDDL(LOG_DDL)).parquet(path)

    def errors(self) -> DataFrame:
        return self.log().filter("action = 'error'").select("batch_id", "run_ts", "message")

    def _live(self) -> dict:
        """Live entries per table, oldest first, and the last sequence number.

        What reaches the driver is the directory list since each table's last replacement.
        """
        if self._state is None:
            log = self.log()
            loads = log.filter(F.col("action").isin("replace", "append", "reset"))
            since = loads.filter("action <> 'append'").groupBy("table_name").agg(F.max("seq").alias("since"))
            live = loads.filter("action <> 'reset'").join(since, "table_name", "left").filter(
                F.col("since").isNull() | (F.col("seq") >= F.col("since"))
            )
            names = ["table_name", "action", "path", "months", "rows_read", "rows_written", "rows_rejected", "message"]
            tables: dict[str, list[Entry]] = {}
            for r in live.orderBy("seq").select(*names).collect():
                tables.setdefault(r.table_name, []).append(Entry(**r.asDict()))
            top = log.agg(F.max("seq")).first()[0]
            self._state = {"tables": tables, "seq": -1 if top is None else top}
        return self._state

    def committed(self, batch_id: str) -> bool:
        return not self.log().filter((F.col("batch_id") == batch_id) & (F.col("action") == "commit")).isEmpty()

    def fresh_batch(self, batch_id: str) -> str:
        """``batch_id``, or a variant of it where that is committed: live directories are never written to."""
        fresh, n = batch_id, 1
        while self.committed(fresh):
            n += 1
            fresh = f"{batch_id}v{n}"
        return fresh

    def commit(self, batch_id: str, run_ts: str, entries: Sequence[Entry], marks: dict[str, str]) -> None:
        """Publish the entries and marks of a run together."""
        for mark in marks.values():
            self.check_instant(mark)
        lines = [
            *entries,
            *[Entry(t, "mark", mark=m) for t, m in marks.items()],
            Entry("*", "commit"),
        ]
        self._append(batch_id, run_ts, lines)

    def log_error(self, batch_id: str, run_ts: str, error: BaseException) -> None:
        self._append(batch_id, run_ts, [Entry("*", "error", message=f"{type(error).__name__}: {error}")])

    def _append(self, batch_id: str, run_ts: str, lines: Sequence[Entry]) -> None:
        seq = self._live()["seq"]
        rows = [
            (seq + i, batch_id, e.table_name, e.action, e.path, list(e.months) if e.months else None, e.rows_read,
             e.rows_written, e.rows_rejected, e.mark, run_ts, e.message)
            for i, e in enumerate(lines, start=1)
        ]
        self.spark.createDataFrame(rows, LOG_DDL).coalesce(1).write.mode("append").parquet(f"{self.root}/_log")
        self._state = None

    # --- high-water marks ---------------------------------------------------
    def marks(self) -> dict[str, str]:
        """Current mark of each source table; the beginning of time if missing or unreadable."""
        newest = (
            self.log().filter("action = 'mark'").groupBy("table_name").agg(F.max_by("mark", "seq").alias("mark"))
        )
        text = F.date_format(parse_instant(F.col("mark"), NO_MARK), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        found = {r.table_name: r.mark for r in newest.select("table_name", text.alias("mark")).collect()}
        return {t: found.get(t, NO_MARK) for t in MARKED_TABLES}

    def last_change(self, table: str) -> str:
        """Instant of the newest change of ``table`` that was applied from a change log."""
        found = self.log().filter((F.col("action") == "mark") & (F.col("table_name") == f"changes:{table}"))
        row = found.agg(F.max_by("mark", "seq").alias("mark")).first()
        return row.mark or NO_MARK

    @staticmethod
    def check_instant(text: str) -> None:
        """Refuse a mark that could not be read back."""
        datetime.fromisoformat(text)

    # --- tables -------------------------------------------------------------
    def table(self, name: str, lineage: bool = False) -> DataFrame:
        """The table as last committed; typed and empty if never loaded.

        ``lineage`` adds the ``batch`` that wrote each row.
        """
        return self.read(name, self._live()["tables"].get(name, []), lineage)

    def rows(self, name: str) -> int:
        return sum(e.rows_written or 0 for e in self._live()["tables"].get(name, []))

    def read(self, name: str, entries: Sequence[Entry], lineage: bool = False) -> DataFrame:
        """The rows in the directories of ``entries``, less months a later entry replaced."""
        extra = [c for c in PARTITIONED.get(name, ()) if c not in schema_of(name).fieldNames()]
        if not entries:
            types = {c: "int" for c in extra} | ({"batch": "string"} if lineage else {})
            empty = empty_table(self.spark, name)
            return empty.withColumns({c: F.lit(None).cast(t) for c, t in types.items()}) if types else empty
        schema = schema_of(name)
        for c in extra:
            schema = schema.add(c, IntegerType())
        schema = schema.add("batch", StringType())
        df = (
            self.spark.read.schema(schema)
            .option("basePath", f"{self.root}/{name}")
            .parquet(*[f"{self.root}/{e.path}" for e in entries])
        )
        for i, e in enumerate(entries):
            older = [x.batch for x in entries[:i]]
            if e.months and older:
                replaced = F.col("batch").isin(older) & in_months(F.col("year"), F.col("month"), e.months)
                df = df.filter(~replaced)
        return df if lineage else df.drop("batch")

    def live(self, name: str) -> list[Entry]:
        return list(self._live()["tables"].get(name, []))

    def write(
        self, name: str, df: DataFrame, batch_id: str, action: str = "replace", months: Sequence[int] = ()
    ) -> Entry:
        """Write one table load (not yet visible) and count its rows on the way."""
        path = f"{name}/batch={batch_id}"
        columns = [df[f.name].cast(f.dataType).alias(f.name) for f in schema_of(name)]
        parts = PARTITIONED.get(name, ())
        if parts:
            # Partition files of a useful size: hot months are split, small ones are joined.
            df = df.select(*columns, *parts).hint("rebalance", *parts)
        else:
            df = df.select(*columns)
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        df.write.mode("overwrite").partitionBy(*parts).parquet(f"{self.root}/{path}", compression=COMPRESSION)
        return Entry(name, action, path, tuple(months) or None, rows_written=seen.get["rows"])

    def write_all(
        self, frames: Mapping[str, DataFrame], batch_id: str, actions: Mapping[str, str] | None = None
    ) -> dict[str, Entry]:
        """Write loads that do not depend on one another side by side: small ones fill few cores."""
        if not frames:
            return {}
        actions = actions or {}

        def one(item: tuple[str, DataFrame]) -> Entry:
            return self.write(item[0], item[1], batch_id, actions.get(item[0], "replace"))

        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            written = list(pool.map(inheritable_thread_target(self.spark)(one), frames.items()))
        return dict(zip(frames, written))

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once and read back, for a load that uses it several times.

        The next load overwrites it.
        """
        path = f"{self.root}/_staging/{name}"
        df.write.mode("overwrite").parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_side(self, name: str, df: DataFrame, batch_id: str, action: str = "append", message: str | None = None) -> Entry:
        """A directory of a side table: one that loads keep for themselves, with a schema of its own."""
        path = f"_{name}/batch={batch_id}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.root}/{path}", compression=COMPRESSION)
        return Entry(name, action, path, rows_written=seen.get["rows"], message=message)

    def side(self, entries: Sequence[Entry], schema: StructType | str | None = None) -> DataFrame:
        """The rows in the directories of a side table."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[f"{self.root}/{e.path}" for e in entries])

    def note_checks(self, batch_id: str, run_ts: str, checks: DataFrame) -> None:
        """Add the result of a validation to the log: a line for each check, violations as ``rows_rejected``."""
        found = checks.collect()  # one row for each check
        self._append(batch_id, run_ts, [Entry(r.table_name, "check", rows_rejected=r.violations, message=r.check_name) for r in found])

    def checks(self) -> DataFrame:
        """Validation results of all loads."""
        return self.log().filter("action = 'check'").select(
            "batch_id", "run_ts", F.col("message").alias("check_name"), "table_name", F.col("rows_rejected").alias("violations"))

    def write_in_ranges(
        self,
        name: str,
        df: DataFrame,
        batch_id: str,
        run_ts: str,
        key: str,
        ranges: Sequence[tuple[int | str | None, int | str | None]],
    ) -> list[Entry]:
        """Write a table load one key range after the other, noting each in the log.

        If the load is cut short, running it again writes only the ranges not noted.  A range's
        directory is named after its edges, so a note never stands for other rows.  The entries
        replace the table once they are committed.
        """
        noted = {
            (r.path, r.message): r.rows_written
            for r in self.log()
            .filter((F.col("batch_id") == batch_id) & (F.col("table_name") == name) & (F.col("action") == "part"))
            .select("path", "message", "rows_written")
            .collect()
        }
        entries = []
        for i, (low, high) in enumerate(ranges):
            span = f"({low}, {high}]"
            part = f"{batch_id}part{i:05d}x{hashlib.sha256(span.encode()).hexdigest()[:12]}"
            path = f"{name}/batch={part}"
            rows = noted.get((path, span))
            if rows is None:
                rows = self.write(name, key_range(df, key, low, high), part).rows_written
                self._append(batch_id, run_ts, [Entry(name, "part", path, rows_written=rows, message=span)])
            entries.append(Entry(name, "append" if i else "replace", path, rows_written=rows))
        return entries

    def create_all(self, batch_id: str = "create", run_ts: str = NO_MARK) -> None:
        """Every table, empty and typed; existing content is replaced (truncate)."""
        batch_id = self.fresh_batch(batch_id)
        entries = self.write_all({name: self.read(name, []) for name in WAREHOUSE_DDL}, batch_id)
        self.commit(batch_id, run_ts, list(entries.values()), {t: NO_MARK for t in MARKED_TABLES})

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in WAREHOUSE_DDL}
