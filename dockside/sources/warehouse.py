"""Where loads are published: Parquet directories on shared storage, with the audit log saying which are current.

A load writes a directory of its own and then logs it. A table is what its last logged replacement wrote plus the
appends logged since; a replaced period is an append that says which keys of the older directories it supersedes. No
directory is written twice. Steps that run ``together`` are logged as one entry, so readers see all of them or none.
"""

import contextlib
import datetime as dt
import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from dockside.operators.declared import enforced
from dockside.operators.quality import Checks, ValidationError, enforce
from dockside.operators.scd import CHANGE
from dockside.sources.shared import stored

AUDIT_SCHEMA = (
    "LogID bigint, ProcessName string, OperationType string, TargetTable string, StartTime timestamp, EndTime timestamp, "
    "RecordsInserted bigint, RecordsUpdated bigint, Status string, Message string, Location string"
)
PIECES = 32
NEVER_LOADED = dt.date(1900, 1, 1)


def _counts(seen: Observation) -> dict:
    try:
        return seen.get
    except Py4JJavaError:  # a plan that is known to give no rows is left out whole, and what would have counted them with it
        return {"inserted": 0, "updated": 0, "rows": 0}


def _now():
    return dt.datetime.now(dt.timezone.utc)


class MemoryWarehouse:
    """Same interface without storage: loads stay lazy DataFrames, reports are not run."""

    def __init__(self):
        self._tables: dict[str, DataFrame] = {}
        self._control: dict[str, object] = {}

    def has(self, table):
        return table in self._tables

    def table(self, table):
        return self._tables[table]

    def replace(self, process, table, rows, report=None, partition_by=None):
        self._tables[table] = self._kept(table, rows.drop(CHANGE))

    def _kept(self, table, rows):
        return rows

    def replace_partitions(self, process, table, rows, report=None, partition_by=None):
        self.replace(process, table, rows)

    @contextlib.contextmanager
    def together(self):
        yield

    def append(self, process, table, rows, report=None, partition_by=None):
        fresh = rows.where(F.col(CHANGE) == "inserted").drop(CHANGE)
        self._tables[table] = self._tables[table].unionByName(self._kept(table, fresh))

    def replace_periods(self, process, table, rows, periods, report=None, partition_by=None):
        others = self._tables[table].where(~F.col(partition_by).isin(list(periods)))
        self._tables[table] = others.unionByName(self._kept(table, rows.drop(CHANGE)))

    def clear(self, process, table):
        self._tables.pop(table, None)

    def skip(self, process, table, report=None):
        pass

    def note(self, process, operation, status, message=""):
        pass

    def last_load(self, process):
        return self._control.get(process, NEVER_LOADED)

    def advance(self, process, day):
        self._control[process] = day


class FolderWarehouse(MemoryWarehouse):
    """The same with every published table written to a shared folder, which later steps read: each step's work is done once."""

    def _kept(self, table, rows):
        return stored(rows, table)


class Warehouse:
    """``declared`` gives the columns of published tables by name: they are written in those types, or the load is refused."""

    def __init__(self, spark: SparkSession, root: str, declared: dict | None = None):
        self.spark, self.root, self.declared = spark, root.rstrip("/"), declared or {}
        self._pending: list | None = None
        self._locations = self._read_locations()
        self._frames: dict[str, DataFrame] = {}

    # --- state

    def audit(self) -> DataFrame:
        """The log; a process logged as in progress and later as finished counts once, with its last status."""
        return self._read("_audit", AUDIT_SCHEMA)

    def control(self) -> DataFrame:
        """The high-water marks, from the log."""
        marks = self.audit().where("Status = 'Success' and OperationType = 'Control'")
        return marks.selectExpr("TargetTable as ProcessName", "cast(Message as date) as LastLoadDate")

    def _read(self, name, schema):
        path = f"{self.root}/{name}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        exists = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)
        return self.spark.read.schema(schema).parquet(path) if exists else self.spark.createDataFrame([], schema)

    def _read_locations(self):
        """Current directories per table and the keys that later periods supersede in each, from the log of successful loads
        (one row per load, not per data row)."""
        found: dict[str, list[tuple]] = {}
        loads = self.audit().where("Status = 'Success' and OperationType in ('Replace', 'Append', 'Partition', 'Delete')").orderBy("LogID")
        for row in loads.select("TargetTable", "OperationType", "Location", "Message").collect():
            if row.OperationType in ("Append", "Partition"):
                gone = json.loads(row.Message) if row.OperationType == "Partition" else None
                found[row.TargetTable] = self._with(found.get(row.TargetTable, []), row.Location, gone)
            else:
                found[row.TargetTable] = [(row.Location, ())] if row.Location else []
        return found

    @staticmethod
    def _with(locations, location, gone=None):
        """The directories with one more; ``gone`` (column, values) is superseded in those before."""
        before = [(path, (*hidden, (gone[0], tuple(gone[1])))) for path, hidden in locations] if gone else locations
        return [*before, (location, ())]

    def has(self, table: str) -> bool:
        return bool(self._locations.get(table))

    def table(self, table: str) -> DataFrame:
        """The current state: one read of all directories that hide the same keys; listed once per published version."""
        if table not in self._frames:
            groups: dict[tuple, list[str]] = {}
            for path, hidden in self._locations[table]:
                groups.setdefault(hidden, []).append(path)
            state = None
            for hidden, paths in groups.items():
                part = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths).drop("load")
                for column, values in hidden:
                    part = part.where(~F.col(column).isin(list(values)) | F.col(column).isNull()) if values else part
                state = part if state is None else state.unionByName(part)
            self._frames[table] = state
        return self._frames[table]

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in sorted(self._locations) if self.has(name)}

    # --- loads

    @contextlib.contextmanager
    def together(self):
        """Loads inside are seen by one another at once, by others when all have succeeded; a failure takes all of them back."""
        before, self._pending = dict(self._locations), []
        try:
            yield
            done, self._pending = self._pending, None
            self._write(done)
        except Exception:
            failed = [row for row in self._pending or [] if row[8] == "Failed"]
            self._pending, self._locations = None, before
            self._frames.clear()
            self._write(failed)
            raise

    def replace(self, process, table, rows, report=None, partition_by=None):
        """Publish ``rows`` as the whole table, in a directory for each value of ``partition_by``."""
        location = self._new_location(table)
        self._load(process, "Replace", table, rows, report, location, partition_by=partition_by)
        self._locations[table] = [(location, ())]

    def append(self, process, table, rows, report=None, partition_by=None):
        """Publish the inserted rows only; what is loaded already is not rewritten."""
        location = self._new_location(table)
        self._load(process, "Append", table, rows.where(F.col(CHANGE) == "inserted"), report, location, partition_by=partition_by)
        self._locations[table] = self._with(self._locations.get(table, []), location)

    def replace_partitions(self, process, table, rows, report=None, partition_by=None):
        """Publish the inserted rows in the place of the periods that ``rows`` no longer keeps; nothing older is rewritten.
        ``partition_by`` names the period's key; the periods replaced (not their rows) are listed in the log."""
        fresh, kept = rows.where(F.col(CHANGE) == "inserted"), rows.where(F.col(CHANGE) != "inserted")
        gone = self.table(table).select(partition_by).distinct().join(kept.select(partition_by).distinct(), partition_by, "left_anti")
        self._supersede(process, table, fresh, [partition_by, sorted(r[0] for r in gone.collect() if r[0] is not None)], report)

    def replace_periods(self, process, table, rows, periods, report=None, partition_by=None):
        """Publish ``rows``, kept ones too, as all that the table has in ``periods`` of ``partition_by``; what lies in others is not rewritten.
        A table in ``PIECES`` directories is written as one again, so that reading it stays one short plan."""
        if len(self._locations[table]) >= PIECES:
            others = self.table(table).where(~F.col(partition_by).isin(list(periods)))
            return self.replace(process, table, others.withColumn(CHANGE, F.lit("kept")).unionByName(rows), report, partition_by)
        self._supersede(process, table, rows, [partition_by, list(periods)], report, partition_by)

    def _supersede(self, process, table, rows, gone, report, partition_by=None):
        location = self._new_location(table)
        self._load(process, "Partition", table, rows, report, location, json.dumps(gone), partition_by)
        self._locations[table] = self._with(self._locations[table], location, gone)
        self._frames.pop(table, None)

    def clear(self, process, table):
        if self.has(table):
            self._log(process, "Delete", table, _now(), None, None, "Success", "cleared", None)
            self._locations[table] = []
            self._frames.pop(table, None)

    def skip(self, process, table, report=None):
        """Log that a table stays as it is; its checks are run all the same."""
        if report is not None:
            enforce(table, report)
        self._log(process, "Skip", table, _now(), 0, 0, "Success", "nothing new", None)

    def note(self, process, operation, status, message=""):
        self._log(process, operation, "*", _now(), None, None, status, message, None)

    def _new_location(self, table):
        return f"{self.root}/{table}/load={time.time_ns()}"

    def _load(self, process, operation, table, rows, report, location, message="", partition_by=None):
        """``report`` is run before the write; ``Checks`` are made with it, and a directory that fails them is never logged."""
        started, checks = _now(), report if isinstance(report, Checks) else None
        try:
            if report is not None and checks is None:
                enforce(table, report)
            rows = enforced(rows, self.declared[table]) if table in self.declared else rows
            tagged = rows if CHANGE in rows.columns else rows.withColumn(CHANGE, F.lit("inserted"))
            seen = Observation()
            counted = tagged.observe(
                seen,
                F.count(F.when(F.col(CHANGE) == "inserted", 1)).alias("inserted"),
                F.count(F.when(F.col(CHANGE).isin("updated", "expired"), 1)).alias("updated"),
                *(checks.counted() if checks else []),
            )
            written = counted.drop(CHANGE)
            if partition_by:  # rows of a period go together, a large period to several tasks
                written = written.hint("rebalance", partition_by)
            written.write.mode("errorifexists").parquet(location, partitionBy=partition_by)
            counts = _counts(seen)
            if partition_by and not any(counts.values()):  # no directory of a period was written, so nothing to read the columns from
                written.drop(partition_by).limit(0).write.parquet(f"{location}/{partition_by}=__HIVE_DEFAULT_PARTITION__")
            if checks:
                failures = checks.failures(counts, self.spark.read.schema(written.schema).parquet(location))
                status = ("Failed", json.dumps(failures)) if failures else ("Success", "")
                self._log(process, "Validate", table, started, counts["rows"], None, *status, None)
                if failures:
                    raise ValidationError(table, failures)
        except Exception as error:
            self._log(process, "Error", table, started, None, None, "Failed", str(error), None)
            raise
        self._frames.pop(table, None)
        self._log(process, operation, table, started, counts["inserted"], counts["updated"], "Success", message, location)

    def _log(self, process, operation, table, started, inserted, updated, status, message, location):
        row = (time.time_ns(), process, operation, table, started, _now(), inserted, updated, status, message, location)
        if self._pending is None:
            self._write([row])
        else:
            self._pending.append(row)

    def _write(self, rows):
        """One entry of the log: a single file."""
        if rows:
            self.spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_audit")

    # --- high-water mark

    def last_load(self, process):
        day = self.control().where(F.col("ProcessName") == process).agg(F.max("LastLoadDate").alias("d")).first().d
        return day or NEVER_LOADED

    def advance(self, process, day):
        self._log("control", "Control", process, _now(), None, None, "Success", str(day), None)
