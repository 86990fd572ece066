"""Snapshots that follow their sources and increments that read only the months of a batch, through a Parquet warehouse."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from dockside.operators import period, signature
from dockside.plans import finance, hr, port
from dockside.plans.loads import Run, _Published, _Staged, run_load
from dockside.queries import corrected
from dockside.sources.adapter import Sources
from dockside.sources.overlay import Overlay
from dockside.sources.warehouse import Warehouse


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def test_signatures_do_not_depend_on_order_and_keep_nulls_apart(spark):
    rows = [(1, "a", None), (1, None, "a"), (1, "a", None), (2, "b", "c"), (None, "x", "y")]
    make = lambda r: signature.signatures(spark.createDataFrame(r, "k int, a string, b string"), ["k"], ["a", "b"])
    assert rows_of(make(rows)) == rows_of(make(rows[::-1]))
    changed = [(1, "a", None), (1, "a", None), (1, "a", None), (3, "b", "c"), (None, "x", "y")]
    found = signature.touched(make(rows).where("k is not null"), make(changed).where("k is not null"), ["k"])
    assert sorted(r.k for r in found.collect()) == [1, 2, 3]
    assert make([]).isEmpty()


def test_months_become_ranges_of_days(spark):
    months = [dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 3, 1)]
    days = spark.range(500).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    found = {r.day for r in days.where(signature.in_months("day", months)).collect()}
    assert found == {r.day for r in days.collect() if r.day.replace(day=1) in months}
    assert days.where(signature.in_months("day", [])).isEmpty()


def published(spark, root, area, sources, day, phases):
    warehouse = Warehouse(spark, root)
    run = Run(spark, warehouse, sources, day, day + " 02:00:00")
    for phase in phases:
        run_load(f"{area}_{phase}", run)
    return warehouse, run


FIRST = ["staging", "dimensions_first", "facts_first"]


@pytest.mark.parametrize("area", ["hr", "port"])
def test_a_night_gives_the_rows_of_a_first_load(spark, small, tmp_path, area):
    module = {"hr": hr, "port": port}[area]
    before, now = corrected(area, spark, small)
    if area == "port":  # the port facts' joined check refuses operations whose call is not staged
        before, now = (Overlay(x, CargoOperation=x["CargoOperation"].join(x["PortCall"].select("PortCallID"), "PortCallID", "left_semi")) for x in (before, now))
    root = str(tmp_path / "w")
    warehouse, run = published(spark, root, area, Overlay(before, Employee=now["Employee"]), "2024-01-31", FIRST)
    run.sources = now
    for phase in ("staging", "facts_update"):
        run_load(f"{area}_{phase}", run)
    s, d, reader = _Staged(run, area), _Published(warehouse), Warehouse(spark, root)
    for name in module.SIGNATURES | module.FOLLOWED:
        assert rows_of(reader.table(name)) == rows_of(module.FACTS[name](now, d)), name
    for name, by in module.PERIODS.items():
        ids, wanted = reader.table(name).select(by.loaded_as), module.FACTS[name](now, d).select(by.loaded_as)
        assert ids.count() == ids.distinct().count() and wanted.join(ids, by.loaded_as, "left_anti").isEmpty()

    # the signatures are those of what is published, and a second night adds nothing
    counts = {name: reader.table(name).count() for name in module.FACTS}
    run_load(f"{area}_facts_update", run)
    assert {name: Warehouse(spark, root).table(name).count() for name in module.FACTS} == counts
    for name, by in module.PERIODS.items():
        seen = reader.table(f"signatures.{name}")
        assert rows_of(seen) == rows_of(by.carried(reader.table(name)))
    for name, sign in module.SIGNATURES.items():
        keys = [c for c in reader.table(f"signatures.{name}").columns if c not in signature.SIGNED]
        assert signature.touched(reader.table(f"signatures.{name}"), sign(s, d), keys).isEmpty()


def test_increments_read_the_months_of_the_batch_only(spark, small, tmp_path):
    sources = Sources(spark, small)
    more = sources["Attendance"].withColumns({"AttendanceDate": F.add_months("AttendanceDate", 1), "AttendanceID": F.col("AttendanceID") + 10**9})
    early = Overlay(sources, Attendance=sources["Attendance"].unionByName(more.where("EmployeeID % 2 = 0")))
    warehouse, run = published(spark, str(tmp_path / "w"), "hr", early, "2024-03-31", FIRST)
    run.sources = Overlay(sources, Attendance=sources["Attendance"].unionByName(more))
    run_load("hr_staging", run)
    s, d, by = _Staged(run, "hr"), _Published(warehouse), hr.PERIODS["FactEmployeeAttendance"]
    current, seen = warehouse.table("FactEmployeeAttendance"), warehouse.table("signatures.FactEmployeeAttendance")
    months = period.batch_months(seen, by.signatures(s))
    assert months == sorted({r[0] for r in more.select(period.month_of("AttendanceDate")).distinct().collect()}) and len(months) < seen.count()
    built = period.update(current, s, d, by, hr.attendance, months).where("ChangeType = 'inserted'")
    plan = plan_of(built)
    listed = ", ".join(map(str, months))
    assert re.search(rf"PartitionFilters: \[[^\]]*SourceMonth#\d+ (IN \({listed}\)|= {listed})", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(AttendanceDate,2024-02-01\), LessThan\(AttendanceDat", plan)
    assert built.count() == more.where("EmployeeID % 2 <> 0").count()
    # the monthly snapshot reads the attendance of that month alone
    performance = hr.update_monthly_performance(
        warehouse.table("FactMonthlyEmployeePerformance"), s, d, "2024-01-01", "2030-01-01", warehouse.table("signatures.FactMonthlyEmployeePerformance")
    ).where("ChangeType = 'inserted'")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(AttendanceDate,2024-02-01\), LessThan\(AttendanceDat", plan_of(performance))


def test_billing_takes_line_signatures_from_staging(spark, small):
    s = Sources(spark, small)

    class Staged(Overlay):
        def signatures(self, table):
            return signature.by_parent(self[table], *finance.SIGNED_CHILDREN[table]).withColumn("SignedRows", F.lit(7).cast("long"))

    found = signature.signed("InvoiceLine", *finance.SIGNED_CHILDREN["InvoiceLine"], Staged(s))
    assert {r.InvoiceLineSignedRows for r in found.collect()} == {7}


def test_an_empty_month_layout_can_be_read(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    rows = spark.createDataFrame([(1, 202401), (2, 202402)], "id int, SourceMonth int")
    warehouse.replace("t", "Fact", rows.where("id > 5"), partition_by="SourceMonth")
    assert warehouse.table("Fact").columns == ["id", "SourceMonth"] and warehouse.table("Fact").isEmpty()
    warehouse.append("t", "Fact", rows.withColumn("ChangeType", F.lit("inserted")), partition_by="SourceMonth")
    assert rows_of(Warehouse(spark, str(tmp_path / "w")).table("Fact")) == rows_of(rows)
