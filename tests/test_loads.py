"""Whole loads through a Parquet warehouse: first load, increment, repeat, failure."""

import pytest
from pyspark.sql import functions as F

from dockside.operators import scd
from dockside.operators.quality import ValidationError
from dockside.plans import finance, hr, port
from dockside.plans.loads import LOADS, Run, run_load
from dockside.queries import Dimensions
from dockside.sources.adapter import Sources
from dockside.sources.overlay import Overlay
from dockside.sources.warehouse import Warehouse


def _run_all(spark, warehouse, sources, area, phases, run_date):
    run = Run(spark, warehouse, sources, run_date, run_date + " 02:00:00")
    for phase in phases:
        run_load(f"{area}_{phase}", run)


def _counts(warehouse, prefix):
    return {name: table.count() for name, table in warehouse.tables().items() if name.startswith(prefix)}


DAYS = {
    "finance": ("1996-01-01", "1999-01-01", "1999-01-02"),
    "hr": ("2024-01-02", "2024-01-31", "2024-01-31"),
    "port": ("1996-01-01", "1999-01-01", "1999-01-02"),
}


@pytest.mark.parametrize("area,days", DAYS.items())
def test_load_increment_repeat(spark, small, tmp_path, area, days):
    warehouse = Warehouse(spark, str(tmp_path / area))
    later = Sources(spark, small)
    # the port facts' joined check refuses operations whose call or container is not staged yet
    earlier = Overlay(Sources(spark, small, "v1"), **({t: later[t] for t in ("Container", "PortCall")} if area == "port" else {}))
    _run_all(spark, warehouse, earlier, area, ["staging", "dimensions_first", "facts_first"], days[0])
    before = _counts(warehouse, "Fact")
    assert before and all(v > 0 for k, v in before.items() if k != "FactTermination")
    _run_all(spark, warehouse, Sources(spark, small), area, ["staging", "dimensions_update", "facts_update"], days[1])

    # a fresh reader resolves the same tables from the log alone
    reader = Warehouse(spark, str(tmp_path / area))
    after, dims = _counts(reader, "Fact"), _counts(reader, "Dim")
    assert all(after[k] >= before[k] for k in before)
    # a second identical increment changes no dimension and no fact
    _run_all(spark, reader, Sources(spark, small), area, ["dimensions_update", "facts_update"], days[2])
    grown = {k: v for k, v in _counts(reader, "Dim").items() if k != "DimDate"}
    assert grown == {k: v for k, v in dims.items() if k != "DimDate"}
    assert _counts(reader, "Fact") == after
    log = reader.audit()
    assert log.where("Status = 'Failed'").isEmpty()
    assert log.where("OperationType = 'Start' and Status = 'In Progress'").count() == 8
    if area == "hr":
        assert str(reader.last_load("FactTables")) == days[2]


def _rows(warehouse, fact, source_id):
    table = warehouse.table(fact)
    return table.count(), table.select(source_id).distinct().count()


def test_hr_first_load_night_failure_and_retry_leave_each_row_once(spark, small, tmp_path, monkeypatch):
    root, sources = str(tmp_path / "w"), Sources(spark, small)
    warehouse = Warehouse(spark, root)
    held = {t: sources[t].count() for t in ("SalaryPayment", "Attendance")}
    early = Overlay(sources, SalaryPayment=sources["SalaryPayment"].where("PaymentDate <= date'2024-01-15'"))
    _run_all(spark, warehouse, early, "hr", ["staging", "dimensions_first", "facts_first"], "2024-01-15")
    assert str(Warehouse(spark, root).last_load("FactTables")) == "2024-01-15"
    before = _rows(warehouse, "FactSalaryPayment", "SourceSalaryPaymentID")
    run_load("hr_staging", Run(spark, warehouse, sources, "2030-01-01", "2030-01-01 02:00:00"))
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "advance", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_load("hr_facts_update", Run(spark, warehouse, sources, "2030-01-01"))
    for reader in (warehouse, Warehouse(spark, root)):
        assert _rows(reader, "FactSalaryPayment", "SourceSalaryPaymentID") == before
    for _ in range(2):
        run_load("hr_facts_update", Run(spark, warehouse, sources, "2030-01-01"))
    reader = Warehouse(spark, root)
    count, distinct = _rows(reader, "FactSalaryPayment", "SourceSalaryPaymentID")
    assert before[0] < count == distinct <= held["SalaryPayment"]
    assert _rows(reader, "FactEmployeeAttendance", "SourceAttendanceID") == (held["Attendance"], held["Attendance"])
    # the month of a run date without attendance loses nothing
    assert reader.table("FactMonthlyEmployeePerformance").count() > 0


def test_repeated_and_missing_business_keys_are_refused_in_updates(spark, small, tmp_path):
    warehouse, sources = Warehouse(spark, str(tmp_path / "w")), Sources(spark, small)
    _run_all(spark, warehouse, sources, "finance", ["staging", "dimensions_first"], "1996-01-01")
    cycles = sources["BillingCycle"]
    twice = cycles.unionByName(cycles.withColumn("BillingCycleID", F.col("BillingCycleID") + 1000))
    for bad, check in ((twice, "duplicate_keys"), (cycles.withColumn("CycleName", F.lit(None).cast("string")), "missing")):
        before = _counts(warehouse, "Dim")
        run = Run(spark, warehouse, Overlay(sources, BillingCycle=bad), "1999-01-01")
        warehouse.replace("test", "finance.BillingCycle", bad)
        with pytest.raises(ValidationError) as refused:
            run_load("finance_dimensions_update", run)
        assert check in {c for c, _, _ in refused.value.failures}
        assert _counts(Warehouse(spark, str(tmp_path / "w")), "Dim") == before


def test_null_business_keys_are_matched_not_multiplied(spark):
    dim = scd.Dimension("D", "K", ("ID",), ("Name",), "overwrite")
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "ID long, Name string")
    state = scd.first_load(rows, dim, "2024-01-01")
    for _ in range(2):
        state = scd.update(state, rows, dim, "2024-01-02").drop(scd.CHANGE)
    assert state.count() == 2


def test_first_load_then_update_on_the_same_source_inserts_nothing(spark, small):
    s, d = Sources(spark, small), Dimensions(spark, small, "port")
    for fact in ("FactCargoOperationTransactional", "FactEquipmentAssignment"):
        first = port.FACTS[fact](s, d)
        assert port.UPDATES[fact](first, s, d).where("ChangeType = 'inserted'").isEmpty()
    d = Dimensions(spark, small, "hr")
    attendance = hr.attendance(s, d)
    assert hr.update_attendance(attendance, s, d, "1900-01-01", "2100-01-01").where("ChangeType = 'inserted'").isEmpty()
    assert attendance.count() == s["Attendance"].count()


def test_same_day_and_late_calls_and_an_open_month(spark, small):
    s, d = Sources(spark, small), Dimensions(spark, small, "port")
    latest = s["PortCall"].agg(F.max(F.col("ArrivalDateTime").cast("date"))).first()[0]
    calls = [r.PortCallID for r in s["PortCall"].where(F.col("ArrivalDateTime").cast("date") == latest).collect()]
    some = s["PortCall"].where(~F.col("PortCallID").isin(calls[1:])).where(f"PortCallID % 7 <> 3 or PortCallID = {calls[0]}")
    first = port.port_call_snapshot(Overlay(s, PortCall=some), d)
    state = port.update_port_call_snapshot(first, s, d).drop("ChangeType")
    assert state.exceptAll(port.port_call_snapshot(s, d)).isEmpty() and state.count() == port.port_call_snapshot(s, d).count()
    d = Dimensions(spark, small, "finance")
    part = Overlay(s, Payment=s["Payment"].where("PaymentDate < date'1998-06-15'"), Invoice=s["Invoice"].where("InvoiceDate < date'1998-06-15'"))
    state = finance.update_billing_snapshot(finance.billing_snapshot(part, d), s, d).drop("ChangeType")
    month = d["DimDate"].where("FullDate >= date'1998-06-01'").select("DimDateID")
    assert state.join(month, "DimDateID").exceptAll(finance.billing_snapshot(s, d).join(month, "DimDateID")).isEmpty()


def test_later_operations_and_payments_reach_older_rows(spark, small):
    s, d = Sources(spark, small), Dimensions(spark, small, "port")
    early = Overlay(s, CargoOperation=s["CargoOperation"].where("pmod(hash(CargoOpID), 9) <> 1"), BerthAllocation=s["BerthAllocation"].where("pmod(hash(AllocationID), 8) <> 1"))
    first, whole = port.port_call_snapshot(early, d), port.port_call_snapshot(s, d)
    assert not first.exceptAll(whole).isEmpty()
    state = port.update_port_call_snapshot(first, s, d)
    assert state.drop("ChangeType").exceptAll(whole).isEmpty() and state.count() == whole.count()
    assert not state.where("ChangeType = 'kept'").isEmpty()
    d = Dimensions(spark, small, "finance")
    early = Overlay(s, Payment=s["Payment"].where("pmod(hash(PaymentID), 9) <> 1"), Invoice=s["Invoice"].where("pmod(hash(InvoiceID), 9) <> 1"))
    first, whole = finance.billing_snapshot(early, d), finance.billing_snapshot(s, d)
    assert first.join(whole, first.columns, "left_semi").count() < first.count()
    state = finance.update_billing_snapshot(first, s, d)
    assert state.drop("ChangeType").exceptAll(whole).isEmpty() and state.count() == whole.count()
    assert not state.where("ChangeType = 'kept'").isEmpty()


def test_a_replaced_period_an_empty_one_and_many_appends(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    table = lambda rows: spark.createDataFrame(rows, "MonthDateKey long, Hours long, ChangeType string")
    warehouse.replace("p", "F", table([(1, 10, "inserted"), (2, 20, "inserted")]))
    warehouse.replace_partitions("p", "F", table([(1, 10, "kept"), (2, 25, "inserted"), (3, 30, "inserted")]), partition_by="MonthDateKey")
    warehouse.replace_partitions("p", "F", table([(1, 10, "kept"), (2, 25, "kept")]), partition_by="MonthDateKey")
    for reader in (warehouse, Warehouse(spark, str(tmp_path / "w"))):
        assert sorted(tuple(r) for r in reader.table("F").collect()) == [(1, 10), (2, 25)]
    for k in range(30):
        warehouse.append("p", "G", table([(k, k, "inserted")]))
    assert warehouse.table("G").count() == 30
    assert warehouse.table("G")._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    warehouse.replace("p", "E", table([]))
    assert Warehouse(spark, str(tmp_path / "w")).table("E").count() == 0


def test_refused_load_keeps_the_last_state(spark, small, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    sources = Sources(spark, small)
    run_load("port_staging", Run(spark, warehouse, sources, "1999-01-01"))
    ships = warehouse.table("port.Ship").count()
    bad = Overlay(sources, Ship=sources["Ship"].withColumn("Name", F.lit(" ")))
    with pytest.raises(ValidationError) as refused:
        run_load("port_staging", Run(spark, warehouse, bad, "1999-01-02"))
    assert ("missing", "Name", ships) in refused.value.failures
    again = Warehouse(spark, str(tmp_path / "w"))
    assert again.table("port.Ship").where("trim(Name) <> ''").count() == ships
    statuses = {r.Status for r in again.audit().where("ProcessName = 'port_staging' and TargetTable = '*'").collect()}
    assert statuses == {"In Progress", "Success", "Failed"}


def test_every_wrapper_exists():
    assert len(LOADS) == 15
