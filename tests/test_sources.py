"""Delimited exports, synthetic tables and adapter tables."""

import pytest

from dockside.operators import quality
from dockside.plans import port
from dockside.plans.loads import Run, run_load
from dockside.plans.staging import STAGES
from dockside.sources.adapter import Sources
from dockside.sources.readers import read_export
from dockside.sources.synthetic import port_tables
from dockside.sources.warehouse import MemoryWarehouse


def test_delimited_export(spark, tmp_path):
    (tmp_path / "attendance.csv").write_text(
        "AttendanceID,EmployeeID,AttendanceDate,Status,CheckInTime,CheckOutTime,HoursWorked,Notes\n"
        "1,7,2024-01-05,Présent,08:00:00,16:30:00,8.50,\n2,7,2024-01-06,Absent,,,,ill\n",
        encoding="utf-8",
    )
    rows = read_export(spark, str(tmp_path / "attendance.csv"), "Attendance").orderBy("AttendanceID").collect()
    assert [(r.Status, r.CheckInTime, str(r.HoursWorked)) for r in rows] == [("Présent", "08:00:00", "8.50"), ("Absent", None, "None")]
    (tmp_path / "bad.csv").write_text("AttendanceID,EmployeeID,AttendanceDate,Status,CheckInTime,CheckOutTime,HoursWorked,Notes\nx,7,2024-01-05,P,,,,\n")
    with pytest.raises(Exception):
        read_export(spark, str(tmp_path / "bad.csv"), "Attendance").collect()


def test_synthetic_port_tables_load(spark):
    tables = port_tables(spark, operations=3000, assignments=4000, movements=500)
    assert len(tables) == 17
    for spec in STAGES.values():
        if spec.area == "port":
            quality.enforce(spec.table, quality.validation_report(tables[spec.table], spec.key, spec.required, spec.non_blank))
    warehouse = MemoryWarehouse()
    run = Run(spark, warehouse, tables, "2025-01-01")
    run_load("port_dimensions_first", run)
    run_load("port_facts_first", run)
    assert warehouse.table("FactCargoOperationTransactional").count() == 4000
    assert warehouse.table("FactEquipmentAssignment").count() == 4000
    moved = warehouse.table("FactContainerMovementsAcc").selectExpr("sum(TotalLoads + TotalUnloads) as a", "sum(TotalTEU) as b").first()
    assert moved.a == moved.b == tables["CargoOperation"].selectExpr("sum(Quantity) as q").first().q


def test_adapter_covers_every_staged_table(spark, small):
    sources = Sources(spark, small)
    for spec in STAGES.values():
        assert set(spec.required) <= set(sources[spec.table].columns)
