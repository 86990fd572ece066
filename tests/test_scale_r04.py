"""What updates no longer shuffle or work out twice: rows by employee, the loaded cargo operations, lines' invoices, dimensions."""

from pyspark.sql import functions as F

from dockside import queries
from dockside.plans import port
from dockside.sources.adapter import Sources
from dockside.sources.overlay import Overlay


def _writes(monkeypatch):
    """The names of the tables that queries write once."""
    names, plain = [], queries.stored
    monkeypatch.setattr(queries, "stored", lambda rows, name: names.append(name) or plain(rows, name))
    return names


def test_few_workers_are_sent_to_the_rows(spark):
    rows = spark.sql("select cast(id % 4 as bigint) EmployeeID, date'2024-02-01' day, id from range(40)")
    rows = rows.withColumn("EmployeeID", F.when(F.col("EmployeeID") > 0, F.col("EmployeeID")))
    dim = spark.sql("select id EmployeeID, id * 10 + n EmployeeSK, date'2024-01-01' + cast(n * 20 as int) EffectiveFrom from range(20000), (select explode(array(0, 1)) n) where id > 1")
    d = {"DimPortEmployee": dim}
    wanted = sorted(tuple(r) for r in port._employee(rows, d, "day", None).select("id", "EmployeeSK").collect())
    found = port._employee(rows, d, "day", rows)
    assert sorted(tuple(r) for r in found.select("id", "EmployeeSK").collect()) == wanted
    assert {r[1] for r in wanted} == {-1, 21, 31}  # 1 has no version, null is nobody
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_updates_of_worked_facts_send_only_the_workers(spark, small):
    s = Sources(spark, small)
    d = queries.Dimensions(spark, small, "port")
    s = Overlay(s, OperationEquipmentAssignment=s["OperationEquipmentAssignment"].limit(50))
    for name in port.WORKED:
        first = port.FACTS[name](s, d)
        plan = port.UPDATES[name](first, s, d)._jdf.queryExecution().analyzed().toString()
        assert "LeftSemi" in plan


def test_the_cargo_update_reads_the_loaded_rows_written_once(spark, small, monkeypatch):
    names = _writes(monkeypatch)
    queries.registry()["fact_cargo_operation_update"](spark, small)
    assert names == ["FactCargoOperationTransactional"]


def test_the_line_update_looks_invoices_up_once(spark, small, monkeypatch):
    names = _writes(monkeypatch)
    queries.registry()["fact_invoice_line_update"](spark, small)
    assert names == ["header", "taxes"]


def test_declared_marts_build_each_dimension_once(spark, small, monkeypatch):
    names = _writes(monkeypatch)
    queries.registry()["declared_types_finance_marts"](spark, small)
    assert len(names) == len(set(names)) and "DimInvoice" in names and "Contract" in names
