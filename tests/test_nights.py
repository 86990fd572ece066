"""What a night of the HR facts reads and signs: parents that are joined are written once, signatures are computed once."""

import pytest

from dockside import queries
from dockside.plans import hr
from dockside.plans.loads import LOADS, Run
from dockside.queries import Dimensions
from dockside.sources.adapter import Sources
from dockside.sources.warehouse import MemoryWarehouse


def test_the_nights_read_joined_parents_as_written(spark, small, monkeypatch):
    read = []
    monkeypatch.setattr(queries, "run_load", lambda name, run: read.append(run.sources))
    with pytest.raises(KeyError):  # nothing was published
        queries.registry()["hr_facts_after_two_nights"](spark, small)
    dimensions, first, *nights = read
    for sources, tables in [(dimensions, ["Employee"]), *((s, ["Employee", "EmploymentHistory", "Termination"]) for s in (first, *nights))]:
        for table in tables:
            plan = sources[table]._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and "Aggregate" not in plan
    assert sorted(first["Employee"].collect()) == sorted(Sources(spark, small, "v1")["Employee"].collect())
    assert sorted(nights[0]["EmploymentHistory"].select("EmploymentHistoryID").collect()) == sorted(Sources(spark, small)["EmploymentHistory"].select("EmploymentHistoryID").collect())


def test_a_night_signs_a_snapshot_once(spark, small, monkeypatch):
    s, d, name, warehouse, calls = Sources(spark, small), Dimensions(spark, small, "hr"), "FactMonthlyEmployeePerformance", MemoryWarehouse(), []
    sign = hr.month_signatures
    for table in (*hr.DIMENSIONS, "DimDateHR"):
        warehouse.replace("p", table, d[table])
    warehouse.replace("p", name, hr.monthly_performance(s, d).limit(0))
    warehouse.replace("p", f"signatures.{name}", sign(s, d).limit(0))
    counted = lambda *given: calls.append(1) or sign(*given)
    monkeypatch.setattr(hr, "month_signatures", counted)
    monkeypatch.setitem(hr.SIGNATURES, name, counted)
    dict(LOADS["hr_facts_update"](Run(spark, warehouse, s, queries.HR_RUN_DATE)))[name]("p", name)
    assert len(calls) == 1
    assert warehouse.table(name).count() == hr.monthly_performance(s, d).count() > 0
