"""Checks that are made with the write of a table, and what a refused write leaves behind."""

import pytest
from pyspark.sql import functions as F

from dockside.operators.quality import Checks, ValidationError, validation_report
from dockside.plans.loads import Run, run_load
from dockside.plans.staging import STAGES
from dockside.sources.adapter import Sources
from dockside.sources.warehouse import Warehouse

CHECKS = Checks(("ID",), ("ID", "Name"), ("Name",))


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "ID int, Name string, Other string")


@pytest.mark.parametrize("rows", [
    [(1, "a", None), (2, " ", "x"), (None, None, "y")],
    [(1, "a", None), (1, "b", None), (2, "c", None), (2, "c", None), (2, "c", None)],
])
def test_the_checks_are_those_of_the_report(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.replace("p", "T", table(spark, (7, "kept", None)), CHECKS)
    bad = table(spark, *rows)
    with pytest.raises(ValidationError) as refused:
        warehouse.replace("p", "T", bad, CHECKS)
    report = {(r.CheckName, r.Columns): r.Rows for r in validation_report(bad, CHECKS.key, CHECKS.required, CHECKS.non_blank).collect()}
    found = {(check, columns): n for check, columns, n in refused.value.failures}
    assert found and all(report[key] == n for key, n in found.items())
    assert {k for k, n in report.items() if n and k[0] == "missing"} == {k for k in found if k[0] == "missing"}
    for reader in (warehouse, Warehouse(spark, str(tmp_path / "w"))):
        assert [r.ID for r in reader.table("T").collect()] == [7]
    log = {(r.OperationType, r.Status) for r in warehouse.audit().collect()}
    assert {("Validate", "Success"), ("Validate", "Failed"), ("Error", "Failed"), ("Replace", "Success")} == log


def test_an_empty_table_passes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.replace("p", "T", table(spark), CHECKS)
    assert warehouse.table("T").count() == 0


def test_staging_reads_its_source_once(spark, small, tmp_path):
    """Rows that pass the source are counted by a running total: as many as it has, not two or three times as many."""
    passed = spark.sparkContext.accumulator(0)
    sources = Sources(spark, small)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    class Counted:
        def __getitem__(self, name):
            rows = sources[name]
            return rows.mapInArrow(count, rows.schema) if name == "InvoiceLine" else rows

    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run_load("finance_staging", Run(spark, warehouse, Counted(), "1999-01-01"))
    assert passed.value == sources["InvoiceLine"].count() == warehouse.table("finance.InvoiceLine").count()
    validated = warehouse.audit().where("OperationType = 'Validate'")
    assert {r.TargetTable for r in validated.collect()} == {f"finance.{s.table}" for s in STAGES.values() if s.area == "finance"}
    assert validated.where(F.col("RecordsInserted") == passed.value).count() >= 1
