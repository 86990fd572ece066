"""Declared types, and delimited text with lines that do not conform."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dockside.operators import declared
from dockside.plans import declarations
from dockside.plans.loads import Run, run_load
from dockside.sources.adapter import Sources
from dockside.sources.overlay import Overlay
from dockside.sources.readers import read_quarantined
from dockside.sources.warehouse import Warehouse

SCHEMA = "ID int not null, Code varchar(5), Amount decimal(8,2) not null, Day date"


def test_problems_are_named_and_no_value_is_changed(spark):
    rows = spark.createDataFrame(
        [
            ("1", "abcde", "1.25", "2024-02-29", "x"), ("2", "abcdef", "1", None, "x"), ("3", None, "1234567.00", "2024-02-30", "x"),
            (None, "", "1.257", "2024-01-01", "x"), ("2147483648", "é" * 5, "-999999.99", "2024-01-01", "x"), ("4.5", "a", None, "soon", "x"),
            ("1", "abcde", "1.25", "2024-02-29", "x"), ("7", "a", "1.50000", "2024-01-01 10:00:00", "x"),
        ],
        "ID string, Code string, Amount string, Day string, Problem string",
    )
    good, refused = declared.conformed(rows, SCHEMA)
    assert [tuple(r) for r in good.collect()] == [(1, "abcde", Decimal("1.25"), dt.date(2024, 2, 29))] * 2
    assert good.schema.simpleString() == "struct<ID:int,Code:string,Amount:decimal(8,2),Day:date>"
    named = [r.Problems for r in refused.collect()]
    assert named == [
        ["Code: too long"], ["Amount: unreadable", "Day: unreadable"], ["ID: missing", "Amount: inexact"], ["ID: unreadable"],
        ["ID: unreadable", "Amount: missing", "Day: unreadable"], ["Day: inexact"],
    ]


def test_typed_sources(spark):
    rows = spark.sql("select 3000000000L as ID, 'ab' as Code, 12.5D as Amount, timestamp_ntz'2024-01-01 00:00:00' as Day union all select 1L, 'ab', 0.1D, null")
    good, refused = declared.conformed(rows, SCHEMA)
    assert [tuple(r) for r in good.collect()] == [(1, "ab", Decimal("0.10"), None)]
    assert [r.Problems for r in refused.collect()] == [["ID: unreadable"]]
    assert declared.conformed(rows.where("false"), SCHEMA)[0].count() == 0


def test_report(spark):
    rows = spark.sql("select 1 as ID, 'abcdef' as Code, 1.005BD as Amount union all select null, 'a', 123456789.0BD")
    found = {r.ColumnName: tuple(r)[1:] for r in declared.report(rows, SCHEMA.replace("Day date", "Day date not null")).collect()}
    assert found == {
        "ID": ("int", 1, 0, 0, 0), "Code": ("varchar(5)", 0, 0, 1, 0), "Amount": ("decimal(8,2)", 0, 1, 0, 1), "Day": ("date", 2, 0, 0, 0),
    }
    assert [tuple(r)[2:] for r in declared.report(rows.where("false"), SCHEMA).collect()] == [(0, 0, 0, 0)] * 4


def test_quarantine(spark, tmp_path):
    lines = ["ID;Code;Amount;Day", "1;a;2.50;2024-01-01", "2;a;2.50", "3;a;2.50;2024-01-01;more", "x;;;2024-01-01", '4;"b;c";1;', "", "1;a;2.50;2024-01-01"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows, quarantine = read_quarantined(spark, str(tmp_path / "in.csv"), SCHEMA, ";")
    assert sorted((r.ID, r.Code) for r in rows.collect()) == [(1, "a"), (1, "a"), (4, "b;c")]
    assert rows.select("Code").count() == 3  # also where a query reads few columns
    assert sorted((r.Line, tuple(r.Problems)) for r in quarantine.collect()) == [
        ("2;a;2.50", ("line: fields",)), ("3;a;2.50;2024-01-01;more", ("line: fields",)), ("x;;;2024-01-01", ("ID: unreadable", "Amount: missing")),
    ]
    assert all(r.SourceFile.endswith("in.csv") for r in quarantine.collect()) and quarantine.count() == 3


def test_published_tables_have_their_declared_types(spark, small, tmp_path):
    warehouse, sources = Warehouse(spark, f"file://{tmp_path}/w", declarations.PUBLISHED), Sources(spark, small)
    for step in ("staging", "dimensions_first"):
        run_load(f"finance_{step}", Run(spark, warehouse, sources, "2024-01-31"))
    for table, columns in declarations.DIMENSIONS.items():
        fields = {f.name: declared.stored(f) for f in declared.schema_of(columns).fields}
        assert {f.name: f.dataType for f in warehouse.table(table).schema if f.name in fields} == fields
    assert warehouse.table("finance.Tax").schema["TaxRate"].dataType.simpleString() == "decimal(6,3)"
    assert warehouse.table("DimTax").schema["TaxRate"].dataType.simpleString() == "decimal(18,4)"
    long = sources["Customer"].withColumn("CustomerName", F.repeat("CustomerName", 60))
    before = warehouse.table("finance.Customer").count()
    with pytest.raises(Exception, match="CustomerName is too long"):
        run_load("finance_staging", Run(spark, warehouse, Overlay(sources, Customer=long), "2024-02-01"))
    again = Warehouse(spark, f"file://{tmp_path}/w", declarations.PUBLISHED)
    assert again.table("finance.Customer").count() == before
    assert again.audit().where("Status = 'Failed' and TargetTable = 'finance.Customer'").count() == 1
