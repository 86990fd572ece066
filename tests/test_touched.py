"""Tables updated in place by the months that differ, and totals kept by signed parts, through a Parquet warehouse."""

import re

import pytest
from pyspark.sql import functions as F

from dockside.operators import additive, increment, period, scd
from dockside.plans import finance, port
from dockside.plans.loads import Run, _Published, _Staged, run_load
from dockside.queries import corrected
from dockside.sources import warehouse as storage
from dockside.sources.adapter import Sources
from dockside.sources.overlay import Overlay
from dockside.sources.warehouse import Warehouse

FIRST = ["staging", "dimensions_first", "facts_first"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def night(run, sources, area, *phases):
    run.sources = sources
    for phase in phases:
        run_load(f"{area}_{phase}", run)


def operations(warehouse, table):
    rows = warehouse.audit().where(F.col("TargetTable") == table).orderBy("LogID")
    return [r.OperationType for r in rows.select("OperationType").collect()]


def test_lifecycle_and_invoices_rewrite_the_months_that_differ(spark, small, tmp_path):
    sources = Sources(spark, small)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run = Run(spark, warehouse, None, "1999-01-01", "1999-01-01 02:00:00")
    night(run, sources, "finance", *FIRST)
    name, members = "FactInvoiceLifecycleAccumulating", "DimInvoice"
    first, first_members, held = (warehouse.table(t) for t in (name, members, "signatures.DimInvoice"))
    wanted = rows_of(finance.invoice_lifecycle(_Staged(run, "finance"), _Published(warehouse)))
    assert rows_of(first.drop(period.MONTH)) == wanted

    # payments of one month's invoices change, one invoice moves to another month, one goes, the members of a month get a status
    paid = F.when(F.col("InvoiceID").isin(PAID := invoices_of(sources, "1995-03")), F.col("Amount") + 1).otherwise(F.col("Amount")).cast("decimal(18,4)")
    moving, leaving = invoices_of(sources, "1995-06")[:2]
    invoices = sources["Invoice"].where(F.col("InvoiceID") != leaving)
    invoices = invoices.withColumn("InvoiceDate", F.when(F.col("InvoiceID") == moving, F.add_months("InvoiceDate", 4)).otherwise(F.col("InvoiceDate")))
    invoices = invoices.withColumn("Status", F.when(F.col("InvoiceID").isin(PAID), F.lit("Held")).otherwise(F.col("Status")))
    later = Overlay(sources, Invoice=invoices, Payment=sources["Payment"].withColumn("Amount", paid))
    night(run, later, "finance", "staging", "dimensions_update", "facts_update")

    s, d = _Staged(run, "finance"), _Published(warehouse)
    whole = increment.merge(first.drop(period.MONTH), finance.invoice_lifecycle(s, d), ["DimInvoiceID"], finance.MILESTONES).drop(scd.CHANGE)
    reader = Warehouse(spark, str(tmp_path / "w"))
    assert rows_of(reader.table(name).drop(period.MONTH)) == rows_of(whole)
    dim = finance.DIMENSIONS[members]
    expected = scd.update(first_members, finance.dimension_source(members, s), dim, run.run_date).drop(scd.CHANGE, period.MONTH)
    assert rows_of(reader.table(members).drop(period.MONTH)) == rows_of(expected)

    # the log says so: a few months were written, the directories of the others are carried over
    months = {m: [int(x) for x in re.findall(r"\d+", message_of(reader, m).split(",", 1)[1])] for m in (name, members)}
    assert set(months[name]) == {199503, 199506, 199510} and months[members] and set(months[members]) <= set(months[name])
    written = sum(r.RecordsInserted + r.RecordsUpdated for r in reader.audit().where(F.col("TargetTable") == name).where("OperationType = 'Partition'").collect())
    assert 0 < written < first.count() / 10
    assert re.search(r"PartitionFilters: \[[^\]]*SourceMonth", plan_of(reader.table(name)))

    # a second such night has nothing to do; the moved invoice is still found where it was published
    night(run, later, "finance", "dimensions_update", "facts_update")
    assert operations(reader, name)[-1] == operations(reader, members)[-1] == "Skip"
    back = Overlay(later, Invoice=invoices.withColumn("TotalAmount", F.when(F.col("InvoiceID") == moving, F.lit(1)).otherwise(F.col("TotalAmount")).cast("decimal(18,4)")))
    night(run, back, "finance", "staging", "facts_update")
    reader = Warehouse(spark, str(tmp_path / "w"))
    assert reader.table(name).groupBy("DimInvoiceID").count().where("count > 1").isEmpty()
    assert "199506" in message_of(reader, name) and "199510" in message_of(reader, name)


def invoices_of(sources, month):
    found = sources["Invoice"].where(F.date_format("InvoiceDate", "yyyy-MM") == month).join(sources["Payment"].select("InvoiceID"), "InvoiceID", "left_semi")
    return sorted(r.InvoiceID for r in found.select("InvoiceID").collect())


def message_of(warehouse, table):
    rows = warehouse.audit().where(F.col("TargetTable") == table).where("OperationType = 'Partition'").orderBy(F.desc("LogID"))
    return rows.first().Message


def test_a_member_that_moves_comes_back_or_has_no_day_stays_one_row(spark):
    dim = scd.Dimension("D", "K", ("N",), ("S", "Day"), "overwrite")
    make = lambda *rows: spark.createDataFrame(list(rows), "N string, S string, Day string").withColumn("Day", F.col("Day").cast("date"))
    states = [
        make(("a", "x", "2024-01-03"), ("b", "x", "2024-02-01"), ("c", "x", None)),
        make(("a", "x", "2024-01-03"), ("c", "y", None)),  # b goes
        make(("a", "x", "2024-03-09"), ("b", "z", "2024-04-01"), ("c", "y", "2024-01-05"), ("e", None, None)),  # a moves, b is back elsewhere
        make(),
    ]
    current, seen = period.laid_out(scd.first_load(states[0], dim, "2024-01-01"), "Day"), period.member_signatures(states[0], dim, "Day")
    whole = current.drop(period.MONTH)
    for source in states[1:]:
        months = period.batch_months(seen, now := period.member_signatures(source, dim, "Day"))
        rows, touched = period.update_members(current, source, dim, "Day", "2024-01-02", months)
        current = current.where(~F.col(period.MONTH).isin(touched)).unionByName(rows.drop(scd.CHANGE))
        whole, seen = scd.update(whole, source, dim, "2024-01-02").drop(scd.CHANGE), now
        assert rows_of(current.drop(period.MONTH)) == rows_of(whole)
    assert period.batch_months(seen, seen) == []
    with pytest.raises(ValueError):
        period.update_members(current, states[0], scd.Dimension("D", "K", ("N",), ("S", "Day"), "versioned"), "Day", "2024-01-02", [202401])


def test_many_small_directories_become_one_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "PIECES", 3)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    rows = lambda value, *months: spark.createDataFrame([(m, value) for m in months], "SourceMonth int, v int")
    warehouse.replace("p", "t", rows(0, 1, 2, 3), partition_by="SourceMonth")
    for value in range(1, 6):
        warehouse.replace_periods("p", "t", rows(value, 2).withColumn(scd.CHANGE, F.lit("updated")), [2], partition_by="SourceMonth")
        for w in (warehouse, Warehouse(spark, str(tmp_path / "w"))):
            assert sorted((r.SourceMonth, r.v) for r in w.table("t").collect()) == [(1, 0), (2, value), (3, 0)]
            assert len(w._locations["t"]) <= 3


def test_movements_by_signed_parts_give_the_rows_of_a_first_load(spark, small, tmp_path):
    before, now = corrected("port", spark, small)
    staged_calls = lambda x: Overlay(x, CargoOperation=x["CargoOperation"].join(x["PortCall"].select("PortCallID"), "PortCallID", "left_semi"))
    before, now = staged_calls(before), staged_calls(now)
    kind = F.when(F.col("ContainerID") % 50 == 1, F.col("ContainerTypeID") % 3 + 1).otherwise(F.col("ContainerTypeID")).cast("bigint")
    retyped = Overlay(now, Container=now["Container"].withColumn("ContainerTypeID", kind))
    quantity = F.when(F.col("PortCallID") % 7 == 1, F.col("Quantity") + 5).otherwise(F.col("Quantity"))
    changed = Overlay(retyped, CargoOperation=now["CargoOperation"].withColumn("Quantity", quantity.cast(now["CargoOperation"].schema["Quantity"].dataType)))
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run, name = Run(spark, warehouse, None, "1999-01-01", "1999-01-01 02:00:00"), "FactContainerMovementsAcc"
    night(run, before, "port", *FIRST)
    for sources, operation in ((now, "Replace"), (now, "Skip"), (retyped, "Replace"), (changed, "Replace"), (changed, "Skip"), (before, "Replace")):
        night(run, sources, "port", "staging", "facts_update")
        reader = Warehouse(spark, str(tmp_path / "w"))
        assert rows_of(reader.table(name)) == rows_of(port.container_movements(sources, _Published(warehouse)))
        assert operations(reader, name)[-1] == operation
        parts = additive.totals(reader.table(f"entries.{name}"), port.MOVED_BY, port.MOVED)
        assert rows_of(parts) == rows_of(reader.table(f"totals.{name}"))


def test_movement_parts_read_the_months_of_the_batch_only(spark, small, tmp_path):
    sources = Sources(spark, small)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run = Run(spark, warehouse, None, "1999-01-01", "1999-01-01 02:00:00")
    night(run, sources, "port", *FIRST)
    state = {part: warehouse.table(f"{part}.FactContainerMovementsAcc") for part in ("entries", "signatures", "types")}
    one = sources["CargoOperation"].where("year(OperationDateTime) = 1995 and month(OperationDateTime) = 4").first().CargoOpID
    night(run, Overlay(sources, CargoOperation=sources["CargoOperation"].where(F.col("CargoOpID") != one)), "port", "staging")
    delta = port.movement_deltas(state, _Staged(run, "port"), _Published(warehouse))
    plan = plan_of(delta)
    assert re.search(r"PartitionFilters: \[[^\]]*SourceMonth#\d+ (IN \(199504\)|= 199504)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(OperationDateTime,1995-04-01", plan)
    assert [r.SourceRows for r in delta.collect()] == [-1]


def test_parts_with_nulls_empty_tables_and_repeats(spark):
    make = lambda *rows: additive.entries(spark.createDataFrame(list(rows), "k int, g string, v int"), ["k"], ["g"], v=F.col("v"))
    keys, by, measures = ["k"], ["g"], ["v"]
    start, later = make((1, "a", 2), (1, "a", 2), (2, None, None), (None, "b", 4)), make((1, "a", 3), (None, "b", 4), (3, "b", -4))
    delta = additive.deltas(start, later, keys, by, measures)
    totals = additive.folded(additive.totals(start, by, measures), delta, by, measures)
    assert rows_of(totals) == rows_of(additive.totals(later, by, measures)) and totals.count() == 2
    assert additive.deltas(start.unionByName(delta), later, keys, by, measures).isEmpty()
    assert additive.totals(make(), by, measures).isEmpty() and additive.deltas(make(), make(), keys, by, measures).isEmpty()
