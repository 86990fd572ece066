"""Rows that find no dimension: every staged row is carried by its fact or rejected with a named link, and taken up again."""

import pytest
from pyspark.sql import functions as F

from dockside.operators.rejects import Link, failed_links
from dockside.plans import finance, port
from dockside.plans.loads import Run, run_load
from dockside.sources.adapter import Sources
from dockside.sources.overlay import Overlay
from dockside.sources.warehouse import Warehouse


def test_the_first_missing_link_is_named_once_a_row(spark):
    rows = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, None), (5, 99), (5, 99)], "id int, p int")
    parents = spark.createDataFrame([(10, 1), (10, 1), (20, 2), (30, None)], "k int, g int")
    tables = {"P": parents, "G": spark.createDataFrame([(1,), (None,)], "k int")}
    links = (Link("p", "P", "k", ("g",)), Link("P_g", "G", "k", built=True))
    found = sorted(tuple(r) for r in failed_links(rows, "id", links, tables, tables, "other").collect())
    assert found == [("1", "other"), ("2", "G.k"), ("3", "G.k"), ("4", "P.k"), ("5", "P.k"), ("5", "P.k")]
    assert failed_links(rows.limit(0), "id", links, tables, tables, "other").isEmpty()


@pytest.mark.parametrize("area,module,lost,key", [("finance", finance, "Contract", "ContractID"), ("port", port, "Voyage", "VoyageID")])
def test_staged_rows_are_published_or_rejected(spark, small, tmp_path, area, module, lost, key):
    sources = Sources(spark, small)
    fewer = Overlay(sources, **{lost: sources[lost].where(F.col(key) % 7 != 3)})
    if area == "finance":  # payments of invoices that nobody has
        invoice = F.when(F.hash("PaymentID") % 50 == 1, F.lit(10**9).cast("bigint")).otherwise(F.col("InvoiceID"))
        fewer = Overlay(fewer, Payment=sources["Payment"].withColumn("InvoiceID", invoice))
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run = Run(spark, warehouse, fewer, "1999-01-01", "1999-01-01 02:00:00")
    for phase in ("staging", "dimensions_first", "facts_first"):
        run_load(f"{area}_{phase}", run)
    for name, by in module.PERIODS.items():
        held, published, refused = (t.count() for t in (fewer[by.table], warehouse.table(name), warehouse.table(f"rejects.{name}")))
        assert held == published + refused and refused > 0
        links = {r.FailedLink for r in warehouse.table(f"rejects.{name}").select("FailedLink").distinct().collect()}
        assert f"{lost}.{key}" in links and "unexplained" not in links
        assert ("Invoice.InvoiceID" in links) == (by.table == "Payment")
    # the parents come: the rejected rows are taken up, and nothing is left
    run.sources = sources
    for phase in ("staging", "dimensions_update", "facts_update"):
        run_load(f"{area}_{phase}", run)
    for name, by in module.PERIODS.items():
        assert warehouse.table(name).select(by.loaded_as).exceptAll(sources[by.table].select(by.source_id)).isEmpty()
        assert warehouse.table(name).count() == sources[by.table].count() and warehouse.table(f"rejects.{name}").isEmpty()
