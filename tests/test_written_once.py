"""Work that a query needs several times is done once, and small keys are shuffled in the place of whole rows."""

from pyspark.sql import functions as F

from dockside import queries
from dockside.operators import period, rejects, signature
from dockside.operators.rejects import Link, failed_links
from dockside.plans import finance
from dockside.sources import shared
from dockside.sources.adapter import Sources


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_links_that_hang_together_are_walked_by_distinct_keys(spark):
    rows = spark.createDataFrame([(f"r{i}", i % 3 if i % 5 else None, i % 2) for i in range(40)] + [("r1", 1, 1), (None, 7, 0)], "id string, p int, q int")
    tables = {
        "P": spark.createDataFrame([(0, 10, 1), (1, 11, 2), (1, 11, 2), (2, None, 3)], "k int, g int, e int"),
        "G": spark.createDataFrame([(10, 5), (11, 6)], "k int, h int"),
        "H": spark.createDataFrame([(5,)], "k int"),
        "Q": spark.createDataFrame([(1,)], "k int"),
    }
    links = (Link("p", "P", "k", ("g",)), Link("q", "Q", "k", built=True), Link("P_g", "G", "k", ("h",)), Link("G_h", "H", "k", built=True))
    found = failed_links(rows, "id", links, tables, tables, "other")

    def wanted(r):
        if r.p not in (0, 1, 2):
            return "P.k"
        if r.q != 1:
            return "Q.k"
        return {0: "other", 1: "H.k", 2: "G.k"}[r.p]

    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr((r.id, wanted(r))) for r in rows.collect())
    # the ids do not go along the chain: they are shuffled for the link of their own and once to meet its outcome
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(failed_links(rows, "id", links, tables, tables, "other")).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("Exchange hashpartitioning" in line and "[id#" in below for line, below in zip(lines, lines[1:])) <= 2


def test_rows_are_not_sought_by_parents_where_every_month_differs(spark):
    by = period.Period("Line", "L", "SourceL", "Day", "Head", "H")
    make = lambda rows, kind: spark.createDataFrame(rows, kind)
    heads = make([(1, "2024-01-03"), (2, "2024-02-03"), (3, None), (4, "2024-03-01")], "H int, Day string").selectExpr("H", "cast(Day as date) Day")
    lines = make([("a", 1), ("b", 1), ("c", 2), ("d", 3), ("e", 9), ("f", None), (None, 2), ("a", 1)], "L string, H int")
    s = {"Head": heads, "Line": lines}
    fact = lambda *rows: make(list(rows), f"{period.MONTH} int, SourceL string")
    all_differ = fact((202401, "a"))
    found = rejects.uncarried(all_differ, s, by, by.carried(all_differ))
    assert sorted(repr(r.L) for r in found.collect()) == sorted(map(repr, ["b", "c", "d", "e", "f", None]))
    assert "LeftSemi" not in plan_of(found)
    one_same = fact((202401, "a"), (202401, "b"), (202401, "a"))
    found = rejects.uncarried(one_same, s, by, by.carried(one_same))
    assert sorted(repr(r.L) for r in found.collect()) == sorted(map(repr, ["c", "d", "e", "f", None]))
    # signatures by month are those added up from signatures by parent
    months = heads.select("H", period.month_of("Day").alias(period.MONTH))
    added = signature.added(by.by_link(s).join(months, "H"), [period.MONTH])
    assert added.exceptAll(by.signatures(s)).isEmpty() and by.signatures(s).exceptAll(added).isEmpty()


def test_rejects_build_each_fact_and_dimension_once(spark, small, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "stored", lambda rows, name: written.append(name) or shared.stored(rows, name))
    found = queries.registry()["rejects_finance"](spark, small)
    assert len(written) == len(set(written)) and {"FactInvoiceLineTransaction", "FactCustomerPaymentTransaction", "DimInvoice", "DimCustomer"} <= set(written)
    assert "Window" not in plan_of(found)  # no dimension is numbered again for the links
    assert not found.isEmpty()


def test_signature_sums_are_those_of_long_decimals(spark):
    rows = spark.createDataFrame([(i % 3 or None, i) for i in range(500)], "k int, v long").unionByName(spark.range(1).selectExpr("9 k", "null v"))
    found = signature.signatures(rows, ["k"], ["v"])
    wanted = rows.groupBy("k").agg(F.count(F.lit(1)), F.sum(signature.row_hash(["v"]).cast("decimal(38,0)")), F.bit_xor(signature.row_hash(["v"])))
    assert found.schema["SignedSum"].dataType.simpleString() == "decimal(38,0)"
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, wanted.collect())))


def test_billing_inputs_are_found_once_a_night(spark, small, monkeypatch):
    built, inputs = [], finance.billing_inputs
    monkeypatch.setattr(finance, "billing_inputs", lambda s, d: built.append(1) or inputs(s, d))
    found = queries.registry()["fact_billing_snapshot_after_corrections"](spark, small)
    assert len(built) == 2 and not found.isEmpty()  # those published with the first load, and the night's


def test_invoices_are_not_shuffled_by_contract_number_or_customer(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(finance.invoice_lifecycle(Sources(spark, small), queries.Dimensions(spark, small, "finance")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_invoice = [line for line in plan.splitlines() if "Project" in line and "InvoiceNumber" in line]
    assert by_invoice and not any("ContractNumber" in line or "CustomerCode" in line for line in by_invoice)


def test_the_lifecycle_by_month_builds_the_first_load_once(spark, small, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "stored", lambda rows, name: written.append(name) or shared.stored(rows, name))
    found = queries.registry()["fact_invoice_lifecycle_by_month"](spark, small)
    assert len(written) == len(set(written)) and {"FactInvoiceLifecycleAccumulating", "DimInvoice"} <= set(written) and not found.isEmpty()
