"""What the plans look like when nothing is small enough to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from dockside.operators import quality, reconcile, report
from dockside.operators.lookup import as_of, version_lookup
from dockside.plans import hr
from dockside.plans.loads import Run, run_load
from dockside.queries import registry
from dockside.sources.adapter import Sources
from dockside.sources.warehouse import Warehouse


@pytest.fixture
def large(spark):
    """Settings under which every join shuffles and a partition of some kilobytes counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def single_task_windows(plan):
    lines = plan.splitlines()
    return [lines[i] for i, line in enumerate(lines) if re.search(r"\bWindow \[", line) and "SinglePartition" in "".join(lines[i : i + 3])]


@pytest.mark.parametrize(
    "name",
    ["dim_customer_update", "dim_contract_update", "fact_invoice_line_update", "fact_billing_snapshot_first", "fact_salary_payment_first",
     "fact_cargo_operation_update", "fact_port_call_snapshot_update", "fact_monthly_performance_update"],
)
def test_no_loop_joins_and_no_single_task_windows(large, small, name):
    plan = plan_of(registry()[name](large, small))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastExchange" not in plan
    assert not single_task_windows(plan)


def _hot_rows(spark, n=90000):
    """A third of the rows share one customer."""
    code = F.when(F.col("id") % 3 == 0, F.lit("C0")).otherwise(F.concat(F.lit("C"), F.col("id") % 997))
    return spark.range(0, n, 1, 8).select("id", code.alias("code"), F.expr("date_add(date'2024-01-01', cast(id % 50 as int))").alias("d"), F.md5(F.col("id").cast("string")).alias("payload"))


def test_hot_key_is_split_in_version_lookup(large):
    dim = large.range(997).selectExpr("concat('C', id) as code", "id as sk", "date'2024-01-10' as StartDate")
    joined = version_lookup(_hot_rows(large), dim, "code", "d", "sk")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 90000


def test_hot_key_is_split_in_a_plain_lookup(large):
    dim = large.range(997).selectExpr("concat('C', id) as code", "id as sk")
    assert "skew=true" in final_plan(_hot_rows(large).join(dim, "code"))


def test_hot_key_collapses_before_the_as_of_window(large):
    history = large.range(3000).selectExpr("concat('C', id % 997) as code", "date_add(date'2023-12-01', cast(id % 60 as int)) as since", "id as h")
    found = as_of(_hot_rows(large), history, "code", "d", "since", "h", ["h"])
    plan = plan_of(found)
    window = plan[plan.index("Window [") :]
    # below the window both inputs are aggregated to one entry per key and day, partly before they are shuffled
    assert window.count("HashAggregate") + window.count("ObjectHashAggregate") + window.count("SortAggregate") >= 4
    assert found.count() == 90000


def test_filters_and_columns_reach_the_staged_files(spark, small, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run = Run(spark, warehouse, Sources(spark, small), "2024-01-02")
    run_load("hr_staging", run)
    run_load("hr_dimensions_first", run)
    tables = {name.removeprefix("hr."): table for name, table in warehouse.tables().items()}
    current = hr.attendance(tables, tables)
    plan = plan_of(hr.update_attendance(current, tables, tables, "2024-01-15", "2024-01-31"))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(AttendanceDate,2024-01-31\)", plan)
    assert "HoursWorked" not in plan


def test_ordered_reports_limit_before_they_shuffle(spark):
    rows = spark.range(0, 5000, 1, 8).selectExpr("id", "id % 7 as k", "md5(string(id)) as v")
    top = report.top_rows(rows, 5, F.desc("v"), "id")
    assert "TakeOrderedAndProject" in plan_of(top)
    assert [r.v for r in top.collect()] == sorted((r.v for r in rows.collect()), reverse=True)[:5]
    by = report.top_by(rows, ["k"], 3, "v", "id")
    plan = plan_of(by)
    assert plan.count("WindowGroupLimit") == 2 and by.count() == 21


def test_reconciliation_reads_only_the_buckets_that_differ(spark, monkeypatch):
    source = spark.range(0, 3000, 1, 4).selectExpr("cast(id as int) as id", "cast(id as decimal(9,2)) as amount", "if(id % 5 = 0, null, string(id)) as name")
    staged = source.selectExpr("cast(id as bigint) as id", "cast(amount as decimal(18,4)) as amount", "name", "current_date() as LoadDate")
    assert reconcile.reconcile(source, staged, ["id"]).isEmpty() and reconcile.bucket_differences(source, staged, ["id"]).isEmpty()
    other = staged.where("id not in (10, 11)").withColumn("name", F.expr("if(id = 15, '15', name)")).unionByName(staged.where("id = 20"))
    assert reconcile.bucket_differences(source, other, ["id"]).count() <= 4
    found = reconcile.reconcile(source, other, ["id"])
    assert sorted(tuple(r) for r in found.collect()) == [(10, "missing in staging", 1, 0), (11, "missing in staging", 1, 0), (15, "different", 1, 1), (20, "different", 1, 2)]
    assert reconcile.reconcile(other, source, ["id"]).where("Difference = 'not at the source'").count() == 2


def test_all_references_meet_in_one_shuffle(spark):
    tables = {
        "Child": spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (2, None, "b"), (-1, 7, None), (9, 9, "z")], "p int, q long, r string"),
        "P": spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long"),
        "R": spark.createDataFrame([("a",), ("b",)], "r string"),
    }
    found = quality.referential_report([("Child", "p", "P", "id"), ("Child", "q", "P", "id"), ("Child", "r", "R", "r")], tables)
    assert sorted(tuple(r) for r in found.collect()) == [("Child.p", 1, 1), ("Child.q", 4, 4), ("Child.r", 1, 1)]
    assert "Join" not in plan_of(found)
