"""What keeps shuffles and a task's memory small: links one by one, keys found at the parent, tables of a load written once."""

import re

from pyspark.sql import functions as F

from dockside.operators import quality
from dockside.operators.lookup import version_lists, version_lookup, version_on
from dockside.plans import port
from dockside.sources.warehouse import FolderWarehouse, MemoryWarehouse


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_task_of_the_referential_report_holds_one_link(spark):
    tables = {"C": spark.sql("select * from values (1, 2L, 'a'), (-1, 9L, null), (7, 9L, 'z') t(p, q, r)"), "P": spark.sql("select * from values (1L, 'a'), (2L, 'b') t(id, r)")}
    tables["Empty"] = tables["C"].limit(0)
    links = [("C", "p", "P", "id"), ("C", "q", "P", "id"), ("C", "r", "P", "r"), ("C", "p", "Empty", "p"), ("Empty", "q", "Empty", "q")]
    found = quality.referential_report(links, tables)
    assert sorted(tuple(r) for r in found.collect()) == [("C.p", 1, 1), ("C.p", 2, 2), ("C.q", 2, 1), ("C.r", 1, 1)]
    plan = _plan(found)
    assert "Generate" not in plan and not re.search(r"hashpartitioning\([^)]*ForeignKey#\d+, Value", plan)


def test_version_lists_find_what_the_lookup_finds(spark):
    dim = spark.sql("select code, sk, cast(s as date) s from values ('a', 1, '2024-01-05'), ('a', 2, '2024-02-01'), ('a', 3, '2024-02-01'), ('b', 4, '2024-03-01'), (null, 5, '2024-01-01') t(code, sk, s)")
    rows = spark.sql("select id, code, cast(d as date) d from values (1, 'a', '2023-01-01'), (2, 'a', '2024-01-31'), (3, 'a', '2024-02-01'), (4, 'b', '2024-02-01'), (5, 'b', null), (6, 'c', '2024-01-01'), (7, null, '2024-01-01') t(id, code, d)")
    wanted = {r.id: r.sk for r in version_lookup(rows, dim, "code", "d", "sk", "s").collect()}
    listed = rows.join(version_lists(dim, "code", "sk", "s"), "code").withColumn("sk", version_on("d")).where("sk is not null")
    assert {r.id: r.sk for r in listed.collect()} == wanted == {1: 1, 2: 1, 3: 3, 4: 4}


def test_cargo_rows_are_not_shuffled_by_ship(spark, small):
    from dockside.queries import Dimensions
    from dockside.sources.adapter import Sources

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(port.cargo_operations(Sources(spark, small), Dimensions(spark, small, "port")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for line, below in zip(plan.splitlines(), plan.splitlines()[1:]):
        assert not ("hashpartitioning(ShipID" in line and "WeightKG" in below)
    assert "WeightKG" in plan


def test_a_folder_warehouse_builds_a_table_once(spark):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda v: seen.add(1) or v, "long").asNondeterministic()
    for kind, times in ((FolderWarehouse, 10), (MemoryWarehouse, 20)):
        warehouse, start = kind(), seen.value
        warehouse.replace("p", "t", spark.range(10).select(count("id").alias("id")))
        assert [sorted(r.id for r in warehouse.table("t").collect()) for _ in range(2)] == [list(range(10))] * 2
        assert seen.value - start == times
