"""Lines recognised by reference keys: they meet the loaded keys where they meet their invoice."""

from dockside.operators import increment
from dockside.queries import registry


def test_lines_are_not_shuffled_by_reference_keys(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry()["fact_invoice_line_update_reference_keys"](spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert shuffles and not [line for line in shuffles if "NetAmount" in line.split("hashpartitioning(")[1].split(")")[0]]


def test_marked_rows_hide_what_the_anti_join_hides(spark):
    built = spark.sql("select * from values (1, 1, 'a'), (2, 1, 'b'), (3, 2, 'a'), (4, null, 'a'), (5, 1, null), (6, 1, 'a'), (7, 3, 'c') t(id, k, v)")
    current = spark.sql("select * from values (1, 'a'), (1, 'a'), (null, 'a'), (1, null), (3, 'c'), (9, 'z') t(k, v)")
    both = built.unionByName(current.selectExpr("*", "true as loaded"), allowMissingColumns=True)
    found = increment.unmarked(both, ["k", "v"], "loaded").select("id", "k", "v")
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in increment.unseen(current, built, ["k", "v"]).collect()) == [2, 3, 4, 5]
