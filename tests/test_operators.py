"""Operators against small hand-made rows and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dockside.functions.dates import month_boundaries, week_of_year
from dockside.operators import calendar as cal, increment, quality, scd
from dockside.operators.keys import assign_dense_keys, assign_keys
from dockside.operators.lookup import as_of, interval_lookup, version_lookup

D = dt.date


def day(text):
    return dt.date.fromisoformat(text)


PERSON = scd.Dimension("Person", "PersonKey", ("ID",), ("Name", "City"), "versioned", tracked=("City",), end_offset_days=-1)
PERSON_SCHEMA = "ID int, Name string, City string"


def people(spark, *rows):
    return spark.createDataFrame(rows, PERSON_SCHEMA)


def settle(df):
    """Plain local copy, so a next load starts from data instead of a growing plan."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_keys_do_not_depend_on_partitioning(spark):
    rows = spark.range(20000).select((F.col("id") * 7 % 1000003).alias("ID"))
    first = {r.ID: r.K for r in assign_keys(rows.repartition(3), ["ID"], "K").collect()}
    second = {r.ID: r.K for r in assign_keys(rows.repartition(11).orderBy(F.desc("ID")), ["ID"], "K").collect()}
    assert first == second
    assert len(set(first.values())) == 20000 and min(first.values()) >= 1
    assert max(first.values()) < 4 * 20000
    dense = sorted(r.K for r in assign_dense_keys(rows, ["ID"], "K", 5).collect())
    assert dense == list(range(6, 20006))


def test_versions_open_close_and_repeat(spark):
    state = settle(scd.first_load(people(spark, (1, "Ann", "Oslo"), (2, "Bo", None)), PERSON, "2024-01-01"))
    staged = people(spark, (1, "Ann", "Rome"), (2, "Bo", "Kyiv"), (3, "Cy", "Lima"))
    nxt = settle(scd.update(state, staged, PERSON, "2024-02-01"))
    rows = {(r.ID, r.StartDate): r for r in nxt.collect()}
    assert rows[1, D(2024, 1, 1)].EndDate == D(2024, 1, 31) and not rows[1, D(2024, 1, 1)].IsCurrent
    assert rows[1, D(2024, 2, 1)].City == "Rome" and rows[1, D(2024, 2, 1)].IsCurrent
    assert rows[2, D(2024, 2, 1)].City == "Kyiv"  # NULL -> value is a change
    assert rows[3, D(2024, 2, 1)].ChangeType == "inserted"
    old = {r.ID: r.PersonKey for r in state.collect()}
    assert rows[1, D(2024, 1, 1)].PersonKey == old[1]
    keys = [r.PersonKey for r in nxt.collect()]
    assert len(keys) == len(set(keys))
    again = scd.update(nxt.drop("ChangeType"), staged, PERSON, "2024-02-01")
    assert {r.ChangeType for r in again.collect()} == {"kept"} and again.count() == nxt.count()


def test_second_change_on_one_day_rewrites_the_open_version(spark):
    state = settle(scd.first_load(people(spark, (1, "Ann", "Oslo")), PERSON, "2024-01-01"))
    once = settle(scd.update(state, people(spark, (1, "Ann", "Rome")), PERSON, "2024-02-01").drop("ChangeType"))
    twice = scd.update(once, people(spark, (1, "Ann", "Kyiv")), PERSON, "2024-02-01").collect()
    assert len(twice) == 2 and all(r.EndDate is None or r.EndDate >= r.StartDate for r in twice)
    assert [r.City for r in twice if r.IsCurrent] == ["Kyiv"]


def test_random_histories_keep_one_current_version_and_disjoint_intervals(spark):
    rng = random.Random(7)
    state = None
    for run in range(4):
        run_date = f"2024-0{run + 1}-01"
        staged = people(spark, *[(i, f"P{i}", rng.choice(["a", "b", "", None])) for i in range(40 + run * 5)])
        step = scd.first_load(staged, PERSON, run_date) if state is None else scd.update(state, staged, PERSON, run_date).drop("ChangeType")
        state = settle(step)
    by_id = {}
    for r in state.collect():
        by_id.setdefault(r.ID, []).append(r)
    assert len(by_id) == 55
    for versions in by_id.values():
        versions.sort(key=lambda r: r.StartDate)
        assert [v.IsCurrent for v in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a.EndDate < b.StartDate for a, b in zip(versions, versions[1:]))


def test_previous_value_shifts_only_on_its_own_change(spark):
    dim = scd.Dimension("C", "K", ("ID",), ("Status", "Ends"), "previous_value", tracked=("Status", "Ends"), chain=("Status", "Prev1", "Prev2"))
    make = lambda *rows: spark.createDataFrame(rows, "ID int, Status string, Ends date")
    state = settle(scd.first_load(make((1, "Expired", None)), dim, "2024-01-01"))
    state = settle(scd.update(state, make((1, "Active", None)), dim, "2024-01-02").drop("ChangeType"))
    state = settle(scd.update(state, make((1, "Active", day("2025-01-01"))), dim, "2024-01-03").drop("ChangeType"))
    row = state.first()
    assert (row.Status, row.Prev1, row.Prev2, row.Ends) == ("Active", "Expired", None, D(2025, 1, 1))
    row = scd.update(state, make((1, "Closed", day("2025-01-01"))), dim, "2024-01-04").first()
    assert (row.Status, row.Prev1, row.Prev2) == ("Closed", "Active", "Expired")


def test_overwrite_blank_rule_and_unknown_member(spark):
    dim = scd.Dimension("D", "K", ("ID",), ("Name",), "overwrite", null_equals_blank=True, unknown=dict(ID=-1, Name="Unknown"))
    make = lambda *rows: spark.createDataFrame(rows, "ID int, Name string")
    state = settle(scd.first_load(make((1, None), (2, "x")), dim, "2024-01-01"))
    assert {r.K for r in state.where("ID = -1").collect()} == {-1}
    changes = {r.ID: (r.Name, r.ChangeType) for r in scd.update(state, make((1, ""), (2, "y"), (3, "z")), dim, "2024-01-02").collect()}
    assert changes == {-1: ("Unknown", "kept"), 1: (None, "kept"), 2: ("y", "updated"), 3: ("z", "inserted")}


@pytest.mark.parametrize("hot", [False, True])
def test_as_of_matches_brute_force(spark, hot):
    rng = random.Random(3)
    key = lambda: 0 if hot and rng.random() < 0.4 else rng.randrange(12)
    start = D(2024, 1, 1)
    history = [(i, key(), start + dt.timedelta(rng.randrange(60)), rng.choice(["a", "b", None])) for i in range(150)]
    rows = [(i, rng.choice([key(), None]), start + dt.timedelta(rng.randrange(-5, 70))) for i in range(400)]
    found = as_of(
        spark.createDataFrame(rows, "id int, k int, d date"), spark.createDataFrame(history, "h int, k int, since date, v string"),
        "k", "d", "since", "h", ["h", "v"],
    ).collect()
    assert len(found) == len(rows)
    for r in found:
        options = [x for x in history if x[1] == r.k and x[2] <= r.d] if r.k is not None else []
        best = max(options, key=lambda x: (x[2], x[0]), default=(None, None, None, None))
        assert (r.h, r.v) == (best[0], best[3])


def test_version_and_interval_lookup(spark):
    dim = spark.createDataFrame(
        [("a", 1, day("2024-01-10"), day("2024-01-20")), ("a", 2, day("2024-01-20"), None)], "code string, sk int, StartDate date, EndDate date"
    )
    rows = spark.createDataFrame([(day("2024-01-01"), "a"), (day("2024-01-15"), "a"), (day("2024-01-20"), "a"), (day("2024-02-01"), "b")], "d date, code string")
    picked = {r.d: r.sk for r in version_lookup(rows, dim, "code", "d", "sk", how="left").collect()}
    assert picked == {D(2024, 1, 1): 1, D(2024, 1, 15): 1, D(2024, 1, 20): 2, D(2024, 2, 1): None}
    strict = sorted((str(r.d), r.sk) for r in interval_lookup(rows, dim, "code", "d", "sk").collect())
    assert strict == [("2024-01-15", 1), ("2024-01-20", 1), ("2024-01-20", 2)]


def test_calendar(spark):
    days = {str(r.FullDate): r for r in cal.calendar(cal.fixed_span(spark, "2022-12-31", "2024-12-31")).collect()}
    assert days["2023-01-01"].WeekOfYear == 1 and days["2023-01-02"].WeekOfYear == 2
    assert days["2023-01-01"].DayName == "Sunday" and days["2023-01-01"].IsWeekend and days["2023-01-01"].DayOfWeek == 7
    assert [days["2022-12-31"].DimDateID, days["2023-01-01"].DimDateID] == [1, 2]
    current = cal.calendar(cal.fixed_span(spark, "2024-01-01", "2024-01-03"))
    added = [(str(r.FullDate), r.DimDateID) for r in cal.extend_calendar(current, "2024-01-05").orderBy("FullDate").collect()]
    assert added == [("2024-01-04", 4), ("2024-01-05", 5)]
    assert cal.extend_calendar(current, "2024-01-02").count() == 0
    assert [str(r.FullDate) for r in cal.extend_calendar(current.limit(0), "2024-01-02").collect()] == ["2024-01-02"]


def test_boundary_arithmetic(spark):
    row = spark.range(1).select(
        month_boundaries(F.lit("2024-01-31").cast("date"), F.lit("2024-02-01").cast("date")).alias("m"),
        week_of_year(F.lit("2023-01-01").cast("date"), "sunday").alias("w"),
    ).first()
    assert (row.m, row.w) == (1, 1)


def test_validation_reports_and_refuses(spark):
    rows = spark.createDataFrame([(1, "x"), (1, " "), (2, None)], "ID int, Name string")
    with pytest.raises(quality.ValidationError) as refused:
        quality.enforce("T", quality.validation_report(rows, ["ID"], ["ID", "Name"], ["Name"]))
    assert set(refused.value.failures) == {("missing", "Name", 2), ("duplicate_keys", "ID", 1)}
    assert quality.enforce("T", quality.validation_report(rows, ["ID", "Name"], ["ID"])) == 3
    parents = spark.createDataFrame([(1,)], "ID int")
    assert [r.ID for r in quality.orphans(rows, parents, "ID").collect()] == [2]


def test_increment_techniques(spark):
    make = lambda *rows: spark.createDataFrame(rows, "k int, v int")
    current = make((1, 10), (2, 20))
    assert sorted((r.k, r.ChangeType) for r in increment.append_unseen(current, make((2, 99), (3, 30)), ["k"]).collect()) == [(1, "kept"), (2, "kept"), (3, "inserted")]
    merged = sorted((r.k, r.v, r.ChangeType) for r in increment.merge(current, make((2, 21), (3, 30)), ["k"], ["v"]).collect())
    assert merged == [(1, 10, "kept"), (2, 21, "updated"), (3, 30, "inserted")]
    replaced = sorted((r.k, r.v) for r in increment.replace_period(current, make((2, 22), (2, 23)), "k", make((2, 0))).collect())
    assert replaced == [(1, 10), (2, 22), (2, 23)]
    assert increment.replace_period(current, make(), "k", make()).drop("ChangeType").exceptAll(current).isEmpty()
    assert increment.replace_period(current, make(), "k", make()).count() == current.count()  # a period without a known day drops nothing
    dated = spark.createDataFrame([(day(f"2024-01-0{i}"),) for i in range(1, 6)], "d date")
    assert [str(r.d) for r in increment.in_window(dated, "d", "2024-01-02", "2024-01-04").collect()] == ["2024-01-03", "2024-01-04"]
