"""HR mart: 5 dimensions besides the calendar, 6 facts (the yearly headcount is optional)."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from dockside.functions.dates import month_boundaries, year_boundaries
from dockside.operators import increment, signature
from dockside.operators.lookup import as_of, date_keys, interval_lookup, key_lookup
from dockside.operators.period import MONTH, Period, month_of
from dockside.operators.scd import CHANGE, Dimension
from dockside.sources.overlay import Overlay

PAY = "decimal(15,2)"
HOURS = "decimal(10,2)"

# Fixed values
EMPLOYER_CONTRIBUTION_RATE = "0.23"
VOLUNTARY_REASONS = ("Resignation", "Retirement")
STANDARD_DAY_HOURS = 8

DIMENSIONS = {
    dim.name: dim
    for dim in [
        Dimension(
            "DimDepartment", "DepartmentKey", ("DepartmentID",), ("DepartmentName", "ManagerName", "IsActive"), "overwrite",
            unknown=dict(DepartmentID=-1, DepartmentName="Unknown", ManagerName="Unknown", IsActive=False),
        ),
        Dimension(
            "DimJobTitle", "JobTitleKey", ("JobTitleID",), ("JobTitleName", "CurrentJobCategory"), "previous_value",
            tracked=("CurrentJobCategory",), chain=("CurrentJobCategory", "PreviousJobCategory"), null_equals_blank=True,
            unknown=dict(JobTitleID=-1, JobTitleName="Unknown", CurrentJobCategory="Unknown", PreviousJobCategory="Unknown"),
        ),
        Dimension(
            "DimLeaveType", "LeaveTypeKey", ("LeaveTypeID",), ("LeaveTypeName", "IsPaid"), "insert_only",
            unknown=dict(LeaveTypeID=-1, LeaveTypeName="Unknown", IsPaid=False),
        ),
        Dimension(
            "DimTerminationReason", "TerminationReasonKey", ("TerminationReason",), (), "insert_only", unknown=dict(TerminationReason="Unknown")
        ),
        Dimension(
            "DimEmployee", "EmployeeKey", ("EmployeeID",),
            ("FullName", "Gender", "MaritalStatus", "Position", "Address", "Phone", "EmploymentStatus"), "versioned",
            tracked=("Position", "Address", "Phone", "MaritalStatus", "EmploymentStatus"), first_start="HireDate", null_equals_blank=True,
            unknown=dict(
                EmployeeID=-1, FullName="Unknown", Gender="N/A", MaritalStatus="N/A", Position="Unknown", Address="Unknown", Phone="Unknown",
                EmploymentStatus="Unknown", StartDate=dt.date(1900, 1, 1), EndDate=dt.date(9999, 12, 31), IsCurrent=False,
            ),
        ),
    ]
}


def dimension_source(name: str, s) -> DataFrame:
    if name == "DimDepartment":
        managers = s["Employee"].select(F.col("EmployeeID").alias("ManagerID"), F.col("FullName").alias("ManagerName"))
        return s["Department"].join(managers, "ManagerID", "left")
    if name == "DimJobTitle":
        return s["JobTitle"].withColumnRenamed("JobCategory", "CurrentJobCategory")
    if name == "DimTerminationReason":
        return s["Termination"].select("TerminationReason").where("TerminationReason is not null").distinct()
    return s[name.removeprefix("Dim")]


def _history_as_of(rows, s, day, values):
    return as_of(rows, s["EmploymentHistory"], "EmployeeID", day, "StartDate", "EmploymentHistoryID", values)


def _on_day(rows, d, day, key):
    return rows.join(date_keys(d["DimDateHR"], "DateKey", **{day: key})[day], day)


def terminations(s, d) -> DataFrame:
    """Transaction fact: who left, when, after how long, at what pay."""
    first_hire = s["EmploymentHistory"].groupBy("EmployeeID").agg(F.min("StartDate").alias("_hired"))
    rows = interval_lookup(s["Termination"], d["DimEmployee"], "EmployeeID", "TerminationDate", "EmployeeKey")
    rows = _history_as_of(_on_day(rows, d, "TerminationDate", "TerminationDateKey"), s, "TerminationDate", ["DepartmentID", "JobTitleID", "Salary"])
    rows = rows.join(first_hire, "EmployeeID", "left")
    for name, column, key in [
        ("DimDepartment", "DepartmentID", "DepartmentKey"),
        ("DimJobTitle", "JobTitleID", "JobTitleKey"),
        ("DimTerminationReason", "TerminationReason", "TerminationReasonKey"),
    ]:
        rows = key_lookup(rows, d[name], column, key, "left", unknown=True)
    zero = F.lit(0)
    return rows.select(
        F.col("TerminationID").alias("SourceTerminationID"), "TerminationDateKey", "EmployeeKey", "DepartmentKey", "JobTitleKey", "TerminationReasonKey",
        F.coalesce(F.date_diff("TerminationDate", "_hired"), zero).alias("TenureInDays"),
        F.coalesce(month_boundaries("_hired", "TerminationDate"), zero).alias("TenureInMonths"),
        F.coalesce(F.col("Salary"), zero).cast(PAY).alias("SalaryAtTermination"),
        F.coalesce(F.col("TerminationReason").isin(*VOLUNTARY_REASONS), F.lit(False)).alias("IsVoluntary"),
    )


def salary_payments(s, d, month: bool = False) -> DataFrame:
    """Transaction fact: gross, net and employer cost per payment. ``month`` adds the payment's, to lay the fact out by."""
    rows = interval_lookup(s["SalaryPayment"], d["DimEmployee"], "EmployeeID", "PaymentDate", "EmployeeKey")
    rows = _history_as_of(_on_day(rows, d, "PaymentDate", "PaymentDateKey"), s, "PaymentDate", ["DepartmentID", "JobTitleID"])
    rows = key_lookup(rows, d["DimDepartment"], "DepartmentID", "DepartmentKey", "left", unknown=True)
    rows = key_lookup(rows, d["DimJobTitle"], "JobTitleID", "JobTitleKey", "left", unknown=True)
    bonus = F.coalesce(F.col("Bonus"), F.lit(0))
    gross = F.col("Amount") + bonus
    return rows.select(
        F.col("SalaryPaymentID").alias("SourceSalaryPaymentID"), "PaymentDateKey", "EmployeeKey", "DepartmentKey", "JobTitleKey",
        gross.cast(PAY).alias("GrossPayAmount"),
        F.col("Amount").cast(PAY).alias("BaseAmount"),
        bonus.cast(PAY).alias("BonusAmount"),
        F.coalesce(F.col("Deductions"), F.lit(0)).cast(PAY).alias("DeductionsAmount"),
        F.col("NetAmount").cast(PAY).alias("NetAmount"),
        (gross * F.lit(EMPLOYER_CONTRIBUTION_RATE).cast("decimal(5,2)") + gross).cast(PAY).alias("SalaryCostToCompany"),
        *([month_of("PaymentDate").alias(MONTH)] if month else []),
    )


def attendance(s, d, month: bool = False) -> DataFrame:
    """Factless fact with a status, for the last employee version started by that day; -1 where there is none. ``month`` adds the day's."""
    rows = as_of(s["Attendance"], d["DimEmployee"], "EmployeeID", "AttendanceDate", "StartDate", "EmployeeKey", ["EmployeeKey"])
    return _on_day(rows, d, "AttendanceDate", "AttendanceDateKey").select(
        F.col("AttendanceID").alias("SourceAttendanceID"), "AttendanceDateKey",
        F.coalesce("EmployeeKey", F.lit(-1)).alias("EmployeeKey"), F.col("Status").alias("AttendanceStatus"),
        *([month_of("AttendanceDate").alias(MONTH)] if month else []),
    )


def _monthly_hours(attendance_rows: DataFrame) -> DataFrame:
    hours = F.coalesce(F.col("HoursWorked"), F.lit(0))
    return attendance_rows.groupBy("EmployeeID", F.last_day("AttendanceDate").alias("MonthEndDate")).agg(
        F.sum(hours).alias("_hours"),
        F.count(F.lit(1)).alias("_rows"),
        F.min("HoursWorked").alias("_min"),
        F.max("HoursWorked").alias("_max"),
        F.count(F.when(F.col("Status") == "Late", 1)).alias("LateDaysCount"),
        F.count(F.when(F.col("Status") == "Absent", 1)).alias("AbsentDaysCount"),
        F.count("AttendanceID").alias("WorkDaysCount"),
    )


def _performance_columns(rows, d, s):
    rows = _history_as_of(_on_day(rows, d, "MonthEndDate", "MonthDateKey"), s, "MonthEndDate", ["DepartmentID"])
    rows = key_lookup(rows, d["DimDepartment"], "DepartmentID", "DepartmentKey", "left", unknown=True)
    hours = F.col("_hours")
    overtime = F.when(hours > 0, (hours - F.col("WorkDaysCount") * STANDARD_DAY_HOURS) / F.when(hours > 0, hours)).otherwise(F.lit(0))
    return rows.select(
        "MonthDateKey", "EmployeeKey", "DepartmentKey",
        hours.cast(HOURS).alias("TotalHoursWorked"),
        (hours / F.col("_rows")).cast(HOURS).alias("AverageDailyHoursWorked"),
        F.col("_min").cast(HOURS).alias("MinDailyHoursWorked"),
        F.col("_max").cast(HOURS).alias("MaxDailyHoursWorked"),
        "LateDaysCount", "AbsentDaysCount", "WorkDaysCount",
        overtime.cast("decimal(18,4)").alias("OvertimeAsPercentage"),
    )


def monthly_performance(s, d) -> DataFrame:
    """Periodic snapshot per employee and month end; aggregated before any dimension is looked up. The employee version is
    the last one started by the month's end, -1 where there is none."""
    hours = _monthly_hours(s["Attendance"])
    rows = as_of(hours, d["DimEmployee"], "EmployeeID", "MonthEndDate", "StartDate", "EmployeeKey", ["EmployeeKey"])
    return _performance_columns(rows.withColumn("EmployeeKey", F.coalesce("EmployeeKey", F.lit(-1))), d, s)


def _latest_terminations(s) -> DataFrame:
    """One termination per employee, the latest, so a repeated leaver cannot multiply rows."""
    newest = F.max_by(F.struct("TerminationDate", "TerminationReason"), F.struct("TerminationDate", "TerminationID"))
    return s["Termination"].groupBy("EmployeeID").agg(newest.alias("_t")).select("EmployeeID", "_t.*")


def _trainings(s) -> DataFrame:
    return s["EmployeeTraining"].groupBy("EmployeeID").agg(F.count(F.lit(1)).alias("_trainings"), F.max("TrainingDate").alias("LastTrainingDate"))


def employee_lifecycle(s, d) -> DataFrame:
    """Accumulating snapshot, one row per current employee version; an employee still here has no termination date."""
    career = s["EmploymentHistory"].groupBy("EmployeeID").agg(
        F.min("StartDate").alias("_hired"),
        (F.count(F.lit(1)) - 1).alias("_promotions"),
        F.max_by("Salary", F.struct("StartDate", "EmploymentHistoryID")).alias("_salary"),
    )
    current = d["DimEmployee"].where("IsCurrent").select("EmployeeID", "EmployeeKey")
    rows = s["Employee"].select("EmployeeID", "HireDate").join(current, "EmployeeID")
    for part in (career, _trainings(s), _latest_terminations(s)):
        rows = rows.join(part, "EmployeeID", "left")
    roles = dict(HireDate="HireDateKey", TerminationDate="TerminationDateKey", LastTrainingDate="LastTrainingDateKey")
    for day, lookup in date_keys(d["DimDateHR"], "DateKey", **roles).items():
        rows = rows.join(lookup, day, "left")
    rows = rows.join(d["DimTerminationReason"].select("TerminationReason", "TerminationReasonKey"), "TerminationReason", "left")
    unknown, left = F.lit(-1).cast("bigint"), F.col("TerminationDate").isNotNull()
    days = F.when(F.col("TerminationDate") > F.col("_hired"), F.date_diff("TerminationDate", "_hired"))
    return rows.select(
        "EmployeeKey",
        F.coalesce("HireDateKey", unknown).alias("HireDateKey"),
        F.when(left, F.coalesce("TerminationDateKey", unknown)).alias("TerminationDateKey"),
        F.coalesce("LastTrainingDateKey", unknown).alias("LastTrainingDateKey"),
        F.when(left, F.coalesce("TerminationReasonKey", unknown)).alias("TerminationReasonKey"),
        days.alias("DaysToTermination"),
        F.coalesce(F.col("_promotions"), F.lit(0)).alias("TotalPromotionsCount"),
        F.coalesce(F.col("_trainings"), F.lit(0)).alias("TotalTrainingsCompleted"),
        F.col("_salary").cast(PAY).alias("FinalSalary"),
    )


def yearly_headcount(s, d, last_year: int) -> DataFrame:
    """Periodic snapshot per year and department.

    Each stay in a department is expanded to the years it touches, from the first hire year on, and everything
    is aggregated from there; no year ever sees another year's rows.
    """
    people = s["Employee"].select("EmployeeID", "HireDate", "BirthDate")
    first_year = people.agg(F.min(F.year("HireDate"))).scalar()
    year_ends = d["DimDateHR"].where(f"Month = 12 and Day = 31 and Year <= {int(last_year)}").select("Year", F.col("DateKey").alias("YearDateKey"))
    departments = d["DimDepartment"].where("DepartmentKey <> -1").select("DepartmentID", "DepartmentKey")
    years = year_ends.where(F.col("Year") >= first_year)
    stays = (
        s["EmploymentHistory"].join(departments, "DepartmentID")
        .select("EmployeeID", "DepartmentKey", F.year("StartDate").alias("_in"), F.coalesce(F.year("EndDate"), F.lit(9999)).alias("_out"))
    )
    span = F.sequence(F.greatest(F.col("_in"), first_year), F.least(F.col("_out"), F.lit(last_year)))
    touched = stays.where((F.col("_in") <= last_year) & (F.col("_out") >= first_year)).withColumn("Year", F.explode(span))
    by = ["Year", "DepartmentKey"]
    headcount = touched.groupBy(*by).agg(
        F.count_distinct(F.when(F.col("_in") < F.col("Year"), F.col("EmployeeID"))).alias("HeadcountStartOfYear"),
        F.count_distinct(F.when(F.col("_out") > F.col("Year"), F.col("EmployeeID"))).alias("HeadcountEndOfYear"),
    )
    year_end = F.make_date(F.col("Year"), F.lit(12), F.lit(31))
    means = touched.join(people, "EmployeeID", "left").groupBy(*by).agg(
        F.sum(month_boundaries(F.col("HireDate"), year_end)).alias("_months"), F.count("HireDate").alias("_hn"),
        F.sum(year_boundaries(F.col("BirthDate"), year_end)).alias("_age"), F.count("BirthDate").alias("_bn"),
    )
    ever = stays.select("EmployeeID", "DepartmentKey").distinct()
    hires = ever.join(people.select("EmployeeID", F.year("HireDate").alias("Year")), "EmployeeID").groupBy(*by).agg(F.count(F.lit(1)).alias("HiresCount"))
    leavers = s["Termination"].select("EmployeeID", F.year("TerminationDate").alias("Year"), F.col("TerminationReason").isin(*VOLUNTARY_REASONS).alias("_free"))
    leaving = ever.join(leavers.distinct(), "EmployeeID").groupBy(*by).agg(
        F.count_distinct("EmployeeID").alias("TerminationsCount"),
        F.count_distinct(F.when(F.col("_free"), F.col("EmployeeID"))).alias("VoluntaryTerminationsCount"),
        F.count_distinct(F.when(~F.col("_free"), F.col("EmployeeID"))).alias("InvoluntaryTerminationsCount"),
    )
    # every department appears in every year: repeat the few years per department as an array
    wanted = departments.select("DepartmentKey").withColumn(
        "Year", F.explode(years.agg(F.collect_set("Year")).scalar())
    )
    rows = wanted.join(years, "Year")
    for part in (headcount, means, hires, leaving):
        rows = rows.join(part, by, "left")
    counts = ["HeadcountStartOfYear", "HeadcountEndOfYear", "HiresCount", "TerminationsCount", "VoluntaryTerminationsCount", "InvoluntaryTerminationsCount"]
    return rows.select(
        "YearDateKey", "DepartmentKey",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        F.coalesce(F.expr("try_divide(_months, _hn)").cast("int"), F.lit(0)).cast(HOURS).alias("AverageTenureInMonths"),
        F.lit(0).cast("decimal(5,4)").alias("TurnoverRate"),
        F.coalesce(F.expr("try_divide(_age, _bn)").cast("int"), F.lit(0)).cast(HOURS).alias("AverageAgeOfEmployees"),
    )


FACTS = {
    "FactTermination": terminations,
    "FactSalaryPayment": salary_payments,
    "FactEmployeeAttendance": attendance,
    "FactMonthlyEmployeePerformance": monthly_performance,
    "FactEmployeeLifecycle": employee_lifecycle,
}


def _fresh(current, s, table, day, source_id, run_date) -> DataFrame:
    """Staged rows up to the run date that no fact row carries: late rows come in, and a repeated run adds nothing."""
    return increment.unloaded(s[table].where(F.col(day) <= F.lit(run_date).cast("date")), current, source_id, f"Source{source_id}")


def update_terminations(current, s, d, last_load, run_date) -> DataFrame:
    fresh = _fresh(current, s, "Termination", "TerminationDate", "TerminationID", run_date)
    return increment.append(current, terminations(Overlay(s, Termination=fresh), d))


def update_salary_payments(current, s, d, last_load, run_date) -> DataFrame:
    fresh = _fresh(current, s, "SalaryPayment", "PaymentDate", "SalaryPaymentID", run_date)
    return increment.append(current, salary_payments(Overlay(s, SalaryPayment=fresh), d))


def update_attendance(current, s, d, last_load, run_date) -> DataFrame:
    fresh = _fresh(current, s, "Attendance", "AttendanceDate", "AttendanceID", run_date)
    return increment.append(current, attendance(Overlay(s, Attendance=fresh), d))


def month_signatures(s, d) -> DataFrame:
    """One signature per month: of each employee's attendance in it, with the employee version and department in force at its end."""
    months = signature.signed("Attendance", *SIGNED_CHILDREN["Attendance"], s)
    rows = as_of(months, d["DimEmployee"], "EmployeeID", "MonthEndDate", "StartDate", "EmployeeKey", ["EmployeeKey"])
    rows = _history_as_of(_on_day(rows, d, "MonthEndDate", "MonthDateKey"), s, "MonthEndDate", ["DepartmentID"])
    rows = key_lookup(rows, d["DimDepartment"], "DepartmentID", "DepartmentKey", "left", unknown=True)
    return signature.signatures(rows, ["MonthDateKey"], ["EmployeeID", "EmployeeKey", "DepartmentKey", *signature.named("Attendance")])


def update_monthly_performance(current, s, d, last_load, run_date, seen=None, now=None) -> DataFrame:
    """The months whose attendance has changed are built anew, whatever the run date; the months reach the attendance scan as ranges
    of days. ``seen`` has the signatures published with ``current``, ``now`` today's, if they are at hand; without ``seen`` all months
    are built and compared, and the month of the run date and later ones count as new."""
    days = d["DimDateHR"].select(F.col("DateKey").alias("MonthDateKey"), "FullDate")
    if seen is None:
        later = days.where(F.col("FullDate") >= F.trunc(F.lit(run_date).cast("date"), "MM"))
        return signature.follow_rows(current, monthly_performance(s, d), ["MonthDateKey"], later)
    changed = signature.touched(seen, month_signatures(s, d) if now is None else now, ["MonthDateKey"])
    months = [r[0] for r in changed.join(days, "MonthDateKey").select(F.trunc("FullDate", "MM")).collect()]  # as many as there are months
    attended = s["Attendance"].where(signature.in_months("AttendanceDate", months))
    return increment.replace_keys(current, monthly_performance(Overlay(s, Attendance=attended), d), ["MonthDateKey"], changed)


def follow_employee_lifecycle(current, s, d, last_load, run_date) -> DataFrame:
    """The rows of a first load over today's sources, one per current employee version: a row that differs is replaced, that of a
    version no longer current goes. All inputs but the employees' own tables are aggregates by employee."""
    return signature.follow_rows(current, employee_lifecycle(s, d), ["EmployeeKey"])


def update_employee_lifecycle(current, s, d, last_load, run_date) -> DataFrame:
    """New employee versions come in, then terminations and trainings are filled in, in one pass over the rows."""
    hired = s["Employee"].select("EmployeeID", "HireDate")
    days = date_keys(d["DimDateHR"], "DateKey", HireDate="HireDateKey")["HireDate"]
    unseen = (
        d["DimEmployee"].where("IsCurrent").select("EmployeeID", "EmployeeKey")
        .join(current.select("EmployeeKey"), "EmployeeKey", "left_anti").join(hired, "EmployeeID").join(days, "HireDate", "left")
    )
    zero, unknown = F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
    added = unseen.select("EmployeeKey", F.coalesce("HireDateKey", unknown).alias("HireDateKey"), zero.alias("TotalPromotionsCount"), zero.alias("TotalTrainingsCompleted"), F.lit(True).alias("_added"))
    rows = current.withColumn("_added", F.lit(False)).unionByName(added, allowMissingColumns=True)

    gone = _latest_terminations(s)
    gone = as_of(gone, s["EmploymentHistory"], "EmployeeID", "TerminationDate", "StartDate", "EmploymentHistoryID", ["Salary"])
    gone = gone.join(date_keys(d["DimDateHR"], "DateKey", TerminationDate="_t_day")["TerminationDate"], "TerminationDate", "left")
    gone = gone.join(d["DimTerminationReason"].select("TerminationReason", F.col("TerminationReasonKey").alias("_t_reason")), "TerminationReason", "left")
    gone = gone.select("EmployeeID", F.col("TerminationDate").alias("_t_date"), "_t_day", "_t_reason", F.col("Salary").alias("_t_salary"))
    trained = _trainings(s).join(date_keys(d["DimDateHR"], "DateKey", LastTrainingDate="_l_day")["LastTrainingDate"], "LastTrainingDate", "left")
    trained = trained.select("EmployeeID", "_trainings", F.coalesce("_l_day", unknown).alias("_l_day"))
    hire_days = d["DimDateHR"].select(F.col("DateKey").alias("HireDateKey"), F.col("FullDate").alias("_hired"))

    rows = rows.join(d["DimEmployee"].select("EmployeeKey", "EmployeeID"), "EmployeeKey", "left").join(hire_days, "HireDateKey", "left")
    rows = rows.join(gone, "EmployeeID", "left").join(trained, "EmployeeID", "left")
    leaves = F.col("TerminationDateKey").isNull() & F.col("_t_date").isNotNull() & F.col("_hired").isNotNull()
    trains = F.col("_trainings").isNotNull() & (
        (F.coalesce("LastTrainingDateKey", unknown) != F.col("_l_day")) | (F.coalesce("TotalTrainingsCompleted", zero) != F.col("_trainings"))
    )

    def fill(when, column, value):
        return F.when(when, value).otherwise(F.col(column)).alias(column)

    filled = dict(
        TerminationDateKey=fill(leaves, "TerminationDateKey", F.coalesce("_t_day", unknown)),
        TerminationReasonKey=fill(leaves, "TerminationReasonKey", F.coalesce("_t_reason", unknown)),
        DaysToTermination=fill(leaves, "DaysToTermination", F.date_diff("_t_date", "_hired")),
        FinalSalary=fill(leaves, "FinalSalary", F.col("_t_salary").cast(PAY)),
        LastTrainingDateKey=fill(trains, "LastTrainingDateKey", F.col("_l_day")),
        TotalTrainingsCompleted=fill(trains, "TotalTrainingsCompleted", F.col("_trainings")),
    )
    change = F.when(F.col("_added"), "inserted").when(leaves | trains, "updated").otherwise("kept")
    return rows.select(*[filled.get(c, F.col(c)) for c in current.columns], change.alias(CHANGE))


UPDATES = {
    "FactTermination": update_terminations,
    "FactSalaryPayment": update_salary_payments,
    "FactEmployeeAttendance": update_attendance,
    "FactMonthlyEmployeePerformance": update_monthly_performance,
    "FactEmployeeLifecycle": update_employee_lifecycle,
}

# Tables whose signatures staging publishes: (key, columns the snapshot uses)
SIGNED_CHILDREN = {"Attendance": (["EmployeeID", "last_day(AttendanceDate) as MonthEndDate"], ["AttendanceID", "HoursWorked", "Status"])}
SIGNATURES = {"FactMonthlyEmployeePerformance": month_signatures}
# Loads keep to the rule of the first load here; ``update_employee_lifecycle`` is the modelled procedure, which leaves new versions blank.
FOLLOWED = {"FactEmployeeLifecycle": follow_employee_lifecycle}

# Facts published by the month of their source rows
PERIODS = {
    "FactSalaryPayment": Period("SalaryPayment", "SalaryPaymentID", "SourceSalaryPaymentID", "PaymentDate"),
    "FactEmployeeAttendance": Period("Attendance", "AttendanceID", "SourceAttendanceID", "AttendanceDate"),
}
