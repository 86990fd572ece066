"""The ordered loads: staging, dimensions and facts of each mart, for the first time and incrementally.

Every step reads what earlier steps published. A failing step stops its load, and nothing of that load is published.
"""

from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

from dockside.operators import additive, calendar as cal, period, rejects, scd, signature
from dockside.operators.quality import duplicate_count, missing_values, validation_report
from dockside.plans import finance, hr, port
from dockside.plans.links import REJECT_LINKS
from dockside.plans.staging import STAGES, stage

MARTS = {"finance": finance, "hr": hr, "port": port}
HR_CONTROL = "FactTables"
APPENDED = {
    "FactInvoiceLineTransaction", "FactCustomerPaymentTransaction", "FactCustomerContractActivationFactless",
    "FactTermination", "FactSalaryPayment", "FactEmployeeAttendance", "FactCargoOperationTransactional", "FactEquipmentAssignment",
}
PARTITIONED = {"FactMonthlyEmployeePerformance": "MonthDateKey"}

# The days that facts look up: a calendar covers all of them, however early or late.
DAYS = {
    "finance": [("Invoice", "InvoiceDate"), ("Invoice", "DueDate"), ("Payment", "PaymentDate"), ("Contract", "StartDate")],
    "hr": [
        ("Attendance", "AttendanceDate"), ("SalaryPayment", "PaymentDate"), ("Termination", "TerminationDate"), ("Employee", "HireDate"),
        ("EmployeeTraining", "TrainingDate"),
    ],
    "port": [("CargoOperation", "OperationDateTime"), ("PortCall", "ArrivalDateTime"), ("OperationEquipmentAssignment", "StartTime")],
}

# Columns that must be filled before a fact's first load: (staged table, columns, primary key to check for repeats)
FACT_CHECKS = {
    "FactInvoiceLineTransaction": ("InvoiceLine", ["InvoiceID", "ServiceTypeID", "Quantity", "UnitPrice", "TaxAmount", "NetAmount"], None),
    "FactCustomerPaymentTransaction": ("Payment", ["InvoiceID", "PaymentDate", "Amount", "PaymentMethod"], None),
    "FactCustomerBillingMonthlySnapshot": ("Invoice", ["InvoiceDate", "ContractID"], None),
    "FactInvoiceLifecycleAccumulating": ("Invoice", ["InvoiceDate", "DueDate"], None),
    "FactCargoOperationTransactional": (
        "CargoOperation", ["CargoOpID", "PortCallID", "ContainerID", "OperationType", "OperationDateTime"], "CargoOpID",
    ),
    "FactEquipmentAssignment": (
        "OperationEquipmentAssignment", ["AssignmentID", "CargoOpID", "EquipmentID", "StartTime"], "AssignmentID",
    ),
}


@dataclass
class Run:
    """One execution: where to publish, the operational tables by name, the run date, the calendar's span (by default that of
    the staged days and the run date)."""

    spark: SparkSession
    warehouse: object
    sources: object
    run_date: str
    run_time: object = None
    calendar: tuple | None = None


class _Staged:
    """Staged tables of one area; a table the area does not stage is read from the source."""

    def __init__(self, run: Run, area: str):
        self._run, self._area = run, area

    def __getitem__(self, table):
        name = f"{self._area}.{table}"
        return self._run.warehouse.table(name) if self._run.warehouse.has(name) else self._run.sources[table]

    def signatures(self, table):
        """What staging published of the table's signatures, if it did."""
        name = _signatures_of(f"{self._area}.{table}")
        return self._run.warehouse.table(name) if self._run.warehouse.has(name) else None


def _signatures_of(table: str) -> str:
    return f"signatures.{table}"


class _Published:
    def __init__(self, warehouse):
        self._warehouse = warehouse

    def __getitem__(self, table):
        return self._warehouse.table(table)


def _staging(area):
    def steps(run: Run):
        for spec in STAGES.values():
            if spec.area == area:
                yield f"{area}.{spec.table}", lambda p, t, spec=spec: _stage_one(run, p, t, spec)

    return steps


def _stage_one(run, process, table, spec):
    rows, _ = stage(run.sources[spec.table], spec, run.run_time)
    run.warehouse.replace(process, table, rows, spec.checks)
    if spec.table in MARTS[spec.area].SIGNED_CHILDREN:
        by = MARTS[spec.area].SIGNED_CHILDREN[spec.table]
        run.warehouse.replace(process, _signatures_of(table), signature.by_parent(run.warehouse.table(table), *by))
    for name, sign in getattr(MARTS[spec.area], "STAGED_SIGNATURES", {}).get(spec.table, {}).items():
        run.warehouse.replace(process, _signatures_of(f"{table}.{name}"), sign({spec.table: run.warehouse.table(table)}))
    for by in MARTS[spec.area].PERIODS.values():
        if by.table == spec.table and by.parent:
            run.warehouse.replace(process, _signatures_of(f"{table}.ids"), by.by_link({by.table: run.warehouse.table(table)}))


def _span(run: Run, area: str):
    if run.calendar:
        return cal.fixed_span(run.spark, *run.calendar)
    staged, today = _Staged(run, area), cal.fixed_span(run.spark, run.run_date, run.run_date)
    return cal.date_span([*((staged[table], column) for table, column in DAYS[area]), (today, "StartDate")])


def _calendar(run: Run, area: str):
    """The area's calendar over every staged day; days that a calendar in use lacks are added to it."""

    def load(process, name):
        key, unknown = ("DateKey", True) if area == "hr" else ("DimDateID", False)
        if not run.warehouse.has(name):
            run.warehouse.replace(process, name, cal.calendar(_span(run, area), key, unknown=unknown))
        else:
            added = cal.missing_days(_span(run, area), run.warehouse.table(name), key).withColumn(scd.CHANGE, F.lit("inserted"))
            run.warehouse.append(process, name, added)

    return ("DimDateHR" if area == "hr" else "DimDate"), load


def _key_report(source, dim):
    """Repeated and missing business keys, which would give a member two rows; insert-only members are distinct by themselves."""
    return None if dim.kind == "insert_only" else validation_report(source, dim.business_key, dim.required or dim.business_key)


def _dimensions_first(area):
    module = MARTS[area]

    def steps(run: Run):
        s, w = _Staged(run, area), run.warehouse
        if area == "port":
            for fact in module.FACTS:
                w.clear("port_dimensions_first", fact)
        yield _calendar(run, area)
        for name, dim in module.DIMENSIONS.items():
            yield name, lambda p, t, name=name, dim=dim: load(run, s, p, name, dim)

    def load(run, s, process, name, dim):
        source = module.dimension_source(name, s)
        report = _key_report(source, dim)
        if area == "hr" and run.warehouse.has(name):  # safe to repeat: adds what is missing
            rows = scd.update(run.warehouse.table(name), source, dim, run.run_date, compare=False)
            return run.warehouse.replace(process, name, rows, report)
        rows, day = scd.first_load(source, dim, run.run_date), getattr(module, "MEMBER_DAYS", {}).get(name)
        if day is None:
            return run.warehouse.replace(process, name, rows, report)
        run.warehouse.replace(process, name, period.laid_out(rows, day), report, period.MONTH)
        run.warehouse.replace(process, _signatures_of(name), period.member_signatures(source, dim, day))

    return steps


def _dimensions_update(area):
    module = MARTS[area]

    def steps(run: Run):
        s, w = _Staged(run, area), run.warehouse
        yield _calendar(run, area)
        for name, dim in module.DIMENSIONS.items():
            yield name, lambda p, t, name=name, dim=dim: load(run, s, w, p, name, dim)

    def load(run, s, w, process, name, dim):
        source, current = module.dimension_source(name, s), w.table(name)
        report, day, signed = _key_report(source, dim), getattr(module, "MEMBER_DAYS", {}).get(name), _signatures_of(name)
        if day is None:
            return w.replace(process, name, scd.update(current, source, dim, run.run_date), report)
        now = period.member_signatures(source, dim, day)
        if w.has(signed) and period.MONTH in current.columns:
            months = period.batch_months(w.table(signed), now)
            if not months:
                return w.skip(process, name, report)
            rows, touched = period.update_members(current, source, dim, day, run.run_date, months)
            w.replace_periods(process, name, rows, touched, report, period.MONTH)
        else:  # published before it was laid out by month
            w.replace(process, name, period.laid_out(scd.update(current, source, dim, run.run_date), day), report, period.MONTH)
        w.replace(process, signed, now)

    return steps


def _fact_report(name, s):
    if name == "FactContainerMovementsAcc":
        return port.container_movement_gaps(s)
    if name not in FACT_CHECKS:
        return None
    table, required, key = FACT_CHECKS[name]
    report = missing_values(s[table], required)
    return report.unionByName(duplicate_count(s[table], [key])) if key else report


def _facts_first(area):
    module = MARTS[area]

    def steps(run: Run):
        s, d, w = _Staged(run, area), _Published(run.warehouse), run.warehouse
        for name, build in module.FACTS.items():
            yield name, lambda p, t, name=name, build=build: first(s, d, w, p, name, build)
        if area == "hr":
            yield HR_CONTROL, lambda p, t: w.advance(HR_CONTROL, run.run_date)

    def first(s, d, w, process, name, build):
        if name in getattr(module, "ADDITIVE", {}):
            state, _, by, measures = module.ADDITIVE[name]
            for part, rows in state(s, d).items():
                w.replace(process, f"{part}.{name}", rows, partition_by=period.MONTH if part == "entries" else None)
            w.replace(process, f"totals.{name}", additive.totals(w.table(f"entries.{name}"), by, measures))
            return w.replace(process, name, w.table(f"totals.{name}").drop(additive.ROWS), _fact_report(name, s))
        layout = _layout(module, name)
        w.replace(process, name, build(s, d, month=True) if layout else build(s, d), _fact_report(name, s), layout)
        _sign(module, w, process, name, s, d)
        if name in module.PERIODS:
            w.replace(process, _signatures_of(name), module.PERIODS[name].carried(w.table(name)))
            _reject(module, s, d, w, process, name)

    return steps


def _reject(module, s, d, w, process, name, upto=None):
    """Publish the staged rows that the fact does not carry, with the link that fails them."""
    by, (links, otherwise) = module.PERIODS[name], REJECT_LINKS[name]
    rows = rejects.needed(rejects.uncarried(w.table(name), s, by, w.table(_signatures_of(name)), upto), by.source_id, links)
    w.replace(process, f"uncarried.{name}", rows)  # computed once; every chain of links takes them from there
    rows = w.table(f"uncarried.{name}")
    links = () if rows.isEmpty() else links  # a night without rejected rows reads no parents
    w.replace(process, f"rejects.{name}", rejects.failed_links(rows, by.source_id, links, s, d, otherwise))


def _sign(module, w, process, name, s, d):
    """Publish, beside a snapshot, the signatures of what it was built from."""
    merged = _merged(module, name)
    if name in module.SIGNATURES or merged:
        w.replace(process, _signatures_of(name), (merged[0] if merged else module.SIGNATURES[name])(s, d))


def _merged(module, name):
    return getattr(module, "MERGED", {}).get(name)


def _layout(module, name):
    return period.MONTH if name in module.PERIODS or _merged(module, name) else None


def _facts_update(area):
    module = MARTS[area]

    def steps(run: Run):
        s, d, w = _Staged(run, area), _Published(run.warehouse), run.warehouse
        window = dict(last_load=w.last_load(HR_CONTROL), run_date=run.run_date) if area == "hr" else {}
        for name, build in (module.UPDATES | module.FOLLOWED).items():
            yield name, lambda p, t, name=name, build=build: update(s, d, w, p, name, build, window)
        if area == "hr":
            yield HR_CONTROL, lambda p, t: w.advance(HR_CONTROL, run.run_date)

    def update(s, d, w, process, name, build, window):
        if name in getattr(module, "ADDITIVE", {}) and w.has(f"entries.{name}"):
            return fold(s, d, w, process, name)
        signed, current = _signatures_of(name), w.table(name)
        seen = w.table(signed) if w.has(signed) else None
        if name in module.PERIODS and seen is not None and period.MONTH in current.columns:
            by = module.PERIODS[name]
            months = period.batch_months(seen, by.signatures(s))
            if not months:
                return w.skip(process, name, _fact_report(name, s))
            publish(w, process, name, period.update(current, s, d, by, module.FACTS[name], months, window.get("run_date")), _fact_report(name, s), period.MONTH)
            w.replace(process, signed, period.carried_after(w.table(name), by, seen, months))
            return _reject(module, s, d, w, process, name, window.get("run_date"))
        if _merged(module, name) and seen is not None and period.MONTH in current.columns:
            sign, merge = _merged(module, name)
            now = sign(s, d)
            months = period.batch_months(seen, now)
            if not months:
                return w.skip(process, name, _fact_report(name, s))
            rows, touched = merge(current, s, d, months)
            w.replace_periods(process, name, rows, touched, _fact_report(name, s), period.MONTH)
            return w.replace(process, signed, now)
        if name in module.SIGNATURES and seen is not None:  # today's signatures are computed once, for the comparison and the next night
            w.replace(process, signed, module.SIGNATURES[name](s, d))
            rows = build(current, s, d, **window, seen=seen, now=w.table(signed))
            return publish(w, process, name, rows, _fact_report(name, s))
        publish(w, process, name, build(current, s, d, **window), _fact_report(name, s))
        _sign(module, w, process, name, s, d)

    def fold(s, d, w, process, name):
        make, changes, by, measures = module.ADDITIVE[name]
        now = make(s, d)
        state = {part: w.table(f"{part}.{name}") for part in now}
        delta = changes(state, s, d)
        if delta is None:
            return w.skip(process, name, _fact_report(name, s))
        w.replace(process, f"deltas.{name}", delta)  # computed once; the parts and the totals take it from there
        delta = w.table(f"deltas.{name}")
        w.replace(process, f"totals.{name}", additive.folded(w.table(f"totals.{name}"), delta, by, measures))
        w.append(process, f"entries.{name}", delta.withColumn(scd.CHANGE, F.lit("inserted")), partition_by=period.MONTH)
        w.replace(process, name, w.table(f"totals.{name}").drop(additive.ROWS), _fact_report(name, s))
        for part in now:
            if part != "entries":
                w.replace(process, f"{part}.{name}", now[part])

    def publish(w, process, table, rows, report, layout=None):
        if table in APPENDED:
            w.append(process, table, rows, report, layout)
        elif table in PARTITIONED:
            w.replace_partitions(process, table, rows, report, partition_by=PARTITIONED[table])
        else:
            w.replace(process, table, rows, report)

    return steps


LOADS = {
    f"{area}_{phase}": build(area)
    for phase, build in [
        ("staging", _staging),
        ("dimensions_first", _dimensions_first),
        ("facts_first", _facts_first),
        ("dimensions_update", _dimensions_update),
        ("facts_update", _facts_update),
    ]
    for area in MARTS
}


def run_load(name: str, run: Run) -> list[str]:
    """Run one load; returns the tables it published."""
    run.warehouse.note(name, "Start", "In Progress")
    published = []
    try:
        with run.warehouse.together():
            for table, load in LOADS[name](run):
                load(name, table)
                published.append(table)
            run.warehouse.note(name, "Procedure", "Success")
    except Exception as error:
        run.warehouse.note(name, "Procedure", "Failed", str(error))
        raise
    return published
