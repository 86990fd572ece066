"""The registered queries: one per load, over the tables of a benchmark directory.

Dimension queries run the first load on the earlier snapshot and the update on the later one. Fact queries read
the later snapshot; their versioned dimensions carry both loads' versions.
"""

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dockside.operators import additive, calendar as cal, declared, period, quality, reconcile, rejects, report, scd, signature
from dockside.operators.increment import in_window
from dockside.operators.keys import assign_dense_keys
from dockside.operators.lookup import as_of, interval_lookup
from dockside.plans import declarations, finance, hr, port
from dockside.plans.links import FACT_KEYS, REJECT_LINKS, SOURCE_LINKS
from dockside.plans.loads import HR_CONTROL, Run, run_load
from dockside.plans.staging import STAGES, stage
from dockside.sources import adapter
from dockside.sources.adapter import CALENDAR_END, CALENDAR_START, FINANCE_RUN_1, FINANCE_RUN_2, HR_RUN_1, HR_RUN_2, Sources
from dockside.sources.overlay import Overlay
from dockside.sources.readers import read_quarantined
from dockside.sources.shared import shared_folder, stored
from dockside.sources.warehouse import FolderWarehouse, MemoryWarehouse

HR_LAST_LOAD, HR_RUN_DATE, HEADCOUNT_YEAR = "2024-01-15", "2024-01-31", 2026
STAGED_AT = "2024-01-31 02:00:00"
MARTS = {"finance": finance, "hr": hr, "port": port}
RUN_DATES = {"finance": (FINANCE_RUN_1, FINANCE_RUN_2), "hr": (HR_RUN_1, HR_RUN_2), "port": (FINANCE_RUN_1, FINANCE_RUN_2)}


class Dimensions:
    """Dimension tables by name, built on first use. ``state`` 1 = first load only, 2 = first load and update."""

    def __init__(self, spark: SparkSession, directory: str, mart: str, state: int = 2):
        self.spark, self.mart, self.state = spark, mart, state
        self.earlier, self.later = Sources(spark, directory, "v1"), Sources(spark, directory)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def _build(self, name: str) -> DataFrame:
        if name.startswith("DimDate"):
            span = cal.fixed_span(self.spark, CALENDAR_START, CALENDAR_END)
            return cal.calendar(span, "DateKey", unknown=True) if name == "DimDateHR" else cal.calendar(span)
        module = MARTS[self.mart]
        dim, (run_1, run_2) = module.DIMENSIONS[name], RUN_DATES[self.mart]
        if self.state == 1:
            return scd.first_load(module.dimension_source(name, self.earlier), dim, run_1)
        if dim.kind != "versioned":
            return scd.first_load(module.dimension_source(name, self.later), dim, run_1)
        first = scd.first_load(module.dimension_source(name, self.earlier), dim, run_1)
        return scd.update(first, module.dimension_source(name, self.later), dim, run_2).drop(scd.CHANGE)


# What facts take of a dimension besides its keys and versions
TAKEN = {"DimContainer": ("ContainerTypeID",)}


class Written:
    """Dimensions by name, written once on first use; of each only what facts look members up by."""

    def __init__(self, dimensions: Dimensions):
        self._dimensions, self._written = dimensions, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._written:
            rows, dim = self._dimensions[name], MARTS[self._dimensions.mart].DIMENSIONS.get(name)
            used = [dim.key, *dim.business_key, *TAKEN.get(name, ()), *([dim.start, dim.end, dim.current] if dim.kind == "versioned" else [])] if dim else rows.columns
            self._written[name] = stored(rows.select(*used), name)
        return self._written[name]


# Parents of fact rows that are not simply read but grouped or joined: written once, not worked out for each fact and link
JOINED_PARENTS = {"finance": ("Customer", "Contract"), "hr": ("Employee", "EmploymentHistory", "Termination"), "port": ()}


def _written_parents(mart, s):
    return Overlay(s, **{t: stored(s[t], t) for t in JOINED_PARENTS[mart]})


def flat(df: DataFrame) -> DataFrame:
    """Flags as 0/1, amounts as doubles (ratios at four decimals), days as ISO text: rows every SQL engine states alike."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, T.DecimalType):
            c = (c.cast("decimal(18,4)") if f.dataType.scale > 4 else c).cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _staging(name, spark, directory):
    spec = STAGES[name]
    return stage(Sources(spark, directory)[spec.table], spec)[1]


def _staged(name, spark, directory):
    """The rows a load stages, types widened and load time stamped, as text."""
    spec = STAGES[name]
    rows = stage(Sources(spark, directory)[spec.table], spec, STAGED_AT)[0]
    return rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns])


def _dimension_first(mart, name, spark, directory):
    return flat(Dimensions(spark, directory, mart, state=1)[name])


def _dimension_update(mart, name, spark, directory):
    d, module = Dimensions(spark, directory, mart, state=1), MARTS[mart]
    return flat(scd.update(d[name], module.dimension_source(name, d.later), module.DIMENSIONS[name], RUN_DATES[mart][1]))


def _fact_first(mart, name, spark, directory, **options):
    return flat(MARTS[mart].FACTS[name](Sources(spark, directory), Dimensions(spark, directory, mart), **options))


# Tables an update finds in their earlier state when the fact was first loaded.
_EARLIER = {
    "FactInvoiceLineTransaction": ("InvoiceLine",),
    "FactCustomerPaymentTransaction": ("Payment",),
    "FactCustomerBillingMonthlySnapshot": ("Invoice",),
    "FactInvoiceLifecycleAccumulating": ("Invoice", "Payment"),
    "FactCustomerContractActivationFactless": ("Contract",),
    "FactEmployeeLifecycle": ("Employee", "Termination", "EmployeeTraining"),
    "FactCargoOperationTransactional": ("CargoOperation", "OperationEquipmentAssignment"),
    "FactEquipmentAssignment": ("CargoOperation", "OperationEquipmentAssignment"),
    "FactContainerMovementsAcc": ("CargoOperation",),
    "FactPortCallPeriodicSnapshot": ("PortCall",),
}
_HIGH_WATER = {
    "FactTermination": ("Termination", "TerminationDate"),
    "FactSalaryPayment": ("SalaryPayment", "PaymentDate"),
    "FactEmployeeAttendance": ("Attendance", "AttendanceDate"),
    "FactMonthlyEmployeePerformance": ("Attendance", "AttendanceDate"),
}


def _fact_update(mart, name, spark, directory, **options):
    s, d, module = Sources(spark, directory), Dimensions(spark, directory, mart), MARTS[mart]
    before = d
    if name in _HIGH_WATER:
        table, day = _HIGH_WATER[name]
        loaded = Overlay(s, **{table: in_window(s[table], day, "1900-01-01", HR_LAST_LOAD)})
    else:
        loaded = Overlay(s, **{t: adapter.source(spark, directory, f"{t}_v1") for t in _EARLIER[name]})
    if name == "FactEmployeeLifecycle":
        before = Dimensions(spark, directory, mart, state=1)
        before._cache["DimTerminationReason"] = d["DimTerminationReason"]
    if mart == "hr":
        options = {"last_load": HR_LAST_LOAD, "run_date": HR_RUN_DATE, **options}
    # both loads of lines, and the comparison by reference keys, look the same invoices up
    shared = {"lookups": {k: stored(v, k) for k, v in finance.line_lookups(s, d).items()}} if name == "FactInvoiceLineTransaction" else {}
    # assignments name a few of the employees
    workers = {"workers": loaded[port.ASSIGNED]} if name in port.WORKED else {}
    current = module.FACTS[name](loaded, before, **shared, **workers)
    if name == "FactCargoOperationTransactional":  # read as it is, and for its source ids, which take the same joins
        current = stored(current, name)
    return flat(module.UPDATES[name](current, s, d, **options, **shared))


def corrected(mart: str, spark, directory):
    """(sources of the first load, sources of a later night): rows have come late, moved, changed and gone in between."""
    s = Sources(spark, directory)
    late = lambda table, key: s[table].where(f"{key} % 10 <> 3")
    left = lambda table, key: s[table].where(f"{key} % 11 <> 5")
    if mart == "finance":
        moved = F.when(F.col("InvoiceID") % 10 == 1, F.add_months("InvoiceDate", -1)).otherwise(F.col("InvoiceDate"))
        paid = F.when(F.col("InvoiceID") % 9 == 2, F.col("Amount") + 1).otherwise(F.col("Amount")).cast("decimal(18,4)")
        return Overlay(s, Invoice=late("Invoice", "InvoiceID").withColumn("InvoiceDate", moved), Payment=s["Payment"].withColumn("Amount", paid)), Overlay(s, Invoice=left("Invoice", "InvoiceID"))
    if mart == "hr":
        return Overlay(s, Attendance=late("Attendance", "AttendanceID"), Employee=late("Employee", "EmployeeID")), Overlay(s, Attendance=left("Attendance", "AttendanceID"))
    docked = late("PortCall", "PortCallID").withColumn("Status", F.lit("Docked"))
    return Overlay(s, PortCall=docked, CargoOperation=late("CargoOperation", "ContainerID")), Overlay(s, PortCall=left("PortCall", "PortCallID"))


class _Signed(Overlay):
    """Staged tables with signatures published for some of them."""

    def __init__(self, base, published):
        super().__init__(base)
        self._published = published

    def signatures(self, table):
        return self._published.get(table)


def _signed_alike(before, now, children):
    """Both nights' sources; a table that is the same on both is signed once, as staging would publish it."""
    same = {table: stored(signature.by_parent(now[table], *by), f"signatures.{table}") for table, by in children.items() if before[table] is now[table]}
    return _Signed(before, same), _Signed(now, same)


def _after_corrections(mart, name, spark, directory):
    """A snapshot's rows after a first load and a night in which the sources were corrected, with signatures published in between."""
    (before, now), d, module = corrected(mart, spark, directory), Dimensions(spark, directory, mart), MARTS[mart]
    options = {"last_load": HR_LAST_LOAD, "run_date": HR_RUN_DATE} if mart == "hr" else {}
    if mart == "finance":
        d, options["keep"] = Written(d), stored
        before, now = _signed_alike(before, now, finance.SIGNED_CHILDREN)
    if name in module.SIGNATURES:
        options["seen"] = module.SIGNATURES[name](before, d)
    update = (module.UPDATES | module.FOLLOWED)[name]
    return flat(update(module.FACTS[name](before, d), now, d, **options).drop(scd.CHANGE))


def _lifecycle_by_month(spark, directory):
    """The invoice lifecycle after a night that rewrites only the months in which its sources differ; the other rows as published."""
    s, d = _written_parents("finance", Sources(spark, directory)), Written(Dimensions(spark, directory, "finance"))
    loaded = Overlay(s, **{t: adapter.source(spark, directory, f"{t}_v1") for t in _EARLIER["FactInvoiceLifecycleAccumulating"]})
    current = stored(finance.invoice_lifecycle(loaded, d, month=True), "FactInvoiceLifecycleAccumulating")
    months = period.batch_months(finance.lifecycle_signatures(loaded, d), finance.lifecycle_signatures(s, d))
    rows, touched = finance.merge_invoice_lifecycle(current, s, d, months)
    return flat(_with_untouched(current, rows, touched))


def _invoice_members_by_month(spark, directory):
    """The invoice dimension after a night that rewrites only the months in which invoices differ."""
    dim, day, (run_1, run_2) = finance.DIMENSIONS["DimInvoice"], finance.MEMBER_DAYS["DimInvoice"], RUN_DATES["finance"]
    earlier, later = (finance.dimension_source("DimInvoice", Sources(spark, directory, *v)) for v in (("v1",), ()))
    current = period.laid_out(scd.first_load(earlier, dim, run_1), day)
    months = period.batch_months(*(period.member_signatures(x, dim, day) for x in (earlier, later)))
    rows, touched = period.update_members(current, later, dim, day, run_2, months)
    return flat(_with_untouched(current, rows, touched))


def _with_untouched(current, rows, touched):
    others = current.where(~F.col(period.MONTH).isin(touched)).withColumn(scd.CHANGE, F.lit("kept"))
    return others.unionByName(rows).drop(period.MONTH)


def _movements_after_corrections(spark, directory):
    """Container movements after a first load, a night of corrections and the same night again, kept by signed parts."""
    (before, now), d = corrected("port", spark, directory), Dimensions(spark, directory, "port")
    state = port.movement_state(before, d)
    totals = additive.totals(state["entries"], port.MOVED_BY, port.MOVED)
    for _ in range(2):
        delta = port.movement_deltas(state, now, d)
        if delta is not None:
            totals = additive.folded(totals, delta, port.MOVED_BY, port.MOVED)
            state = port.movement_state(now, d) | {"entries": state["entries"].unionByName(delta)}
    return flat(totals.drop(additive.ROWS))


# Parents that are left out to see which rows a load would reject: (table, key, divisor, remainder)
LOST_PARENTS = {
    "finance": [("Invoice", "InvoiceID", 11, 5), ("Contract", "ContractID", 13, 4)],
    "port": [("PortCall", "PortCallID", 11, 5), ("Voyage", "VoyageID", 7, 3)],
}

def _rejects(mart, spark, directory):
    """Staged rows that the transaction facts do not carry when some parents are not staged, with the link that fails them."""
    s, d, module = Sources(spark, directory), Written(Dimensions(spark, directory, mart)), MARTS[mart]
    s = Overlay(s, **{t: s[t].where(f"{key} % {n} <> {r}") for t, key, n, r in LOST_PARENTS[mart]})
    s = _written_parents(mart, s)
    parts = []
    for name, by in module.PERIODS.items():
        links, otherwise = REJECT_LINKS[name]
        fact = stored(module.FACTS[name](s, d, month=True).select(period.MONTH, by.loaded_as), name)
        rows = rejects.uncarried(fact, s, by, by.carried(fact))
        rows = stored(rejects.needed(rows, by.source_id, links), f"uncarried.{name}")
        parts.append(rejects.failed_links(rows, by.source_id, links, s, d, otherwise).select(F.lit(name).alias("Fact"), "SourceID", "FailedLink"))
    return reduce(DataFrame.unionByName, parts)


def _calendar_first(key, unknown, spark, directory):
    """Calendar over every date the fact sources hold."""
    s = Sources(spark, directory)
    finance_days = [(s["Invoice"], "InvoiceDate"), (s["Payment"], "PaymentDate")]
    hr_days = [(s["Attendance"], "AttendanceDate"), (s["EmploymentHistory"], "StartDate")]
    return flat(cal.calendar(cal.date_span(hr_days if unknown else finance_days), key, unknown=unknown))


def _calendar_update(spark, directory):
    s = Sources(spark, directory)
    current = cal.calendar(cal.date_span([(s["Invoice"], "InvoiceDate")]))
    added = cal.extend_calendar(current, "2004-12-31")
    return flat(current.unionByName(added))


def _calendar_gaps(spark, directory):
    """Days between the first and last attendance that the invoice calendar lacks, keyed after it."""
    s = Sources(spark, directory)
    current = cal.calendar(cal.date_span([(s["Invoice"], "InvoiceDate")]))
    span = cal.date_span([(s["Payment"], "PaymentDate"), (s["Attendance"], "AttendanceDate")])
    return flat(cal.missing_days(span, current, "DimDateID"))


def _row_counts(spark, directory):
    s = Sources(spark, directory)
    return quality.row_counts({name: s[name] for name in dict.fromkeys(spec.table for spec in STAGES.values())})


def _orphan_report(spark, directory):
    s = Sources(spark, directory)
    links = [
        ("Invoice", "ContractID", "Contract", "ContractID"),
        ("InvoiceLine", "InvoiceID", "Invoice", "InvoiceID"),
        ("InvoiceLine", "TaxID", "Tax", "TaxID"),
        ("OperationEquipmentAssignment", "EmployeeID", "Employee", "EmployeeID"),
        ("YardSlot", "YardID", "Yard", "YardID"),
        ("Voyage", "ShipID", "Ship", "ShipID"),
        ("ContainerYardMovement", "ContainerID", "Container", "ContainerID"),
    ]
    found = {f"{child}.{c}": quality.orphans(s[child], s[parent], c, p) for child, c, parent, p in links}
    return quality.row_counts(found).withColumnsRenamed({"TableName": "ForeignKey", "RowCount": "Orphans"})


def _referential_report(spark, directory):
    """Orphans of every declared reference between operational tables."""
    return quality.referential_report(SOURCE_LINKS, Sources(spark, directory))


def _fact_references(mart, spark, directory):
    """Orphans of the facts' dimension keys; facts are built from dimensions that a later load has extended."""
    s, d, module = Sources(spark, directory), Dimensions(spark, directory, mart), MARTS[mart]
    built = {name: build(s, d) for name, build in module.FACTS.items()}
    links = [(fact, key, dim, key) for fact, rows in built.items() for key, dim in FACT_KEYS[mart].items() if key in rows.columns]
    tables = {fact: stored(rows.select(*[key for child, key, _, _ in links if child == fact]), fact) for fact, rows in built.items()}
    return quality.referential_report(links, tables | {dim: d[dim] for _, _, dim, _ in links})


def _reconciliation(spark, directory):
    """Staged invoices against their source, after some were lost, changed and added in the copy."""
    source, n = Sources(spark, directory)["Invoice"], F.col("InvoiceID")
    staged = stage(source, STAGES["invoice"], STAGED_AT)[0].where(n % 97 != 5)
    amount = F.when(n % 97 == 6, F.col("TotalAmount") + 1).otherwise(F.col("TotalAmount")).cast("decimal(18,4)")
    added = staged.where(n % 97 == 7).withColumn("InvoiceID", n + 10**9)
    return reconcile.reconcile(source, staged.withColumn("TotalAmount", amount).unionByName(added), ["InvoiceID"], ignore=("LoadDate",))


def _planted(s):
    """Sources with values that their declared columns cannot hold."""
    n, c = F.col("InvoiceID") % 97, F.col("CustomerID") % 7
    amount = F.when(n == 5, F.col("TotalAmount") * 10**12).when(n == 6, F.col("TotalAmount") + F.lit("0.00005").cast("decimal(18,5)"))
    day = F.when(n == 7, F.lit("2024-02-30")).when(n == 8, F.lit(None)).otherwise(F.col("DueDate").cast("string"))
    invoices = s["Invoice"].withColumns({"TotalAmount": amount.otherwise(F.col("TotalAmount")).cast("decimal(38,9)"), "DueDate": day})
    code = F.when(c == 3, F.repeat("CustomerCode", 10)).otherwise(F.col("CustomerCode"))
    return Overlay(s, Invoice=invoices, Customer=s["Customer"].withColumn("CustomerCode", code))


def _declared_staging(spark, directory):
    """What the declared columns of the staged finance tables could not hold of sources with planted faults."""
    s = _planted(Sources(spark, directory))
    parts = [declared.report(s[t], columns).select(F.lit(t).alias("TableName"), "*") for t, columns in declarations.STAGED.items()]
    return reduce(DataFrame.unionByName, parts)


def _declared_marts(spark, directory):
    """The same of the finance dimensions and facts."""
    s, d = _written_parents("finance", Sources(spark, directory)), Dimensions(spark, directory, "finance")
    d._cache |= {n: stored(d[n], n) for n in declarations.DIMENSIONS if n in finance.DIMENSIONS}  # read whole, and by every fact
    tables = [(n, d[n], c) for n, c in declarations.DIMENSIONS.items()] + [(n, finance.FACTS[n](s, d), c) for n, c in declarations.FACTS.items()]
    return reduce(DataFrame.unionByName, [declared.report(rows, c).select(F.lit(n).alias("TableName"), "*") for n, rows, c in tables])


def _bulk_load_payments(spark, directory):
    """Payments written as delimited text, some lines broken, and read again: loaded rows and the quarantine."""
    path, rows, n = shared_folder(spark, "bulk"), Sources(spark, directory)["Payment"], F.col("InvoiceID") % 97
    fields = {c: F.col(c).cast("string") for c in rows.columns}
    fields["PaymentDate"] = F.when(n == 5, F.lit("soon")).otherwise(fields["PaymentDate"])
    fields["Amount"] = F.when(n == 6, F.lit("123456789012345.5")).when(n == 7, F.lit(None)).otherwise(fields["Amount"])
    fields["PaymentMethod"] = F.when(n == 8, F.repeat("PaymentMethod", 30)).otherwise(fields["PaymentMethod"])
    line = F.to_csv(F.struct(*[v.alias(c) for c, v in fields.items()]))
    line = F.when(n == 9, F.concat(line, F.lit(",surplus"))).when(n == 10, F.concat_ws(",", "PaymentID", "InvoiceID")).otherwise(line)
    rows.select(line.alias("value")).write.text(path)
    loaded, quarantine = read_quarantined(spark, path, declarations.STAGED["Payment"], header=False)
    loaded = loaded.withColumns({"Line": F.lit(None).cast("string"), "Problems": F.lit(None).cast("string")})
    refused = quarantine.select("Line", F.array_join("Problems", "; ").alias("Problems"))
    return flat(loaded.unionByName(refused, allowMissingColumns=True))


def _top_lines(spark, directory):
    rows = finance.FACTS["FactInvoiceLineTransaction"](Sources(spark, directory), Dimensions(spark, directory, "finance"))
    return flat(report.top_rows(rows, 100, F.desc("NetAmount"), "SourceInvoiceLineID"))


def _latest_payments(spark, directory):
    """Three latest payments of each customer."""
    rows = finance.FACTS["FactCustomerPaymentTransaction"](Sources(spark, directory), Dimensions(spark, directory, "finance"))
    rows = rows.select("DimCustomerID", "DimDateID", "PaymentAmount", "SourcePaymentID")
    return flat(report.top_by(rows, ["DimCustomerID"], 3, F.desc("DimDateID"), "SourcePaymentID"))


def _dimension_sizes(spark, directory):
    """Rows of each dimension of the three marts after both loads, the largest first."""
    tables = {name: d[name] for mart, module in MARTS.items() for d in [Dimensions(spark, directory, mart)] for name in module.DIMENSIONS}
    return quality.row_counts(tables).orderBy(F.desc("RowCount"), "TableName")


def _duplicate_keys(spark, directory):
    return quality.repeated_keys(spark.read.parquet(f"{directory}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


def _container_gaps(spark, directory):
    return port.container_movement_gaps(Overlay(Sources(spark, directory), PortCall=adapter.source(spark, directory, "PortCall_v1")))


def _asof_lookup(spark, directory):
    s = Sources(spark, directory)
    rows = s["Attendance"].select("AttendanceID", "EmployeeID", "AttendanceDate")
    return flat(as_of(rows, s["EmploymentHistory"], "EmployeeID", "AttendanceDate", "StartDate", "EmploymentHistoryID", ["EmploymentHistoryID", "DepartmentID"]))


def _interval_lookup(spark, directory):
    rows = Sources(spark, directory)["Attendance"].select("AttendanceID", "EmployeeID", "AttendanceDate")
    return flat(interval_lookup(rows, Dimensions(spark, directory, "hr")["DimEmployee"], "EmployeeID", "AttendanceDate", "EmployeeKey", how="left"))


def _surrogate_keys(spark, directory):
    lines = Sources(spark, directory)["InvoiceLine"].select("InvoiceLineID")
    return assign_dense_keys(lines, ["InvoiceLineID"], "InvoiceLineKey")


def _current_versions(spark, directory):
    d = Dimensions(spark, directory, "finance")["DimCustomer"]
    return flat(d.where("IsCurrent").select("DimCustomerID", "CustomerCode", "Phone", "Address", "StartDate"))


def _load(area, phase, spark, directory):
    """Rows per table after a whole load, its steps chained; an update of facts reads what the first load has written."""
    later, earlier = Sources(spark, directory), Sources(spark, directory, "v1")
    if area == "hr" and phase == "facts_update":
        later = _written_parents(area, later)
    first_day, second_day = RUN_DATES[area]
    warehouse = FolderWarehouse() if phase == "facts_update" else MemoryWarehouse()

    def run(step, sources, run_date):
        return run_load(f"{area}_{step}", Run(spark, warehouse, sources, run_date, calendar=(CALENDAR_START, CALENDAR_END)))

    if phase == "staging":
        published = run(phase, later, first_day)
    elif phase.startswith("dimensions"):
        published = run("dimensions_first", earlier, first_day)
        if phase == "dimensions_update":
            published = run(phase, later, second_day)
    else:
        run("dimensions_first", later, first_day)
        published = run("facts_first", later if phase == "facts_first" else _loaded_earlier(area, spark, directory, later), first_day)
        if phase == "facts_update":
            warehouse.advance(HR_CONTROL, HR_LAST_LOAD)
            published = run(phase, later, HR_RUN_DATE if area == "hr" else second_day)
    tables = [name for name in published if name != HR_CONTROL and (phase != "dimensions_update" or area == "finance" or not name.startswith("DimDate"))]
    return quality.row_counts({name: warehouse.table(name) for name in tables})


def _two_nights(spark, directory):
    """HR facts by source row after a first load, a nightly update and the same update again; each row counts once."""
    s, warehouse = _written_parents("hr", Sources(spark, directory)), FolderWarehouse()
    before = Sources(spark, directory, "v1")
    before = Overlay(before, Employee=stored(before["Employee"], "Employee_v1"))
    early = Overlay(_loaded_earlier("hr", spark, directory, s), Employee=before["Employee"])
    for step, sources, day in [
        ("dimensions_first", before, HR_RUN_1), ("facts_first", early, HR_LAST_LOAD), ("facts_update", s, HR_RUN_DATE), ("facts_update", s, HR_RUN_DATE),
    ]:
        run_load(f"hr_{step}", Run(spark, warehouse, sources, day, calendar=(CALENDAR_START, CALENDAR_END)))
    result = None
    for fact, source_id in [("FactTermination", "TerminationID"), ("FactSalaryPayment", "SalaryPaymentID"), ("FactEmployeeAttendance", "AttendanceID")]:
        rows = warehouse.table(fact).groupBy(F.col(f"Source{source_id}").cast("string").alias("SourceID")).agg(F.count(F.lit(1)).alias("FactRows"))
        rows = rows.select(F.lit(fact).alias("Fact"), "SourceID", "FactRows")
        result = rows if result is None else result.unionByName(rows)
    return result


def _shifted_days(spark, directory):
    """Payments per day after whole loads of invoices and payments dated 36 years later: the calendar covers them."""
    s, warehouse = Sources(spark, directory), MemoryWarehouse()
    later = lambda table, *days: s[table].withColumns({c: F.add_months(c, 12 * 36) for c in days})
    moved = Overlay(s, Invoice=later("Invoice", "InvoiceDate", "DueDate"), Payment=later("Payment", "PaymentDate"))
    for step in ("dimensions_first", "facts_first"):
        run_load(f"finance_{step}", Run(spark, warehouse, moved, FINANCE_RUN_1))
    rows = warehouse.table("FactCustomerPaymentTransaction").join(warehouse.table("DimDate"), "DimDateID")
    return flat(rows.groupBy("FullDate").agg(F.count(F.lit(1)).alias("Payments"), F.sum("PaymentAmount").alias("Paid")))


def _loaded_earlier(area, spark, directory, s):
    """The sources ``s`` as the first fact load saw them."""
    facts = MARTS[area].FACTS
    replaced = {t: adapter.source(spark, directory, f"{t}_v1") for f in facts if f in _EARLIER for t in _EARLIER[f]}
    replaced |= {t: in_window(s[t], day, "1900-01-01", HR_LAST_LOAD) for f, (t, day) in _HIGH_WATER.items() if f in facts}
    return Overlay(s, **replaced)


def snake(name: str) -> str:
    name = name.removeprefix("Dim").removeprefix("Fact")
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).strip("_")


FACT_QUERY = {
    "FactInvoiceLineTransaction": "invoice_line",
    "FactCustomerPaymentTransaction": "customer_payment",
    "FactCustomerBillingMonthlySnapshot": "billing_snapshot",
    "FactInvoiceLifecycleAccumulating": "invoice_lifecycle",
    "FactCustomerContractActivationFactless": "contract_activation",
    "FactTermination": "termination",
    "FactSalaryPayment": "salary_payment",
    "FactEmployeeAttendance": "employee_attendance",
    "FactMonthlyEmployeePerformance": "monthly_performance",
    "FactEmployeeLifecycle": "employee_lifecycle",
    "FactCargoOperationTransactional": "cargo_operation",
    "FactPortCallPeriodicSnapshot": "port_call_snapshot",
    "FactContainerMovementsAcc": "container_movements",
    "FactEquipmentAssignment": "equipment_assignment",
}


def registry() -> dict:
    found = {f"stage_{name}": partial(_staging, name) for name in STAGES}
    found |= {f"staged_{name}": partial(_staged, name) for name in STAGES}
    found["dim_date_first"] = partial(_calendar_first, "DimDateID", False)
    found["dim_date_hr_first"] = partial(_calendar_first, "DateKey", True)
    found["dim_date_update"] = _calendar_update
    found["dim_date_missing_days"] = _calendar_gaps
    for mart, module in MARTS.items():
        for name in module.DIMENSIONS:
            found[f"dim_{snake(name)}_first"] = partial(_dimension_first, mart, name)
            found[f"dim_{snake(name)}_update"] = partial(_dimension_update, mart, name)
        for name in module.FACTS:
            found[f"fact_{FACT_QUERY[name]}_first"] = partial(_fact_first, mart, name)
            found[f"fact_{FACT_QUERY[name]}_update"] = partial(_fact_update, mart, name)
    found["fact_billing_snapshot_reference_grain"] = partial(_fact_first, "finance", "FactCustomerBillingMonthlySnapshot", reference_grain=True)
    found["fact_invoice_line_update_reference_keys"] = partial(_fact_update, "finance", "FactInvoiceLineTransaction", reference_keys=True)
    found["fact_yearly_headcount"] = lambda spark, sf: flat(
        hr.yearly_headcount(Sources(spark, sf), Dimensions(spark, sf, "hr"), HEADCOUNT_YEAR)
    )
    for mart, module in MARTS.items():
        for name in module.SIGNATURES | module.FOLLOWED:
            found[f"fact_{FACT_QUERY[name]}_after_corrections"] = partial(_after_corrections, mart, name)
    for mart in LOST_PARENTS:
        found[f"rejects_{mart}"] = partial(_rejects, mart)
    found["fact_invoice_lifecycle_by_month"] = _lifecycle_by_month
    found["dim_invoice_by_month"] = _invoice_members_by_month
    found["fact_container_movements_after_corrections"] = _movements_after_corrections
    for area in MARTS:
        for phase in ("staging", "dimensions_first", "dimensions_update", "facts_first", "facts_update"):
            found[f"load_{area}_{phase}"] = partial(_load, area, phase)
    found["hr_facts_after_two_nights"] = _two_nights
    found["finance_payments_shifted_days"] = _shifted_days
    found["row_counts"] = _row_counts
    found["orphan_report"] = _orphan_report
    found["referential_report"] = _referential_report
    for mart in MARTS:
        found[f"referential_report_{mart}_facts"] = partial(_fact_references, mart)
    found["staging_reconciliation"] = _reconciliation
    found["declared_types_finance_staging"] = _declared_staging
    found["declared_types_finance_marts"] = _declared_marts
    found["bulk_load_payments"] = _bulk_load_payments
    found["report_top_invoice_lines"] = _top_lines
    found["report_latest_payments"] = _latest_payments
    found["report_dimension_sizes"] = _dimension_sizes
    found["duplicate_keys"] = _duplicate_keys
    found["container_movement_gaps"] = _container_gaps
    found["asof_lookup"] = _asof_lookup
    found["interval_lookup"] = _interval_lookup
    found["surrogate_keys"] = _surrogate_keys
    found["current_versions"] = _current_versions
    return found
