"""Plain SQL statements of what every registered query must return, for the DuckDB correctness check.

Written from the load definitions, not from the Spark plans: dimension updates are joins here, snapshots count
distinct ids over the raw line rows, as-of lookups are correlated maxima. Names in the text resolve by prefix:
``a_`` operational tables, ``e_`` dimensions after the first load, ``u_`` after the update with their change
types, ``d_`` dimensions as the facts see them, ``v_`` a versioned dimension by the day each version applies from.
"""

import re

from dockside.operators.keys import BUCKETS
from dockside.plans import declarations, finance, hr, port
from dockside.plans.links import FACT_KEYS, SOURCE_LINKS
from dockside.plans.staging import STAGES
from dockside.queries import _EARLIER, FACT_QUERY, HEADCOUNT_YEAR, HR_LAST_LOAD, HR_RUN_DATE, MARTS, RUN_DATES, STAGED_AT, snake
from dockside.sources.adapter import CALENDAR_END, CALENDAR_START, SOURCES, with_clause

MART_OF = {name: mart for mart, module in MARTS.items() for name in module.DIMENSIONS}


# --- dimensions -------------------------------------------------------------------------------------------------

def _table(name: str, version: str) -> str:
    return f"a_{name}_v1" if version == "v1" and f"{name}_v1" in SOURCES else f"a_{name}"


def dimension_source(name: str, version: str) -> str:
    t = lambda table: _table(table, version)
    special = {
        "DimCustomer": f"select c.*, n.CountryName from {t('Customer')} c left join a_Country n on c.CountryID = n.CountryID",
        "DimServiceType": f"select *, ServiceTypeID as SourceServiceTypeID from {t('ServiceType')}",
        "DimPaymentMethod": f"select distinct PaymentMethod as PaymentMethodName from {t('Payment')}",
        "DimContract": f"select *, StartDate as StartDateActual, EndDate as EndDateActual from {t('Contract')}",
        "DimInvoice": f"select *, Status as InvoiceStatus from {t('Invoice')}",
        "DimDepartment": f"select x.*, m.FullName as ManagerName from {t('Department')} x left join {t('Employee')} m on x.ManagerID = m.EmployeeID",
        "DimJobTitle": f"select *, JobCategory as CurrentJobCategory from {t('JobTitle')}",
        "DimTerminationReason": f"select distinct TerminationReason from {t('Termination')}",
        "DimContainer": f"select *, OwnerCompany as Current_OwnerCompany from {t('Container')}",
        "DimPortEmployee": f"select * from {t('Employee')}",
    }
    return special.get(name, f"select * from {t(name.removeprefix('Dim'))}")


def _spec(name):
    return MARTS[MART_OF[name]].DIMENSIONS[name]


def _digest(dim, alias=""):
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(cast({alias}{c} as varchar), '')" for c in dim.business_key) + "))"


def _number(dim, after="0", alias=""):
    digest = _digest(dim, alias)
    bucket = f"cast('0x' || substr({digest}, 1, 3) as bigint)"
    return f"{after} + (row_number() over (partition by {bucket} order by {digest}) - 1) * {BUCKETS} + {bucket} + 1"


def _opening(dim, run_date, alias="s."):
    """Values of a member's first row, by column (key excluded)."""
    values = {c: f"{alias}{c}" for c in (*dim.business_key, *dim.attributes)}
    values |= {c: "1" if v is True else str(v) for c, v in dim.constants.items()}
    for older in dim.chain[1:]:
        values[older] = f"{alias}{dim.chain[0]}" if dim.seed_chain else "cast(null as varchar)"
    if dim.stamp:
        values[dim.stamp] = f"date '{run_date}'"
    if dim.kind == "versioned":
        values |= {dim.start: f"{alias}{dim.first_start}" if dim.first_start else f"date '{run_date}'", dim.end: "cast(null as date)", dim.current: "true"}
    return values


def _select(values: dict) -> str:
    return ", ".join(f"{v} as {c}" for c, v in values.items())


def _literal(value):
    if isinstance(value, bool):
        return str(value).lower()
    return f"{value}" if isinstance(value, int) else f"'{value}'" if isinstance(value, str) else f"date '{value}'"


def first_sql(name: str, version: str, run_date: str) -> str:
    dim = _spec(name)
    text = f"select {_number(dim, alias='s.')} as {dim.key}, {_select(_opening(dim, run_date))} from ({dimension_source(name, version)}) s"
    if dim.unknown:
        row = {c: _literal(dim.unknown[c]) if c in dim.unknown else "null" for c in dim.columns[1:]}
        text += f" union all by name select -1 as {dim.key}, {_select(row)}"
    return text


def update_sql(name: str) -> str:
    dim, run_date = _spec(name), RUN_DATES[MART_OF[name]][1]
    today = f"date '{run_date}'"
    live = f"(select * from e_{name} where {dim.current})" if dim.kind == "versioned" else f"e_{name}"
    on = " and ".join(f"o.{c} = s.{c}" for c in dim.business_key)

    def differ(columns):
        if dim.null_equals_blank:
            return "(" + " or ".join(f"coalesce(cast(o.{c} as varchar), '') <> coalesce(cast(s.{c} as varchar), '')" for c in columns) + ")"
        return "(" + " or ".join(f"o.{c} is distinct from s.{c}" for c in columns) + ")"

    tracked = dim.tracked or dim.attributes
    hit = f"s.{dim.business_key[0]} is not null"
    changed = f"({hit} and {differ(tracked)})" if tracked and dim.kind != "insert_only" else "false"
    moved = f"({hit} and {differ(dim.chain[:1])})" if dim.chain else "false"
    expire = f"({changed} and o.{dim.start} < {today})" if dim.kind == "versioned" else "false"
    old = {c: f"o.{c}" for c in dim.columns}
    for c in dim.attributes:
        if dim.kind == "overwrite":
            old[c] = f"case when {changed} then s.{c} else o.{c} end"
        elif dim.kind == "versioned":
            old[c] = f"case when {changed} and not {expire} then s.{c} else o.{c} end"
        elif dim.kind == "previous_value" and c in (*dim.tracked, dim.chain[0]):
            old[c] = f"case when {changed} then s.{c} else o.{c} end"
    for newer, older in zip(dim.chain, dim.chain[1:]):
        old[older] = f"case when {moved} then o.{newer} else o.{older} end"
    if dim.stamp:
        old[dim.stamp] = f"case when {moved} then {today} else o.{dim.stamp} end"
    if dim.kind == "versioned":
        old[dim.end] = f"case when {expire} then {today} + {dim.end_offset_days} else o.{dim.end} end"
        old[dim.current] = f"not {expire}"
    change = f"case when {expire} then 'expired' when {changed} then 'updated' else 'kept' end"
    source = f"({dimension_source(name, 'v2')}) s"
    parts = [f"select {_select(old)}, {change} as ChangeType from {live} o left join {source} on {on}"]
    opening = _opening(dim, run_date)
    fresh = f"select s.*, true as _new from {source} left join {live} o on {on} where o.{dim.key} is null"
    if dim.kind == "versioned":
        fresh += f" union all select s.*, false as _new from {source} join {live} o on {on} where {expire}"
        if dim.first_start:
            opening[dim.start] = f"case when s._new then s.{dim.first_start} else {today} end"
        parts.append(f"select {_select({c: c for c in dim.columns})}, 'kept' as ChangeType from e_{name} where not {dim.current}")
    top = f"(select greatest(max({dim.key}), 0) from e_{name})"
    parts.append(f"select {_number(dim, top, 's.')} as {dim.key}, {_select(opening)}, 'inserted' as ChangeType from ({fresh}) s")
    return " union all by name ".join(f"({p})" for p in parts)


def _versions(name: str, start: str) -> str:
    """Versions by the day they apply from; the first one applies from the beginning of time."""
    dim = _spec(name)
    first = f"row_number() over (partition by {', '.join(dim.business_key)} order by {start}) = 1"
    return f"select *, case when {first} then date '0001-01-01' else {start} end as valid_from from d_{name}"


_DAYS = f"""select cast(t.day as date) as FullDate, row_number() over (order by t.day) as DateKey, row_number() over (order by t.day) as DimDateID
from (select unnest(generate_series(date '{CALENDAR_START}', date '{CALENDAR_END}', interval 1 day)) as day) t"""

_CALENDAR_COLUMNS = """year(FullDate) as Year, quarter(FullDate) as Quarter, month(FullDate) as Month, monthname(FullDate) as MonthName, day(FullDate) as Day,
isodow(FullDate) as DayOfWeek, dayname(FullDate) as DayName, (dayofyear(FullDate) - 1 + isodow(cast(date_trunc('year', FullDate) as date)) - 1) // 7 + 1 as WeekOfYear,
case when isodow(FullDate) >= 6 then 1 else 0 end as IsWeekend"""


def _cte(name: str) -> str:
    """Text behind a prefixed name other than ``a_``."""
    kind, table = name.split("_", 1)
    if table == "Days":
        return _DAYS
    run_1 = RUN_DATES[MART_OF[table]][0]
    if kind == "e":
        return first_sql(table, "v1", run_1)
    if kind == "u":
        return update_sql(table)
    if kind == "d":
        if _spec(table).kind == "versioned":
            return f"select {', '.join(_spec(table).columns)} from u_{table}"
        return first_sql(table, "v2", run_1)
    return _versions(table, _spec(table).start)


def _declared(table: str, relation: str, columns: str, lacking=()) -> str:
    """Counts of values that the declared columns of ``relation`` cannot hold, one row per column."""
    parts = []
    for text in re.split(r", (?=[A-Z])", columns):
        name, kind = text.removesuffix(" not null").split(" ", 1)
        value = "null" if name in lacking else name
        as_kind = "varchar" if kind.startswith("varchar") else {"timestamp_ntz": "timestamp"}.get(kind, kind)
        held = f"try_cast({value} as {as_kind})"
        long = f"length({held}) > {kind[8:-1]}" if as_kind == "varchar" else "false"
        inexact = f"cast({held} as decimal(38,9)) <> try_cast({value} as decimal(38,9))" if as_kind in ("bigint", "int") or "decimal" in as_kind else "false"
        missing = f"{value} is null" if text.endswith("not null") else "false"
        parts.append(
            f"""select '{table}' as TableName, '{name}' as ColumnName, '{kind}' as DeclaredType, count(*) filter ({missing}) as Missing,
  count(*) filter ({value} is not null and {held} is null) as Unreadable, count(*) filter ({long}) as TooLong, count(*) filter ({inexact}) as Inexact
from ({relation})"""
        )
    return " union all ".join(parts)


def compose(body: str) -> str:
    """Prepend every common table expression the text refers to, directly or not."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b([deuv]_(?:Dim\w+|Days))\b", text)):
            if name not in ordered:
                inner = _cte(name)
                visit(inner)
                ordered.append(name)

    visit(body)
    parts = [f"{name} as materialized ({_cte(name)})" for name in ordered]
    sources = dict.fromkeys(re.findall(r"\ba_(\w+)\b", body + " ".join(parts)))
    if sources:
        parts.insert(0, with_clause(sources))
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# How the checked rows show flags, days and amounts.
_FLAGS = {"IsCurrent", "IsActive", "IsPaid", "Taxable"}
_DATES = {
    "StartDate", "EndDate", "EffectiveFrom", "EffectiveTo", "StartDateActual", "EndDateActual", "CreatedDate", "EffectiveDate",
    "HireDate", "BirthDate", "FullDate", "OperationDateTime", "AttendanceDate",
}
_AMOUNTS = {
    "FactInvoiceLineTransaction": "UnitPrice GrossAmount DiscountPercent NetAmount TaxAmount EffectiveRate",
    "FactCustomerPaymentTransaction": "PaymentAmount RemainingAmount",
    "FactCustomerBillingMonthlySnapshot": "TotalNetAmount TotalTaxAmount TotalDiscount TotalPaid AveragePaymentDelay MaxOutstandingAmount",
    "FactInvoiceLifecycleAccumulating": "TotalAmount PaidAmount OutstandingAmount",
    "FactTermination": "SalaryAtTermination",
    "FactSalaryPayment": "GrossPayAmount BaseAmount BonusAmount DeductionsAmount NetAmount SalaryCostToCompany",
    "FactMonthlyEmployeePerformance": "TotalHoursWorked AverageDailyHoursWorked MinDailyHoursWorked MaxDailyHoursWorked OvertimeAsPercentage",
    "FactEmployeeLifecycle": "FinalSalary",
    "FactCargoOperationTransactional": "WeightKG FullDate OperationDateTime",
    "FactPortCallPeriodicSnapshot": "FullDate",
    "FactYearlyHeadcount": "AverageTenureInMonths TurnoverRate AverageAgeOfEmployees",
}


def _shown(column: str) -> str:
    kind = "int" if column in _FLAGS else "varchar" if column in _DATES else "double"
    return f"cast({column} as {kind}) as {column}"


def _show(text: str, columns) -> str:
    """``text`` with the named columns in the form they are checked in."""
    columns = columns.split() if isinstance(columns, str) else list(columns)
    return f"select * replace ({', '.join(_shown(c) for c in columns)}) from ({text})" if columns else text


def _dimension(prefix: str, name: str) -> str:
    dim = _spec(name)
    columns = dim.columns + (["ChangeType"] if prefix == "u" else [])
    special = [c for c in columns if c in _FLAGS or c in _DATES or c == "TaxRate"]
    return compose(_show(f"select {', '.join(columns)} from {prefix}_{name}", special))


# --- facts ------------------------------------------------------------------------------------------------------
# Each takes t, which maps an operational table to the relation to read.

def _half_up(numerator: str, denominator: str, digits: int, total: int) -> str:
    """numerator / denominator rounded half away from zero, in integers."""
    scaled = f"(2 * abs({numerator}) * {10 ** digits} + ({denominator})) // (2 * ({denominator}))"
    return f"cast(sign({numerator}) * ({scaled}) / {10 ** digits} as decimal({total},{digits}))"


def invoice_lines(t):
    rate = _half_up("cast(l.NetAmount * 100 as hugeint)", "100 * l.Quantity", 4, 18)
    return f"""select di.DimInvoiceID, c.DimCustomerID, sv.DimServiceTypeID, x.DimTaxID, dd.DimDateID, l.Quantity, l.UnitPrice,
  cast(l.Quantity * l.UnitPrice as decimal(18,4)) as GrossAmount, coalesce(l.DiscountPercent, 0) as DiscountPercent, l.NetAmount, l.TaxAmount,
  {rate} as EffectiveRate, l.InvoiceLineID as SourceInvoiceLineID
from {t('InvoiceLine')} l join {t('Invoice')} i on l.InvoiceID = i.InvoiceID join d_DimInvoice di on i.InvoiceNumber = di.InvoiceNumber
join {t('Contract')} ct on i.ContractID = ct.ContractID join {t('Customer')} cu on ct.CustomerID = cu.CustomerID
asof join v_DimCustomer c on cu.CustomerCode = c.CustomerCode and i.InvoiceDate >= c.valid_from
join d_DimServiceType sv on l.ServiceTypeID = sv.SourceServiceTypeID join d_Days dd on i.InvoiceDate = dd.FullDate
asof left join (select a.TaxID, b.* from {t('Tax')} a join v_DimTax b on a.TaxName = b.TaxName and a.TaxType = b.TaxType and a.EffectiveFrom = b.EffectiveFrom) x
  on l.TaxID = x.TaxID and i.InvoiceDate >= x.valid_from"""


def payments(t):
    return f"""select pm.DimPaymentMethodID, di.DimInvoiceID, c.DimCustomerID, dd.DimDateID, p.Amount as PaymentAmount,
  p.PaymentDate - i.InvoiceDate as DaysToPayment, cast(i.TotalAmount - p.Amount as decimal(18,4)) as RemainingAmount,
  case when p.Amount >= i.TotalAmount then 1 else 0 end as IsFullPayment, 0 as PartialPaymentCount, p.PaymentID as SourcePaymentID
from {t('Payment')} p join {t('Invoice')} i on p.InvoiceID = i.InvoiceID join d_DimInvoice di on i.InvoiceNumber = di.InvoiceNumber
join {t('Contract')} ct on i.ContractID = ct.ContractID join {t('Customer')} cu on ct.CustomerID = cu.CustomerID
asof join v_DimCustomer c on cu.CustomerCode = c.CustomerCode and p.PaymentDate >= c.valid_from
join d_DimPaymentMethod pm on p.PaymentMethod = pm.PaymentMethodName join d_Days dd on p.PaymentDate = dd.FullDate"""


def billing_snapshot(t, reference_grain=False):
    cycle = "" if reference_grain else ", ct.BillingCycleID"
    same = "" if reference_grain else " and n.BillingCycleID = p.BillingCycleID"
    month = "cast(date_trunc('month', i.InvoiceDate) as date)"
    repeat = f"join (select CustomerID as OwnerID, BillingCycleID from {t('Contract')}) k on n.CustomerID = k.OwnerID" if reference_grain else ""
    billing = "k.BillingCycleID" if reference_grain else "n.BillingCycleID"
    return f"""select c.DimCustomerID, dd.DimDateID, dbc.DimBillingCycleID, n.TotalInvoiceCount, cast(n.net as decimal(18,4)) as TotalNetAmount,
  cast(n.tax as decimal(18,4)) as TotalTaxAmount, cast(n.discount as decimal(18,4)) as TotalDiscount, cast(coalesce(p.paid, 0) as decimal(18,4)) as TotalPaid,
  cast(coalesce(p.delay, 0) as decimal(10,2)) as AveragePaymentDelay, cast(n.net + n.tax - coalesce(p.paid, 0) as decimal(18,4)) as MaxOutstandingAmount
from (select ct.CustomerID{cycle}, {month} as SnapshotDate, count(distinct i.InvoiceID) as TotalInvoiceCount, sum(l.NetAmount) as net, sum(l.TaxAmount) as tax,
    sum(cast(l.Quantity as decimal(9,0)) * cast(l.UnitPrice as decimal(14,4)) * coalesce(l.DiscountPercent, 0)) as discount
  from {t('InvoiceLine')} l join {t('Invoice')} i on l.InvoiceID = i.InvoiceID join {t('Contract')} ct on i.ContractID = ct.ContractID group by all) n
left join (select ct.CustomerID{cycle}, {month} as SnapshotDate, sum(p.Amount) as paid,
    case when sum(p.PaymentDate - i.InvoiceDate) < 0 then -(abs(sum(p.PaymentDate - i.InvoiceDate)) // count(*)) else sum(p.PaymentDate - i.InvoiceDate) // count(*) end as delay
  from {t('Payment')} p join {t('Invoice')} i on p.InvoiceID = i.InvoiceID join {t('Contract')} ct on i.ContractID = ct.ContractID group by all) p
  on n.CustomerID = p.CustomerID and n.SnapshotDate = p.SnapshotDate{same}
{repeat} join {t('Customer')} cu on n.CustomerID = cu.CustomerID
asof join v_DimCustomer c on cu.CustomerCode = c.CustomerCode and n.SnapshotDate >= c.valid_from
join {t('BillingCycle')} bc on {billing} = bc.BillingCycleID join d_DimBillingCycle dbc on bc.CycleName = dbc.CycleName join d_Days dd on n.SnapshotDate = dd.FullDate"""


def invoice_lifecycle(t):
    return f"""select di.DimInvoiceID, c.DimCustomerID, dc.DimContractID, d1.DimDateID as InvoiceDateID, d2.DimDateID as DueDateID, d3.DimDateID as FirstPaymentDateID,
  d4.DimDateID as FinalPaymentDateID, i.TotalAmount, cast(coalesce(sum(p.Amount), 0) as decimal(18,4)) as PaidAmount,
  cast(i.TotalAmount - coalesce(sum(p.Amount), 0) as decimal(18,4)) as OutstandingAmount, count(p.PaymentID) as PaymentCount,
  w.f - i.InvoiceDate as FirstPaymentDelay, w.l - i.InvoiceDate as FinalPaymentDelay, w.l - i.InvoiceDate as DaysToClose
from {t('Invoice')} i join d_DimInvoice di on i.InvoiceNumber = di.InvoiceNumber join {t('Contract')} ct on i.ContractID = ct.ContractID
join {t('Customer')} cu on ct.CustomerID = cu.CustomerID join d_DimContract dc on ct.ContractNumber = dc.ContractNumber
asof join v_DimCustomer c on cu.CustomerCode = c.CustomerCode and i.InvoiceDate >= c.valid_from
join d_Days d1 on i.InvoiceDate = d1.FullDate join d_Days d2 on i.DueDate = d2.FullDate
left join (select InvoiceID, min(PaymentDate) as f, max(PaymentDate) as l from {t('Payment')} group by InvoiceID) w on i.InvoiceID = w.InvoiceID
left join d_Days d3 on w.f = d3.FullDate left join d_Days d4 on w.l = d4.FullDate left join {t('Payment')} p on i.InvoiceID = p.InvoiceID
group by di.DimInvoiceID, c.DimCustomerID, dc.DimContractID, d1.DimDateID, d2.DimDateID, d3.DimDateID, d4.DimDateID, i.TotalAmount, i.InvoiceDate, w.f, w.l"""


def contract_activations(t):
    return f"""select dd.DimDateID, c.DimCustomerID, dc.DimContractID from {t('Contract')} ct join {t('Customer')} cu on ct.CustomerID = cu.CustomerID
asof join v_DimCustomer c on cu.CustomerCode = c.CustomerCode and ct.StartDate >= c.valid_from
join d_DimContract dc on ct.ContractNumber = dc.ContractNumber join d_Days dd on ct.StartDate = dd.FullDate"""


def _last_history(outer_key: str, day: str, wanted: str, relation: str) -> str:
    """Left join of the last history row on or before ``day``."""
    return f"""left join (select o.{outer_key}, h.*, row_number() over (partition by o.{outer_key} order by h.StartDate desc, h.EmploymentHistoryID desc) as rn
  from {relation} o join a_EmploymentHistory h on h.EmployeeID = o.EmployeeID and h.StartDate <= o.{day}) {wanted} on {wanted}.{outer_key} = o.{outer_key} and {wanted}.rn = 1"""


_EMPLOYEE_ON = "join d_DimEmployee e on o.EmployeeID = e.EmployeeID and o.{day} between e.StartDate and coalesce(e.EndDate, date '9999-12-31')"


def terminations(t):
    rel = t("Termination")
    return f"""select o.TerminationID as SourceTerminationID, dd.DateKey as TerminationDateKey, e.EmployeeKey, coalesce(dp.DepartmentKey, -1) as DepartmentKey, coalesce(j.JobTitleKey, -1) as JobTitleKey,
  coalesce(r.TerminationReasonKey, -1) as TerminationReasonKey, coalesce(o.TerminationDate - f.hired, 0) as TenureInDays,
  coalesce(date_diff('month', f.hired, o.TerminationDate), 0) as TenureInMonths, coalesce(h.Salary, 0) as SalaryAtTermination,
  case when o.TerminationReason in ('Resignation', 'Retirement') then 1 else 0 end as IsVoluntary
from {rel} o {_EMPLOYEE_ON.format(day='TerminationDate')} join d_Days dd on o.TerminationDate = dd.FullDate
{_last_history('TerminationID', 'TerminationDate', 'h', rel)}
left join (select EmployeeID, min(StartDate) as hired from a_EmploymentHistory group by EmployeeID) f on o.EmployeeID = f.EmployeeID
left join d_DimDepartment dp on h.DepartmentID = dp.DepartmentID left join d_DimJobTitle j on h.JobTitleID = j.JobTitleID
left join d_DimTerminationReason r on o.TerminationReason = r.TerminationReason"""


def salary_payments(t):
    rel = t("SalaryPayment")
    return f"""select o.SalaryPaymentID as SourceSalaryPaymentID, dd.DateKey as PaymentDateKey, e.EmployeeKey, coalesce(dp.DepartmentKey, -1) as DepartmentKey, coalesce(j.JobTitleKey, -1) as JobTitleKey,
  cast(o.Amount + coalesce(o.Bonus, 0) as decimal(15,2)) as GrossPayAmount, o.Amount as BaseAmount, coalesce(o.Bonus, 0) as BonusAmount,
  coalesce(o.Deductions, 0) as DeductionsAmount, o.NetAmount, cast((o.Amount + coalesce(o.Bonus, 0)) * 1.23 as decimal(15,2)) as SalaryCostToCompany
from {rel} o {_EMPLOYEE_ON.format(day='PaymentDate')} join d_Days dd on o.PaymentDate = dd.FullDate
{_last_history('SalaryPaymentID', 'PaymentDate', 'h', rel)}
left join d_DimDepartment dp on h.DepartmentID = dp.DepartmentID left join d_DimJobTitle j on h.JobTitleID = j.JobTitleID"""


def attendance(t):
    rel = t("Attendance")
    return f"""select o.AttendanceID as SourceAttendanceID, dd.DateKey as AttendanceDateKey, coalesce(e.EmployeeKey, -1) as EmployeeKey, o.Status as AttendanceStatus
from {rel} o join d_Days dd on o.AttendanceDate = dd.FullDate
left join (select o.AttendanceID, max_by(e.EmployeeKey, e.StartDate) as EmployeeKey from {rel} o
  join d_DimEmployee e on e.EmployeeID = o.EmployeeID and e.StartDate <= o.AttendanceDate group by o.AttendanceID) e on o.AttendanceID = e.AttendanceID"""


def _months(rel: str) -> str:
    return f"""(select EmployeeID, last_day(AttendanceDate) as MonthEndDate, cast(sum(coalesce(HoursWorked, 0)) * 100 as hugeint) as cents, count(*) as n, min(HoursWorked) as lo,
  max(HoursWorked) as hi, count(*) filter (where Status = 'Late') as late, count(*) filter (where Status = 'Absent') as absent,
  EmployeeID as RowID from {rel} group by EmployeeID, last_day(AttendanceDate))"""


def monthly_performance(t):
    rel = _months(t("Attendance"))
    overtime = _half_up("(o.cents - 800 * o.n)", "o.cents", 4, 18)
    employee = f"""left join (select o.RowID, o.MonthEndDate, max_by(e.EmployeeKey, e.StartDate) as EmployeeKey from {rel} o
  join d_DimEmployee e on e.EmployeeID = o.EmployeeID and e.StartDate <= o.MonthEndDate group by all) e on o.RowID = e.RowID and o.MonthEndDate = e.MonthEndDate"""
    return f"""select dd.DateKey as MonthDateKey, coalesce(e.EmployeeKey, -1) as EmployeeKey, coalesce(dp.DepartmentKey, -1) as DepartmentKey,
  cast(o.cents / 100 as decimal(10,2)) as TotalHoursWorked, {_half_up('o.cents', 'o.n * 100', 2, 10)} as AverageDailyHoursWorked,
  cast(o.lo as decimal(10,2)) as MinDailyHoursWorked, cast(o.hi as decimal(10,2)) as MaxDailyHoursWorked, o.late as LateDaysCount, o.absent as AbsentDaysCount,
  o.n as WorkDaysCount, case when o.cents > 0 then {overtime} else 0 end as OvertimeAsPercentage
from {rel} o {employee} join d_Days dd on o.MonthEndDate = dd.FullDate
left join (select o.RowID, o.MonthEndDate, h.DepartmentID, row_number() over (partition by o.RowID, o.MonthEndDate order by h.StartDate desc, h.EmploymentHistoryID desc) as rn
  from {rel} o join a_EmploymentHistory h on h.EmployeeID = o.EmployeeID and h.StartDate <= o.MonthEndDate) h on h.RowID = o.RowID and h.MonthEndDate = o.MonthEndDate and h.rn = 1
left join d_DimDepartment dp on h.DepartmentID = dp.DepartmentID"""


def employee_lifecycle(t, employees="d_DimEmployee"):
    return f"""select e.EmployeeKey, coalesce(d1.DateKey, -1) as HireDateKey, case when x.TerminationDate is not null then coalesce(d2.DateKey, -1) end as TerminationDateKey,
  coalesce(d3.DateKey, -1) as LastTrainingDateKey, case when x.TerminationDate is not null then coalesce(r.TerminationReasonKey, -1) end as TerminationReasonKey,
  case when x.TerminationDate > h.hired then x.TerminationDate - h.hired end as DaysToTermination, coalesce(h.n - 1, 0) as TotalPromotionsCount,
  coalesce(tr.n, 0) as TotalTrainingsCompleted, h.salary as FinalSalary
from {t('Employee')} m join {employees} e on m.EmployeeID = e.EmployeeID and e.IsCurrent left join d_Days d1 on m.HireDate = d1.FullDate
left join {t('Termination')} x on m.EmployeeID = x.EmployeeID left join d_Days d2 on x.TerminationDate = d2.FullDate
left join d_DimTerminationReason r on x.TerminationReason = r.TerminationReason
left join (select EmployeeID, count(*) as n, max(TrainingDate) as last from {t('EmployeeTraining')} group by EmployeeID) tr on m.EmployeeID = tr.EmployeeID
left join d_Days d3 on tr.last = d3.FullDate
left join (select EmployeeID, count(*) as n, min(StartDate) as hired,
    (select z.Salary from a_EmploymentHistory z where z.EmployeeID = y.EmployeeID order by z.StartDate desc, z.EmploymentHistoryID desc limit 1) as salary
  from a_EmploymentHistory y group by EmployeeID) h on m.EmployeeID = h.EmployeeID"""


def cargo_operations(t):
    return f"""select dd.DateKey, dd.FullDate, sh.ShipSK, dp.PortSK, dc.ContainerSK, de.EquipmentSK, coalesce(em.EmployeeSK, -1) as EmployeeSK, co.OperationType, co.Quantity,
  cast(co.WeightKG as decimal(10,2)) as WeightKG, co.OperationDateTime, oa.AssignmentID as SourceAssignmentID
from {t('CargoOperation')} co join {t('PortCall')} pc on co.PortCallID = pc.PortCallID join {t('Voyage')} vo on pc.VoyageID = vo.VoyageID
join d_Days dd on cast(co.OperationDateTime as date) = dd.FullDate asof join v_DimShip sh on vo.ShipID = sh.ShipID and dd.FullDate >= sh.valid_from
join d_DimPort dp on pc.PortID = dp.PortID join d_DimContainer dc on co.ContainerID = dc.ContainerID join {t('OperationEquipmentAssignment')} oa on co.CargoOpID = oa.CargoOpID
join d_DimEquipment de on oa.EquipmentID = de.EquipmentID asof left join v_DimPortEmployee em on oa.EmployeeID = em.EmployeeID and dd.FullDate >= em.valid_from"""


def port_call_snapshot(t):
    return f"""select dd.DateKey, dd.FullDate, pc.PortCallID, pc.VoyageID, dp.PortSK, coalesce(ba.BerthID, -1) as BerthID, pc.Status,
  count(distinct ba.AllocationID) as AllocationCount, count(distinct co.CargoOpID) as TotalOps
from {t('PortCall')} pc join d_Days dd on cast(pc.ArrivalDateTime as date) = dd.FullDate join d_DimPort dp on pc.PortID = dp.PortID
left join {t('BerthAllocation')} ba on pc.PortCallID = ba.PortCallID left join {t('CargoOperation')} co on pc.PortCallID = co.PortCallID
group by dd.DateKey, dd.FullDate, pc.PortCallID, pc.VoyageID, dp.PortSK, ba.BerthID, pc.Status"""


def container_movements(t):
    return f"""select dp.PortSK, c.ContainerTypeID, cast(sum(case when co.OperationType = 'LOAD' then co.Quantity else 0 end) as bigint) as TotalLoads,
  cast(sum(case when co.OperationType = 'UNLOAD' then co.Quantity else 0 end) as bigint) as TotalUnloads, cast(sum(co.Quantity) as bigint) as TotalTEU
from {t('CargoOperation')} co join {t('PortCall')} pc on co.PortCallID = pc.PortCallID join {t('Container')} c on co.ContainerID = c.ContainerID
join d_DimPort dp on pc.PortID = dp.PortID group by dp.PortSK, c.ContainerTypeID"""


def equipment_assignments(t):
    return f"""select dd.DateKey, de.EquipmentSK, coalesce(em.EmployeeSK, -1) as EmployeeSK, dp.PortSK, dc.ContainerTypeID, oa.AssignmentID as SourceAssignmentID
from {t('OperationEquipmentAssignment')} oa join {t('CargoOperation')} co on oa.CargoOpID = co.CargoOpID join {t('PortCall')} pc on co.PortCallID = pc.PortCallID
join d_Days dd on cast(oa.StartTime as date) = dd.FullDate join d_DimEquipment de on oa.EquipmentID = de.EquipmentID join d_DimPort dp on pc.PortID = dp.PortID
join d_DimContainer dc on co.ContainerID = dc.ContainerID
asof left join v_DimPortEmployee em on oa.EmployeeID = em.EmployeeID and dd.FullDate >= em.valid_from"""


FACT_SQL = {
    "FactInvoiceLineTransaction": invoice_lines, "FactCustomerPaymentTransaction": payments, "FactCustomerBillingMonthlySnapshot": billing_snapshot,
    "FactInvoiceLifecycleAccumulating": invoice_lifecycle, "FactCustomerContractActivationFactless": contract_activations,
    "FactTermination": terminations, "FactSalaryPayment": salary_payments, "FactEmployeeAttendance": attendance,
    "FactMonthlyEmployeePerformance": monthly_performance, "FactEmployeeLifecycle": employee_lifecycle,
    "FactCargoOperationTransactional": cargo_operations, "FactPortCallPeriodicSnapshot": port_call_snapshot,
    "FactContainerMovementsAcc": container_movements, "FactEquipmentAssignment": equipment_assignments,
}


def _now(table):
    return f"a_{table}"


def _before(*tables):
    return lambda table: f"a_{table}_v1" if table in tables else f"a_{table}"


def _dated(table, day, condition):
    return lambda name: f"(select * from a_{table} where {day} {condition})" if name == table else f"a_{name}"


def _kept_and_new(old: str, new: str, keys) -> str:
    """Old rows, and the new ones whose keys the old do not have."""
    match = " and ".join(f"n.{k} = o.{k}" for k in keys)
    return f"""select *, 'kept' as ChangeType from ({old}) union all by name
select n.*, 'inserted' as ChangeType from ({new}) n where not exists (select 1 from ({old}) o where {match})"""


def _fact_updates(before=None) -> dict:
    """``before`` maps tables to their state at the first load; by default only the fact's own tables differ."""
    _before_of = lambda *tables: before or _before(*tables)
    found = {}
    lines = _before_of("InvoiceLine")
    found["FactInvoiceLineTransaction"] = _kept_and_new(invoice_lines(lines), invoice_lines(_now), ["SourceInvoiceLineID"])
    found["FactCustomerPaymentTransaction"] = _kept_and_new(payments(_before_of("Payment")), payments(_now), ["SourcePaymentID"])
    old_months = billing_snapshot(_before_of("Invoice"))
    closed = f"""(select DimDateID from d_Days where FullDate < (select max(x.FullDate) from ({old_months}) o join d_Days x on o.DimDateID = x.DimDateID))"""
    found["FactCustomerBillingMonthlySnapshot"] = f"""select *, 'kept' as ChangeType from ({old_months}) where DimDateID in {closed} union all by name
select n.*, 'inserted' as ChangeType from ({billing_snapshot(_now)}) n where n.DimDateID not in {closed} or not exists (select 1 from ({old_months}) o
  where o.DimCustomerID = n.DimCustomerID and o.DimDateID = n.DimDateID and o.DimBillingCycleID = n.DimBillingCycleID)"""
    found["FactCustomerContractActivationFactless"] = _kept_and_new(
        contract_activations(_before_of("Contract")), contract_activations(_now), ["DimDateID", "DimCustomerID", "DimContractID"]
    )
    moving = ["FirstPaymentDateID", "FinalPaymentDateID", "PaidAmount", "OutstandingAmount", "PaymentCount", "FirstPaymentDelay", "FinalPaymentDelay", "DaysToClose"]
    fixed = ["DimInvoiceID", "DimCustomerID", "DimContractID", "InvoiceDateID", "DueDateID", "TotalAmount"]
    differ = " or ".join(f"o.{c} is distinct from n.{c}" for c in moving)
    found["FactInvoiceLifecycleAccumulating"] = f"""select {', '.join(f'coalesce(o.{c}, n.{c}) as {c}' for c in fixed)},
  {', '.join(f'case when n.DimInvoiceID is null then o.{c} else n.{c} end as {c}' for c in moving)},
  case when o.DimInvoiceID is null then 'inserted' when n.DimInvoiceID is not null and ({differ}) then 'updated' else 'kept' end as ChangeType
from ({invoice_lifecycle(_before_of('Invoice', 'Payment'))}) o full join ({invoice_lifecycle(_now)}) n on o.DimInvoiceID = n.DimInvoiceID"""
    loaded, window = f"<= date '{HR_LAST_LOAD}'", f"between date '{HR_LAST_LOAD}' + 1 and date '{HR_RUN_DATE}'"
    for fact, table, day, old, new in [
        ("FactTermination", "Termination", "TerminationDate", terminations, terminations),
        ("FactSalaryPayment", "SalaryPayment", "PaymentDate", salary_payments, salary_payments),
        ("FactEmployeeAttendance", "Attendance", "AttendanceDate", attendance, attendance),
    ]:
        found[fact] = f"""select *, 'kept' as ChangeType from ({old(_dated(table, day, loaded))}) union all by name
select *, 'inserted' as ChangeType from ({new(_dated(table, day, window))})"""
    month = f"date_trunc('month', date '{HR_RUN_DATE}')"
    found["FactMonthlyEmployeePerformance"] = f"""select *, 'kept' as ChangeType from ({monthly_performance(_dated('Attendance', 'AttendanceDate', loaded))})
where MonthDateKey < (select min(DateKey) from d_Days where FullDate >= {month}) union all by name
select *, 'inserted' as ChangeType from ({monthly_performance(_dated('Attendance', 'AttendanceDate', f'>= {month}'))})"""
    found["FactEmployeeLifecycle"] = _lifecycle_update()
    found["FactCargoOperationTransactional"] = _kept_and_new(
        cargo_operations(_before_of("CargoOperation", "OperationEquipmentAssignment")), cargo_operations(_now), ["SourceAssignmentID"]
    )
    found["FactEquipmentAssignment"] = _kept_and_new(
        equipment_assignments(_before_of("CargoOperation", "OperationEquipmentAssignment")), equipment_assignments(_now), ["SourceAssignmentID"]
    )
    found["FactContainerMovementsAcc"] = f"select *, 'inserted' as ChangeType from ({container_movements(_now)})"
    old_calls = port_call_snapshot(_before_of("PortCall"))
    found["FactPortCallPeriodicSnapshot"] = f"""select *, 'kept' as ChangeType from ({old_calls})
where cast(FullDate as date) < (select max(FullDate) from ({old_calls})) union all by name
select *, 'inserted' as ChangeType from ({port_call_snapshot(_now)}) where FullDate >= (select max(FullDate) from ({old_calls}))
  or PortCallID not in (select PortCallID from ({old_calls}))"""
    return found


def _lifecycle_update() -> str:
    old = employee_lifecycle(_before("Employee", "Termination", "EmployeeTraining"), "e_DimEmployee")
    return f"""with old as ({old}), step1 as (
  select *, false as added from old union all by name
  select e.EmployeeKey, coalesce(dd.DateKey, -1) as HireDateKey, 0 as TotalPromotionsCount, 0 as TotalTrainingsCompleted, true as added
  from d_DimEmployee e join a_Employee m on e.EmployeeID = m.EmployeeID left join d_Days dd on m.HireDate = dd.FullDate
  where e.IsCurrent and e.EmployeeKey not in (select EmployeeKey from old)),
gone as (select x.EmployeeID, x.TerminationDate, coalesce(dd.DateKey, -1) as dk, coalesce(r.TerminationReasonKey, -1) as rk,
    (select h.Salary from a_EmploymentHistory h where h.EmployeeID = x.EmployeeID and h.StartDate <= x.TerminationDate order by h.StartDate desc, h.EmploymentHistoryID desc limit 1) as salary
  from a_Termination x left join d_Days dd on x.TerminationDate = dd.FullDate left join d_DimTerminationReason r on x.TerminationReason = r.TerminationReason),
trained as (select EmployeeID, count(*) as n, coalesce(max(dd.DateKey), -1) as dk from a_EmployeeTraining x left join d_Days dd on x.TrainingDate = dd.FullDate group by EmployeeID),
joined as (select s.*, g.TerminationDate, g.dk as g_dk, g.rk, g.salary, hd.FullDate as hired, t.n as t_n, t.dk as t_dk,
    s.TerminationDateKey is null and g.TerminationDate is not null and hd.FullDate is not null as leaves,
    t.n is not null and (coalesce(s.LastTrainingDateKey, -1) <> t.dk or coalesce(s.TotalTrainingsCompleted, 0) <> t.n) as trains
  from step1 s left join d_DimEmployee e on s.EmployeeKey = e.EmployeeKey left join gone g on e.EmployeeID = g.EmployeeID
  left join trained t on e.EmployeeID = t.EmployeeID left join d_Days hd on s.HireDateKey = hd.DateKey)
select EmployeeKey, HireDateKey, case when leaves then g_dk else TerminationDateKey end as TerminationDateKey, case when trains then t_dk else LastTrainingDateKey end as LastTrainingDateKey,
  case when leaves then rk else TerminationReasonKey end as TerminationReasonKey, case when leaves then TerminationDate - hired else DaysToTermination end as DaysToTermination,
  TotalPromotionsCount, case when trains then t_n else TotalTrainingsCompleted end as TotalTrainingsCompleted, case when leaves then salary else FinalSalary end as FinalSalary,
  case when added then 'inserted' when leaves or trains then 'updated' else 'kept' end as ChangeType from joined"""


def yearly_headcount() -> str:
    in_department = "select distinct x.EmployeeID from a_EmploymentHistory x where x.DepartmentID = dp.DepartmentID"
    leavers = f"(select count(distinct x.EmployeeID) from a_Termination x where year(x.TerminationDate) = y.Year {{extra}} and x.EmployeeID in ({in_department}))"
    return f"""with years as (select year(FullDate) as Year, DateKey from d_Days where month(FullDate) = 12 and day(FullDate) = 31
  and year(FullDate) between (select min(year(HireDate)) from a_Employee) and {HEADCOUNT_YEAR}),
stays as (select EmployeeID, DepartmentID, year(StartDate) as first, coalesce(year(EndDate), 9999) as last from a_EmploymentHistory)
select y.DateKey as YearDateKey, dp.DepartmentKey,
  (select count(distinct EmployeeID) from stays s where s.DepartmentID = dp.DepartmentID and s.first < y.Year and s.last >= y.Year) as HeadcountStartOfYear,
  (select count(distinct EmployeeID) from stays s where s.DepartmentID = dp.DepartmentID and s.first <= y.Year and s.last > y.Year) as HeadcountEndOfYear,
  (select count(*) from a_Employee m where year(m.HireDate) = y.Year and m.EmployeeID in ({in_department})) as HiresCount,
  {leavers.format(extra='')} as TerminationsCount, {leavers.format(extra="and x.TerminationReason in ('Resignation', 'Retirement')")} as VoluntaryTerminationsCount,
  {leavers.format(extra="and x.TerminationReason not in ('Resignation', 'Retirement')")} as InvoluntaryTerminationsCount,
  cast(coalesce((select trunc(avg((y.Year - year(m.HireDate)) * 12 + 12 - month(m.HireDate))) from stays s join a_Employee m on s.EmployeeID = m.EmployeeID
    where s.DepartmentID = dp.DepartmentID and y.Year between s.first and s.last), 0) as decimal(10,2)) as AverageTenureInMonths, cast(0 as decimal(5,4)) as TurnoverRate,
  cast(coalesce((select trunc(avg(y.Year - year(m.BirthDate))) from stays s join a_Employee m on s.EmployeeID = m.EmployeeID
    where s.DepartmentID = dp.DepartmentID and y.Year between s.first and s.last), 0) as decimal(10,2)) as AverageAgeOfEmployees
from years y cross join d_DimDepartment dp where dp.DepartmentKey <> -1"""


# --- checks -----------------------------------------------------------------------------------------------------

def _missing(column, blank):
    return f"({column} is null or trim({column}) = '')" if blank else f"{column} is null"


def staging_report(spec) -> str:
    relation = f"a_{spec.table}"
    tests = {c: _missing(c, c in spec.non_blank) for c in spec.required}
    parts = [f"select 'rows' as CheckName, '*' as Columns, count(*) as Rows from {relation}"]
    parts += [f"select 'missing', '{c}', count(*) from {relation} where {test}" for c, test in tests.items()]
    parts.append(f"select 'missing_any', '{','.join(spec.required)}', count(*) from {relation} where {' or '.join(tests.values())}")
    parts.append(f"select 'duplicate_keys', '{spec.key[0]}', count(*) from (select 1 from {relation} group by {spec.key[0]} having count(*) > 1)")
    return compose(" union all ".join(parts))


def staged_rows(spec) -> str:
    widened = ", ".join(f"cast({c} as {t.replace('timestamp_ntz', 'timestamp').replace('string', 'varchar')}) as {c}" for c, t in spec.types.items())
    rows = f"select * replace ({widened}) from a_{spec.table}" if widened else f"select * from a_{spec.table}"
    stamp = f", '{STAGED_AT}' as LoadDate" if spec.load_date else ""
    return compose(f"select columns(*)::varchar{stamp} from ({rows})")


def _calendar(start: str, end: str, key: str, first: str = "1") -> str:
    return f"select row_number() over (order by FullDate) - 1 + {first} as {key}, FullDate, {_CALENDAR_COLUMNS} from (select cast(unnest(generate_series(cast({start} as timestamp), cast({end} as timestamp), interval 1 day)) as date) as FullDate)"


def _span(bounds: str) -> tuple[str, str]:
    return f"(select date_trunc('month', min(d)) from ({bounds}))", f"(select last_day(max(d)) from ({bounds}))"


def _calendars() -> dict:
    invoice = "select InvoiceDate as d from a_Invoice"
    payment = "select PaymentDate from a_Payment"
    present = "select AttendanceDate as d from a_Attendance"
    fin, hrs = _span(f"{invoice} union all {payment}"), _span(f"{present} union all select StartDate from a_EmploymentHistory")
    unknown = """select -1 as DateKey, date '1900-01-01' as FullDate, 1900 as Year, 0 as Quarter, 0 as Month, 'Unknown' as MonthName, 0 as Day, 0 as DayOfWeek,
  'Unknown' as DayName, 0 as WeekOfYear, 0 as IsWeekend"""
    first, last = _span(invoice)
    gaps = _span(f"{payment.replace('PaymentDate', 'PaymentDate as d')} union all {present}")
    absent = f"""select unnest(generate_series(cast({gaps[0]} as timestamp), cast({gaps[1]} as timestamp), interval 1 day)) as x
  except select unnest(generate_series(cast({first} as timestamp), cast({last} as timestamp), interval 1 day))"""
    used = f"(select count(*) from (select unnest(generate_series(cast({first} as timestamp), cast({last} as timestamp), interval 1 day))))"
    return {
        "dim_date_first": compose(_show(_calendar(*fin, "DimDateID"), "FullDate")),
        "dim_date_hr_first": compose(_show(f"{_calendar(*hrs, 'DateKey')} union all by name {unknown}", "FullDate")),
        "dim_date_update": compose(_show(_calendar(first, "date '2004-12-31'", "DimDateID"), "FullDate")),
        "dim_date_missing_days": compose(
            _show(
                f"select row_number() over (order by FullDate) + {used} as DimDateID, FullDate, {_CALENDAR_COLUMNS} from (select cast(x as date) as FullDate from ({absent}))",
                "FullDate",
            )
        ),
    }


def _orphans(child, column, parent, parent_column) -> str:
    return f"""select '{child}.{column}' as ForeignKey, count(*) as Orphans from a_{child} c
where c.{column} is not null and not exists (select 1 from a_{parent} p where p.{parent_column} = c.{column})"""


def _references(child, rows, column, parent, parent_column):
    """One row for a link; a key of -1 is the unknown member."""
    known = f"(select distinct cast({parent_column} as varchar) as known from {parent})"
    return f"""select '{child}.{column}' as ForeignKey, count(*) filter (x.v is not null and p.known is null) as Orphans,
  count(distinct x.v) filter (p.known is null) as OrphanValues from (select nullif(cast({column} as varchar), '-1') as v from {rows}) x
left join {known} p on x.v = p.known"""


# The dimension keys of each fact
_FACT_KEYS = {
    "FactInvoiceLineTransaction": "DimInvoiceID DimCustomerID DimServiceTypeID DimTaxID DimDateID",
    "FactCustomerPaymentTransaction": "DimPaymentMethodID DimInvoiceID DimCustomerID DimDateID",
    "FactCustomerBillingMonthlySnapshot": "DimCustomerID DimDateID DimBillingCycleID",
    "FactInvoiceLifecycleAccumulating": "DimInvoiceID DimCustomerID DimContractID",
    "FactCustomerContractActivationFactless": "DimDateID DimCustomerID DimContractID",
    "FactTermination": "EmployeeKey DepartmentKey JobTitleKey TerminationReasonKey",
    "FactSalaryPayment": "EmployeeKey DepartmentKey JobTitleKey",
    "FactEmployeeAttendance": "EmployeeKey",
    "FactMonthlyEmployeePerformance": "EmployeeKey DepartmentKey",
    "FactEmployeeLifecycle": "EmployeeKey TerminationReasonKey",
    "FactCargoOperationTransactional": "ShipSK PortSK ContainerSK EquipmentSK EmployeeSK",
    "FactPortCallPeriodicSnapshot": "PortSK",
    "FactContainerMovementsAcc": "PortSK",
    "FactEquipmentAssignment": "EquipmentSK EmployeeSK PortSK",
}


def _counts(texts: dict) -> str:
    return compose(" union all ".join(f"select '{name}' as TableName, count(*) as RowCount from ({text})" for name, text in texts.items()))


def _load_counts() -> dict:
    """Rows per table after a whole load. Its facts meet dimensions loaded once, and every table of the mart in
    its earlier state before an update."""
    found = {}
    earlier = {mart: {t for f in module.FACTS if f in _EARLIER for t in _EARLIER[f]} for mart, module in MARTS.items()}
    for mart, module in MARTS.items():
        found[f"load_{mart}_staging"] = _counts({f"{mart}.{s.table}": f"select * from a_{s.table}" for s in STAGES.values() if s.area == mart})
        days = {"DimDateHR" if mart == "hr" else "DimDate": "select FullDate from d_Days" + (" union all select date '1900-01-01'" if mart == "hr" else "")}
        found[f"load_{mart}_dimensions_first"] = _counts({**days, **{n: f"select * from e_{n}" for n in module.DIMENSIONS}})
        found[f"load_{mart}_dimensions_update"] = _counts({**(days if mart == "finance" else {}), **{n: f"select * from u_{n}" for n in module.DIMENSIONS}})
        found[f"load_{mart}_facts_first"] = _counts({n: FACT_SQL[n](_now) for n in module.FACTS})
        updates = _fact_updates(_before(*earlier[mart]))
        updates["FactEmployeeLifecycle"] = "select * from a_Employee"
        found[f"load_{mart}_facts_update"] = _counts({n: updates[n] for n in module.UPDATES})
    return found


def statements() -> dict[str, str]:
    found = {f"stage_{name}": staging_report(spec) for name, spec in STAGES.items()}
    found |= {f"staged_{name}": staged_rows(spec) for name, spec in STAGES.items()}
    found |= _calendars()
    for name in MART_OF:
        found[f"dim_{snake(name)}_first"] = _dimension("e", name)
        found[f"dim_{snake(name)}_update"] = _dimension("u", name)
    updates = _fact_updates()
    for name, text in FACT_SQL.items():
        amounts = _AMOUNTS.get(name, "")
        found[f"fact_{FACT_QUERY[name]}_first"] = compose(_show(text(_now), amounts))
        found[f"fact_{FACT_QUERY[name]}_update"] = compose(_show(updates[name], amounts))
    for name, table, key in [
        ("FactCustomerBillingMonthlySnapshot", "Invoice", "InvoiceID"), ("FactMonthlyEmployeePerformance", "Attendance", "AttendanceID"),
        ("FactEmployeeLifecycle", None, None), ("FactPortCallPeriodicSnapshot", "PortCall", "PortCallID"),
        ("FactContainerMovementsAcc", "PortCall", "PortCallID"),
    ]:  # a first load over the corrected sources
        body = FACT_SQL[name](lambda t, table=table, key=key: f"(select * from a_{t} where {key} % 11 <> 5)" if t == table else f"a_{t}")
        found[f"fact_{FACT_QUERY[name]}_after_corrections"] = compose(_show(body, _AMOUNTS.get(name, "")))
    lost = "select '{0}' as Fact, cast(r.{1} as varchar) as SourceID, case when {2} then '{3}' else '{4}' end as FailedLink from {5} where {2} or {6}"
    billed = """{0} r left join (select * from a_Invoice where InvoiceID % 11 <> 5) i on r.InvoiceID = i.InvoiceID
  left join (select * from a_Contract where ContractID % 13 <> 4) c on i.ContractID = c.ContractID"""
    worked = """a_OperationEquipmentAssignment r join a_CargoOperation o on r.CargoOpID = o.CargoOpID
  left join (select * from a_PortCall where PortCallID % 11 <> 5) i on o.PortCallID = i.PortCallID left join (select * from a_Voyage where VoyageID % 7 <> 3) c on i.VoyageID = c.VoyageID"""
    found["rejects_finance"] = compose(" union all ".join(
        lost.format(fact, key, "i.InvoiceID is null", "Invoice.InvoiceID", "Contract.ContractID", billed.format(table), "c.ContractID is null")
        for fact, key, table in [("FactInvoiceLineTransaction", "InvoiceLineID", "a_InvoiceLine"), ("FactCustomerPaymentTransaction", "PaymentID", "a_Payment")]
    ))
    found["rejects_port"] = compose(" union all ".join(
        lost.format(fact, "AssignmentID", "i.PortCallID is null", "PortCall.PortCallID", "Voyage.VoyageID", worked, "c.VoyageID is null")
        for fact in ("FactCargoOperationTransactional", "FactEquipmentAssignment")
    ))
    # rewriting the touched months only gives the rows of the whole update
    found["fact_invoice_lifecycle_by_month"] = found["fact_invoice_lifecycle_update"]
    found["dim_invoice_by_month"] = found["dim_invoice_update"]
    found["fact_billing_snapshot_reference_grain"] = compose(
        _show(billing_snapshot(_now, reference_grain=True), _AMOUNTS["FactCustomerBillingMonthlySnapshot"])
    )
    found["fact_invoice_line_update_reference_keys"] = compose(
        _show(
            _kept_and_new(
                invoice_lines(_before("InvoiceLine")), invoice_lines(_now),
                ["DimInvoiceID", "DimCustomerID", "DimServiceTypeID", "Quantity", "UnitPrice", "NetAmount"],
            ),
            _AMOUNTS["FactInvoiceLineTransaction"],
        )
    )
    found |= _load_counts()
    upto = f"<= date '{HR_RUN_DATE}'"
    nights = [
        ("FactTermination", "TerminationID", terminations(_dated("Termination", "TerminationDate", upto))),
        ("FactSalaryPayment", "SalaryPaymentID", salary_payments(_dated("SalaryPayment", "PaymentDate", upto))),
        ("FactEmployeeAttendance", "AttendanceID", attendance(_dated("Attendance", "AttendanceDate", upto))),
    ]
    once = "select '{0}' as Fact, cast(Source{1} as varchar) as SourceID, count(*) as FactRows from ({2}) group by all"
    # the load keys its dimensions once: by e_, not by the versions of two loads
    found["hr_facts_after_two_nights"] = compose(" union all ".join(once.format(*n) for n in nights).replace("d_DimEmployee", "e_DimEmployee"))
    found["finance_payments_shifted_days"] = compose(
        f"""select cast(cast(dd.FullDate + interval 36 year as date) as varchar) as FullDate, count(*) as Payments, cast(sum(p.PaymentAmount) as double) as Paid
from ({payments(_now)}) p join d_Days dd on p.DimDateID = dd.DimDateID group by dd.FullDate"""
    )
    found["fact_yearly_headcount"] = compose(_show(yearly_headcount(), _AMOUNTS["FactYearlyHeadcount"]))
    tables = dict.fromkeys(spec.table for spec in STAGES.values())
    found["row_counts"] = compose(" union all ".join(f"select '{t}' as TableName, count(*) as RowCount from a_{t}" for t in tables))
    found["orphan_report"] = compose(
        " union all ".join(
            _orphans(*link)
            for link in [
                ("Invoice", "ContractID", "Contract", "ContractID"), ("InvoiceLine", "InvoiceID", "Invoice", "InvoiceID"), ("InvoiceLine", "TaxID", "Tax", "TaxID"),
                ("OperationEquipmentAssignment", "EmployeeID", "Employee", "EmployeeID"), ("YardSlot", "YardID", "Yard", "YardID"),
                ("Voyage", "ShipID", "Ship", "ShipID"), ("ContainerYardMovement", "ContainerID", "Container", "ContainerID"),
            ]
        )
    )
    found["referential_report"] = compose(" union all ".join(_references(c, f"a_{c}", k, f"a_{p}", pk) for c, k, p, pk in SOURCE_LINKS))
    for mart, module in MARTS.items():
        keys = FACT_KEYS[mart]
        dims = {k: "d_Days" if dim == "DimDate" else f"d_{dim}" for k, dim in keys.items()}
        links = [(fact, k) for fact in module.FACTS for k in _FACT_KEYS[fact].split()]
        found[f"referential_report_{mart}_facts"] = compose(" union all ".join(_references(f, f"({FACT_SQL[f](_now)})", k, dims[k], k) for f, k in links))
    found["staging_reconciliation"] = compose(
        """select InvoiceID, 'missing in staging' as Difference, 1 as SourceRows, 0 as StagedRows from a_Invoice where InvoiceID % 97 = 5
union all select InvoiceID, 'different', 1, 1 from a_Invoice where InvoiceID % 97 = 6
union all select InvoiceID + 1000000000, 'not at the source', 0, 1 from a_Invoice where InvoiceID % 97 = 7"""
    )
    planted = {
        "Invoice": """select * replace (cast(case InvoiceID % 97 when 5 then cast(TotalAmount as decimal(38,9)) * 1000000000000 when 6 then cast(TotalAmount as decimal(38,9)) + 0.00005
  else TotalAmount end as decimal(38,9)) as TotalAmount, case InvoiceID % 97 when 7 then '2024-02-30' when 8 then null else cast(DueDate as varchar) end as DueDate) from a_Invoice""",
        "Customer": "select * replace (case CustomerID % 7 when 3 then repeat(CustomerCode, 10) else CustomerCode end as CustomerCode) from a_Customer",
    }
    found["declared_types_finance_staging"] = compose(
        " union all ".join(_declared(t, planted.get(t, f"select * from a_{t}"), c) for t, c in declarations.STAGED.items())
    )
    found["declared_types_finance_marts"] = compose(
        " union all ".join(
            [_declared(n, f"select * from d_{n}", c) for n, c in declarations.DIMENSIONS.items()]
            + [_declared(n, FACT_SQL[n](_now), c) for n, c in declarations.FACTS.items()]
        )
    )
    line = "concat_ws(',', PaymentID, InvoiceID, {day}, {amount}, {method})"
    plain = {"day": "PaymentDate", "amount": "Amount", "method": "PaymentMethod"}
    broken = {
        5: (line.format(**plain | {"day": "'soon'"}), "PaymentDate: unreadable"),
        6: (line.format(**plain | {"amount": "'123456789012345.5'"}), "Amount: unreadable"),
        7: (line.format(**plain | {"amount": "''"}), "Amount: missing"),
        8: (line.format(**plain | {"method": "repeat(PaymentMethod, 30)"}), "PaymentMethod: too long"),
        9: (f"{line.format(**plain)} || ',surplus'", "line: fields"),
        10: ("concat_ws(',', PaymentID, InvoiceID)", "line: fields"),
    }
    found["bulk_load_payments"] = compose(
        "select PaymentID, InvoiceID, cast(PaymentDate as varchar) as PaymentDate, cast(Amount as double) as Amount, PaymentMethod, null as Line, null as Problems "
        "from a_Payment where InvoiceID % 97 not between 5 and 10"
        + "".join(f" union all select null, null, null, null, null, {text}, '{why}' from a_Payment where InvoiceID % 97 = {n}" for n, (text, why) in broken.items())
    )
    found["report_top_invoice_lines"] = compose(
        _show(f"select * from ({invoice_lines(_now)}) order by NetAmount desc, SourceInvoiceLineID limit 100", _AMOUNTS["FactInvoiceLineTransaction"])
    )
    found["report_latest_payments"] = compose(
        f"""select DimCustomerID, DimDateID, cast(PaymentAmount as double) as PaymentAmount, SourcePaymentID, Position from (
  select *, row_number() over (partition by DimCustomerID order by DimDateID desc, SourcePaymentID) as Position from ({payments(_now)})) where Position <= 3"""
    )
    found["report_dimension_sizes"] = compose(" union all ".join(f"select '{n}' as TableName, count(*) as RowCount from d_{n}" for n in MART_OF))
    found["duplicate_keys"] = "select l_orderkey, l_linenumber, count(*) as Occurrences from lineitem group by l_orderkey, l_linenumber having count(*) > 1"
    joined = "from a_CargoOperation co left join a_PortCall_v1 pc on co.PortCallID = pc.PortCallID left join a_Container c on co.ContainerID = c.ContainerID"
    gaps = {"CargoOpID": "co.CargoOpID", "OperationType": "co.OperationType", "Quantity": "co.Quantity", "CallPortID": "pc.PortID", "BoxTypeID": "c.ContainerTypeID"}
    found["container_movement_gaps"] = compose(
        " union all ".join(
            [f"select 'rows' as CheckName, '*' as Columns, count(*) as Rows {joined}"]
            + [f"select 'missing', '{label}', count(*) {joined} where {column} is null" for label, column in gaps.items()]
            + [f"select 'missing_any', '{','.join(gaps)}', count(*) {joined} where {' or '.join(f'{c} is null' for c in gaps.values())}"]
        )
    )
    found["asof_lookup"] = compose(
        f"""select o.AttendanceID, o.EmployeeID, cast(o.AttendanceDate as varchar) as AttendanceDate, h.EmploymentHistoryID, h.DepartmentID from a_Attendance o
{_last_history('AttendanceID', 'AttendanceDate', 'h', 'a_Attendance')}"""
    )
    found["interval_lookup"] = compose(
        "select o.AttendanceID, o.EmployeeID, cast(o.AttendanceDate as varchar) as AttendanceDate, e.EmployeeKey from a_Attendance o left " + _EMPLOYEE_ON.format(day="AttendanceDate")
    )
    found["surrogate_keys"] = compose(
        "select row_number() over (order by md5(InvoiceLineID)) as InvoiceLineKey, InvoiceLineID from a_InvoiceLine"
    )
    found["current_versions"] = compose("select DimCustomerID, CustomerCode, Phone, Address, cast(StartDate as varchar) as StartDate from d_DimCustomer where IsCurrent")
    return found
