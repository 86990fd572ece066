"""Maps the benchmark tables onto the operational schemas the warehouse loads.

Every operational table is one SQL query over the given tables, written in the subset Spark SQL and DuckDB
share, so the same text feeds the engine and the correctness check. ``<Name>_v1`` is an earlier snapshot of
``<Name>``: fewer keys, and some attributes still holding their old value.
"""

import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Run dates of the first and the second load of each mart.
FINANCE_RUN_1 = "1996-01-01"
FINANCE_RUN_2 = "1999-01-01"
HR_RUN_1 = "2024-01-02"
HR_RUN_2 = "2024-01-16"
CALENDAR_START = "1990-01-01"
CALENDAR_END = "2030-12-31"

_LINE_ID = (
    "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', "
    "cast(l_suppkey as string), '-', cast(cast(l_shipdate as date) as string), '-', "
    "cast(cast(round(l_extendedprice * 100) as bigint) as string))"
)

# What was known about a customer before a cut-off date; conditions are rare enough that most rows do not change.
_CUSTOMER = """
select c.c_custkey as CustomerID, concat('CUST', lpad(cast(c.c_custkey as string), 12, '0')) as CustomerCode,
  c.c_name as CustomerName, c.c_mktsegment as CustomerType, concat('TIN', cast(c.c_custkey as string)) as TIN,
  concat('VAT', cast(c.c_custkey as string)) as VATNumber,
  concat('09', lpad(cast(c.c_custkey as string), 9, '0'), case when o.big_urgent > 0 then '9' else '' end) as Phone,
  concat('c', cast(c.c_custkey as string), '@x.test') as Email,
  case when o.low_pending > 0 then null else concat('Street ', c.c_name) end as Address, c.c_nationkey as CountryID
from customer c {how} join (
  select o_custkey, sum(case when o_orderpriority = '1-URGENT' and o_totalprice > 400000 then 1 else 0 end) as big_urgent,
    sum(case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' and o_totalprice > 350000 then 1 else 0 end) as low_pending
  from orders where {cut} group by o_custkey) o on c.c_custkey = o.o_custkey"""

_SERVICE_TYPE = """
select p.p_partkey as ServiceTypeID,
  case when l.full_price_pallets > 0 then concat('Updated ', p.p_name, ' ', cast(p.p_partkey as string))
       else concat(p.p_name, ' ', cast(p.p_partkey as string)) end as ServiceName,
  p.p_type as ServiceCategory, cast(p.p_retailprice as decimal(18,4)) as BaseRate,
  case when p.p_size < 15 then 'TEU' when p.p_size < 35 then 'Hour' else 'Ton' end as UnitOfMeasure,
  p.p_size > 20 as Taxable, true as IsActive
from part p {how} join (
  select l_partkey, sum(case when l_quantity = 50 and l_discount > 0.085 then 1 else 0 end) as full_price_pallets
  from lineitem where {cut} group by l_partkey) l on p.p_partkey = l.l_partkey"""

_CONTRACT = """
select o_custkey * 10 + cast(substr(o_orderpriority, 1, 1) as int) as ContractID, o_custkey as CustomerID,
  concat('CON', lpad(cast(o_custkey as string), 12, '0'), '-', substr(o_orderpriority, 1, 1)) as ContractNumber,
  min(cast(o_orderdate as date)) as StartDate,
  case when max_by(o_orderstatus, o_orderkey) = 'O' then null else max(cast(o_orderdate as date)) + 365 end as EndDate,
  cast(substr(o_orderpriority, 1, 1) as int) as BillingCycleID,
  case when o_orderpriority = '1-URGENT' then 'Prepaid' when o_orderpriority = '5-LOW' then 'Net 60' else 'Net 30' end as PaymentTerms,
  case max_by(o_orderstatus, o_orderkey) when 'F' then 'Expired' when 'O' then 'Active' else 'Suspended' end as ContractStatus
from orders where {cut} group by o_custkey, o_orderpriority"""

_INVOICE = """
select o_orderkey as InvoiceID, o_custkey * 10 + cast(substr(o_orderpriority, 1, 1) as int) as ContractID,
  concat('INV', lpad(cast(o_orderkey as string), 14, '0')) as InvoiceNumber, cast(o_orderdate as date) as InvoiceDate,
  cast(o_orderdate as date) + 30 as DueDate,
  case {status} when 'F' then 'Paid' when 'O' then 'Overdue' when 'P' then 'Cancelled' else 'Issued' end as Status,
  cast(o_totalprice as decimal(18,4)) as TotalAmount, cast(0 as decimal(18,4)) as TaxAmount,
  o_orderpriority as CreatedBy, cast(o_orderdate as date) as CreatedDate
from orders where {cut}"""

_EMPLOYEE = """
select c.c_custkey as EmployeeID, c.c_name as FullName,
  case when e.big_signups > 0 then 'Port Manager' else c.c_mktsegment end as Position,
  lpad(cast(c.c_custkey as string), 12, '0') as NationalID,
  date '2022-09-01' + cast(c.c_custkey % 520 as int) as HireDate, date '1970-01-01' + cast((c.c_custkey * 37) % 9000 as int) as BirthDate,
  case when c.c_nationkey < 12 then 'Male' else 'Female' end as Gender, case when c.c_acctbal < 2500 then 'Single' else 'Married' end as MaritalStatus,
  case when e.big_errors > 0 then null else concat('Quay ', c.c_name) end as Address,
  concat('09', lpad(cast(c.c_custkey as string), 9, '0')) as Phone, concat('emp', cast(c.c_custkey as string), '@x.test') as Email,
  'Active' as EmploymentStatus
from customer c join (
  select user_id, sum(case when event_type = 'signup' and value > 150 then 1 else 0 end) as big_signups,
    sum(case when event_type = 'error' and value > 200 then 1 else 0 end) as big_errors
  from events where {cut} group by user_id) e on c.c_custkey = e.user_id"""

_SHIP = """
select c_custkey as ShipID, concat('IMO', lpad(cast(c_custkey as string), 10, '0')) as IMO_Number, c_name as Name, {country} as CountryID
from customer"""

_CONTAINER = """
select p_partkey as ContainerID, concat('CONT', lpad(cast(p_partkey as string), 10, '0')) as ContainerNumber,
  length(p_type) * 1000 + ascii(p_type) as ContainerTypeID, {owner} as OwnerCompany
from part"""

_EQUIPMENT = "select s_suppkey as EquipmentID, s_nationkey as EquipmentTypeID, {model} as Model from supplier"
_PORT = "select n_nationkey as PortID, concat('Port of ', n_name) as Name, {location} as Location from nation join region on n_regionkey = r_regionkey"
_YARD_SLOT = "select p_partkey as YardSlotID, p_size as YardID, {block} as Block, p_size as RowNumber, length(p_type) as TierLevel from part"
_DEPARTMENT = """select r_regionkey as DepartmentID, {name} as DepartmentName,
  cast(case when r_name = 'AFRICA' then null else r_regionkey end as bigint) as ManagerID, true as IsActive from region"""
_JOB_TITLE = """select distinct cast(substr(o_orderpriority, 1, 1) as int) as JobTitleID, substr(o_orderpriority, 3) as JobTitleName, {category} as JobCategory
from orders"""
_BILLING_CYCLE = """select distinct cast(substr(o_orderpriority, 1, 1) as int) as BillingCycleID, substr(o_orderpriority, 3) as CycleName,
  {length} as CycleLengthInDays from orders where {cut}"""
_TAX = """select distinct cast(round(l_tax * 100) as int) as TaxID, concat('Tax', lpad(cast(cast(round(l_tax * 100) as int) as string), 3, '0')) as TaxName,
  {rate} as TaxRate, case when l_tax < 0.035 then 'National' else 'Service' end as TaxType, date '1990-01-01' as EffectiveFrom, cast(null as date) as EffectiveTo
from lineitem where {cut}"""
_LEAVE_TYPE = """select distinct ascii(event_type) as LeaveTypeID, event_type as LeaveTypeName, event_type <> 'error' as IsPaid,
  length(event_type) * 5 as MaxDaysPerYear from events where {cut}"""
_TERMINATION = """
select user_id as TerminationID, user_id as EmployeeID, cast(min(ts) as date) as TerminationDate,
  case min_by(event_type, ts) when 'view' then 'Resignation' when 'click' then 'Retirement' when 'error' then 'Dismissal' else 'Contract end' end as TerminationReason
from events where value > 250 and {cut} group by user_id"""

SOURCES = {
    # Common
    "Country": "select n_nationkey as CountryID, n_name as CountryName, upper(substr(n_name, 1, 2)) as CountryCode from nation",
    # Finance
    "Customer": _CUSTOMER.format(how="left", cut="true"),
    "Customer_v1": _CUSTOMER.format(how="inner", cut=f"o_orderdate < date '{FINANCE_RUN_1}'"),
    "BillingCycle": _BILLING_CYCLE.format(length="length(o_orderpriority) * 5", cut="true"),
    "BillingCycle_v1": _BILLING_CYCLE.format(
        length="case when o_orderpriority = '2-HIGH' then 90 else length(o_orderpriority) * 5 end", cut="o_orderpriority <> '5-LOW'"
    ),
    "ServiceType": _SERVICE_TYPE.format(how="left", cut="true"),
    "ServiceType_v1": _SERVICE_TYPE.format(how="inner", cut="l_shipdate < date '1995-06-01'"),
    "Tax": _TAX.format(rate="cast(case when l_tax < 0.035 then l_tax else l_tax + 0.01 end as decimal(18,4))", cut="true"),
    "Tax_v1": _TAX.format(rate="cast(l_tax as decimal(18,4))", cut="l_tax < 0.075"),
    "Tariff": """select p_partkey as TariffID, p_partkey as ServiceTypeID, date '1995-01-01' + p_size as ValidFrom, cast(null as date) as ValidTo,
  cast(p_retailprice as decimal(18,4)) as UnitRate from part""",
    "Contract": _CONTRACT.format(cut="true"),
    "Contract_v1": _CONTRACT.format(cut="o_orderdate < date '1998-01-01'"),
    "Invoice": _INVOICE.format(status="o_orderstatus", cut="true"),
    "Invoice_v1": _INVOICE.format(status="case when o_orderstatus = 'P' then 'N' else o_orderstatus end", cut=f"o_orderdate < date '{FINANCE_RUN_2}'"),
    "InvoiceLine": f"""select {_LINE_ID} as InvoiceLineID, l_orderkey as InvoiceID, l_partkey as ServiceTypeID,
  cast(round(l_tax * 100) as int) as TaxID, cast(l_quantity as int) as Quantity, cast(floor(l_extendedprice / l_quantity) as decimal(18,4)) as UnitPrice,
  case when l_discount = 0 then null else cast(l_discount as decimal(6,4)) end as DiscountPercent,
  cast(round(cast(l_extendedprice as decimal(18,4)) * cast(l_tax as decimal(6,4)), 2) as decimal(18,4)) as TaxAmount,
  cast(l_extendedprice as decimal(18,4)) as NetAmount, cast(l_shipdate as date) as SrcDate
from lineitem""",
    "InvoiceLine_v1": f"select * from a_InvoiceLine where SrcDate < date '{FINANCE_RUN_2}'",
    "Payment": f"""select {_LINE_ID} as PaymentID, l_orderkey as InvoiceID, cast(l_shipdate as date) as PaymentDate,
  cast(l_extendedprice as decimal(18,4)) as Amount,
  case when l_quantity < 10 then 'Cash' when l_quantity < 30 then 'Card' when l_shipdate < date '2000-01-01' then 'Cheque' else 'Transfer' end as PaymentMethod
from lineitem where l_returnflag in ('A', 'R')""",
    "Payment_v1": f"select * from a_Payment where PaymentDate < date '{FINANCE_RUN_2}'",
    "RevenueRecognition": f"""select {_LINE_ID} as RecognitionID, l_orderkey as InvoiceID, cast(l_shipdate as date) as DateRecognized,
  cast(l_extendedprice as decimal(18,4)) as Amount from lineitem where l_returnflag = 'N'""",
    # HumanResources
    "Employee": _EMPLOYEE.format(cut="true"),
    "Employee_v1": _EMPLOYEE.format(cut=f"ts < timestamp '{HR_RUN_1} 00:00:00'"),
    "Department": _DEPARTMENT.format(name="r_name"),
    "Department_v1": _DEPARTMENT.format(name="case when r_name = 'ASIA' then 'Far East' else r_name end") + " where r_name <> 'EUROPE'",
    "JobTitle": _JOB_TITLE.format(category="case o_orderpriority when '5-LOW' then null when '1-URGENT' then 'Administrative' else 'Operational' end"),
    "JobTitle_v1": _JOB_TITLE.format(category="case o_orderpriority when '5-LOW' then 'Operational' else 'Administrative' end") + " where o_orderpriority <> '3-MEDIUM'",
    "EmploymentHistory": """select o_orderkey as EmploymentHistoryID, o_custkey as EmployeeID, cast(substr(o_orderpriority, 1, 1) as int) as JobTitleID,
  case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as DepartmentID, cast(o_orderdate as date) + 9000 as StartDate,
  case when o_orderstatus = 'O' then null else cast(o_orderdate as date) + 9190 end as EndDate, cast(cast(floor(o_totalprice) as bigint) * cast(0.01 as decimal(3,2)) as decimal(15,2)) as Salary,
  case when o_orderstatus = 'F' then 'Contract' else 'Permanent' end as EmploymentType
from orders where o_custkey in (select user_id from events)""",
    "Termination": _TERMINATION.format(cut="true"),
    "Termination_v1": _TERMINATION.format(cut=f"ts < timestamp '{HR_RUN_2} 00:00:00'"),
    "Attendance": """select event_id as AttendanceID, user_id as EmployeeID, cast(ts as date) as AttendanceDate,
  case event_type when 'error' then 'Absent' when 'signup' then 'Late' else 'Present' end as Status,
  case when event_type = 'error' then null else cast(least(value, 12.0) as decimal(5,2)) end as HoursWorked
from events""",
    "SalaryPayment": """select event_id as SalaryPaymentID, user_id as EmployeeID, cast(ts as date) as PaymentDate, cast(2000 + value as decimal(15,2)) as Amount,
  case when value < 20 then null else cast(value as decimal(15,2)) end as Bonus, cast(floor(value / 4) as decimal(15,2)) as Deductions,
  cast(2000 + value as decimal(15,2)) - cast(floor(value / 4) as decimal(15,2)) as NetAmount, case when value < 10 then 'Cash' else 'BankTransfer' end as PaymentMethod
from events where event_type = 'purchase'""",
    "TrainingProgram": "select distinct ascii(event_type) + 1000 as TrainingProgramID, concat('Course ', event_type) as ProgramName, upper(event_type) as Category from events",
    "EmployeeTraining": """select event_id as EmployeeTrainingID, user_id as EmployeeID, ascii(event_type) + 1000 as TrainingProgramID, cast(ts as date) as TrainingDate,
  case when value < 5 then 'Failed' else 'Completed' end as CompletionStatus from events where event_type in ('signup', 'click')""",
    "EmployeeTraining_v1": f"select * from a_EmployeeTraining where TrainingDate < date '{HR_RUN_2}'",
    "LeaveType": _LEAVE_TYPE.format(cut="true"),
    "LeaveType_v1": _LEAVE_TYPE.format(cut="event_type <> 'view'"),
    "LeaveRequest": """select event_id as LeaveRequestID, user_id as EmployeeID, ascii(event_type) as LeaveTypeID, cast(ts as date) as StartDate, cast(ts as date) + 7 as EndDate,
  case when value < 20 then 'Approved' when value < 60 then 'Rejected' else 'Pending' end as Status, cast(ts as date) - 14 as RequestDate from events""",
    # PortOperations
    "ContainerType": "select distinct length(p_type) * 1000 + ascii(p_type) as ContainerTypeID, p_type as Description, cast(length(p_type) * 5000 as double) as MaxWeightKG from part",
    "EquipmentType": "select n_nationkey as EquipmentTypeID, concat(n_name, ' class') as Description from nation",
    "Port": _PORT.format(location="concat(n_name, ', ', r_name)"),
    "Port_v1": _PORT.format(location="case when r_name = 'ASIA' then null else concat(n_name, ', ', r_name) end") + " where r_name <> 'EUROPE'",
    "Ship": _SHIP.format(country="case when c_acctbal < 0 then null else c_nationkey end"),
    "Ship_v1": _SHIP.format(country="c_nationkey") + f" where c_custkey in (select o_custkey from orders where o_orderdate < date '{FINANCE_RUN_1}')",
    "Container": _CONTAINER.format(owner="case when p_size > 45 then 'ZIM' else p_brand end"),
    "Container_v1": _CONTAINER.format(owner="p_brand") + " where p_partkey in (select l_partkey from lineitem where l_shipdate < date '1995-06-01')",
    "Equipment": _EQUIPMENT.format(model="concat('Model ', s_name)"),
    "Equipment_v1": _EQUIPMENT.format(model="case when s_acctbal < 1000 then 'Unrated' else concat('Model ', s_name) end") + " where s_acctbal < 8000",
    "Voyage": """select o_orderkey as VoyageID, o_custkey as ShipID, concat('VYG', lpad(cast(o_orderkey as string), 14, '0')) as VoyageNumber,
  cast(o_custkey % 25 as int) as DeparturePortID, cast((o_custkey + 1) % 25 as int) as ArrivalPortID from orders""",
    "PortCall": """select o_orderkey as PortCallID, o_orderkey as VoyageID, cast(o_custkey % 25 as int) as PortID, o_orderdate as ArrivalDateTime,
  case o_orderstatus when 'F' then 'Departed' else 'Docked' end as Status from orders""",
    "PortCall_v1": f"select * from a_PortCall where ArrivalDateTime < date '{FINANCE_RUN_2}'",
    "Berth": "select s_suppkey as BerthID, s_nationkey as PortID, concat('Berth ', s_name) as Name, abs(s_acctbal) as LengthMeters from supplier",
    "BerthAllocation": """select concat(cast(l_orderkey as string), '-', cast(l_suppkey as string), '-', cast(l_linenumber as string)) as AllocationID,
  l_orderkey as PortCallID, l_suppkey as BerthID, min(l_shipdate) as AllocationStart from lineitem where l_returnflag = 'A' group by l_orderkey, l_suppkey, l_linenumber""",
    "CargoOperation": f"""select {_LINE_ID} as CargoOpID, l_orderkey as PortCallID, l_partkey as ContainerID,
  case when l_returnflag = 'R' then 'LOAD' else 'UNLOAD' end as OperationType, l_shipdate as OperationDateTime, cast(l_quantity as int) as Quantity,
  l_extendedprice as WeightKG from lineitem""",
    "CargoOperation_v1": f"select * from a_CargoOperation where OperationDateTime < date '{FINANCE_RUN_2}'",
    "OperationEquipmentAssignment": f"""select {_LINE_ID} as AssignmentID, {_LINE_ID} as CargoOpID, l_suppkey as EquipmentID,
  case when l_quantity = 50 and l_shipdate >= date '{FINANCE_RUN_2}' then null else l_suppkey end as EmployeeID, l_shipdate as StartTime, l_shipdate as EndTime from lineitem""",
    "OperationEquipmentAssignment_v1": f"select * from a_OperationEquipmentAssignment where StartTime < date '{FINANCE_RUN_2}'",
    "Yard": "select s_suppkey as YardID, s_nationkey as PortID, concat('Yard ', s_name) as Name, case when s_acctbal < 3000 then 'IMPORT' when s_acctbal < 6000 then 'EXPORT' else 'EMPTY' end as UsageType from supplier",
    "YardSlot": _YARD_SLOT.format(block="p_brand"),
    "YardSlot_v1": _YARD_SLOT.format(block="case when p_size > 40 then 'Overflow' else p_brand end") + " where p_type <> 'PROMO'",
    "ContainerYardMovement": """select event_id as MovementID, user_id as ContainerID, user_id as YardSlotID,
  case event_type when 'view' then 'IN' when 'click' then 'OUT' else 'RELOCATE' end as MovementType, ts as MovementDateTime from events""",
}


def with_clause(names) -> str:
    """``a_X as (...), ...`` for the named sources and whatever they refer to."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in sorted(set(re.findall(r"\ba_(\w+)\b", SOURCES[name]))):
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ",\n".join(f"a_{name} as ({SOURCES[name]})" for name in ordered)


_base_views: WeakKeyDictionary = WeakKeyDictionary()


def _base_view(spark: SparkSession, directory: str, table: str) -> str:
    """Temporary view over one Parquet table; its schema is read once per session."""
    known = _base_views.setdefault(spark, {})
    if (directory, table) not in known:
        view = f"base_{len(known)}_{table}"
        spark.read.parquet(f"{directory}/{table}.parquet").createOrReplaceTempView(view)
        known[directory, table] = view
    return known[directory, table]


def source(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One operational table, derived from the Parquet tables in ``directory``."""
    body = f"{with_clause([name])} SELECT * FROM a_{name}"
    tables = [t for t in BASE_TABLES if re.search(rf"\b{t}\b", body)]
    views = [f"{t} as (select * from {_base_view(spark, directory, t)})" for t in tables]
    return spark.sql("WITH " + ", ".join([*views, body]))


class Sources:
    """Lazy lookup: ``sources["Invoice"]``; ``Sources(spark, dir, version="v1")`` prefers the earlier snapshots."""

    def __init__(self, spark: SparkSession, directory: str, version: str | None = None):
        self.spark, self.directory, self.version = spark, directory, version
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            versioned = f"{name}_{self.version}"
            chosen = versioned if versioned in SOURCES else name
            self._cache[name] = source(self.spark, self.directory, chosen)
        return self._cache[name]
