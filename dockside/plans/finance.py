"""Finance mart: 7 dimensions besides the calendar, 5 facts.

Every builder takes ``s`` (staged tables by name) and ``d`` (dimension tables by name). Keys that depend on the
invoice alone are resolved once per invoice, so line and payment rows are shuffled once for the invoice join
and meet only small dimensions after that.
"""

from pyspark.sql import DataFrame, functions as F

from dockside.functions.dates import month_start
from dockside.operators import increment, signature
from dockside.operators.lookup import date_keys, key_lookup, version_lists, version_lookup, version_on
from dockside.operators.period import MONTH, Period, dated_in, homes, month_of
from dockside.operators.scd import Dimension
from dockside.sources.overlay import Overlay

MONEY = "decimal(18,4)"

DIMENSIONS = {
    dim.name: dim
    for dim in [
        Dimension(
            "DimCustomer", "DimCustomerID", ("CustomerCode",),
            ("CustomerName", "CustomerType", "CountryName", "VATNumber", "Address", "Email", "Phone"),
            "versioned", required=("CustomerCode", "CustomerName", "CustomerType"), end_offset_days=0, null_equals_blank=True,
        ),
        Dimension(
            "DimServiceType", "DimServiceTypeID", ("SourceServiceTypeID",),
            ("ServiceName", "ServiceCategory", "UnitOfMeasure", "Taxable", "IsActive"),
            "overwrite", required=("SourceServiceTypeID", "ServiceName", "UnitOfMeasure"),
        ),
        Dimension(
            "DimTax", "DimTaxID", ("TaxName", "TaxType", "EffectiveFrom"), ("TaxRate", "EffectiveTo"),
            "versioned", tracked=("TaxRate",), required=("TaxName", "TaxRate", "TaxType", "EffectiveFrom"), end_offset_days=0,
        ),
        Dimension("DimBillingCycle", "DimBillingCycleID", ("CycleName",), ("CycleLengthInDays",), "overwrite", required=("CycleName", "CycleLengthInDays")),
        Dimension("DimPaymentMethod", "DimPaymentMethodID", ("PaymentMethodName",), (), "insert_only", required=("PaymentMethodName",)),
        Dimension(
            "DimContract", "DimContractID", ("ContractNumber",), ("ContractStatus", "PaymentTerms", "StartDateActual", "EndDateActual"),
            "previous_value", tracked=("ContractStatus", "StartDateActual", "EndDateActual"),
            required=("ContractNumber", "ContractStatus", "StartDateActual"),
            chain=("ContractStatus", "PrevContractStatus1", "PrevContractStatus2"),
        ),
        Dimension(
            "DimInvoice", "DimInvoiceID", ("InvoiceNumber",), ("InvoiceStatus", "CreatedBy", "CreatedDate"),
            "overwrite", required=("InvoiceNumber", "InvoiceStatus", "CreatedDate"),
        ),
    ]
}


def dimension_source(name: str, s) -> DataFrame:
    """Staged rows in the shape of the dimension ``name``."""
    if name == "DimCustomer":
        return s["Customer"].join(s["Country"].select("CountryID", "CountryName"), "CountryID", "left")
    if name == "DimServiceType":
        return s["ServiceType"].withColumnRenamed("ServiceTypeID", "SourceServiceTypeID")
    if name == "DimPaymentMethod":
        return s["Payment"].select(F.col("PaymentMethod").alias("PaymentMethodName")).distinct()
    if name == "DimContract":
        return s["Contract"].withColumnsRenamed({"StartDate": "StartDateActual", "EndDate": "EndDateActual"})
    if name == "DimInvoice":
        return s["Invoice"].withColumnRenamed("Status", "InvoiceStatus")
    return s[name.removeprefix("Dim")]


def _contracts(s) -> DataFrame:
    customers = s["Customer"].select("CustomerID", "CustomerCode")
    return s["Contract"].select("ContractID", "CustomerID", "ContractNumber", "StartDate", "BillingCycleID").join(customers, "CustomerID")


def _invoices(s) -> DataFrame:
    """Invoice header with its contract and customer; one row per invoice."""
    contracts = _contracts(s).select("ContractID", "CustomerID", "ContractNumber", "CustomerCode", "BillingCycleID")
    return s["Invoice"].select("InvoiceID", "ContractID", "InvoiceNumber", "InvoiceDate", "DueDate", "TotalAmount").join(contracts, "ContractID")


def _tax_versions(s, d) -> DataFrame:
    key = ["TaxName", "TaxType", "EffectiveFrom"]
    return s["Tax"].select("TaxID", *key).join(d["DimTax"].select(*key, "DimTaxID", "StartDate"), key)


def line_header(s, d) -> DataFrame:
    """What lines take of their invoice: its day and the keys that depend on it. Customer versions come with the contract."""
    contracts = _contracts(s).select("ContractID", "CustomerCode").join(version_lists(d["DimCustomer"], "CustomerCode", "DimCustomerID"), "CustomerCode")
    rows = s["Invoice"].select("InvoiceID", "ContractID", "InvoiceNumber", "InvoiceDate").join(contracts.select("ContractID", "_versions"), "ContractID")
    rows = rows.withColumn("DimCustomerID", version_on("InvoiceDate")).drop("_versions")
    rows = key_lookup(rows, d["DimInvoice"], "InvoiceNumber", "DimInvoiceID")
    rows = rows.join(date_keys(d["DimDate"], "DimDateID", InvoiceDate="DimDateID")["InvoiceDate"], "InvoiceDate")
    return rows.select("InvoiceID", "InvoiceDate", "DimInvoiceID", "DimCustomerID", "DimDateID")


def line_lookups(s, d) -> dict[str, DataFrame]:
    """What all lines of the same invoices look up besides their service, to be written once for several loads of lines. As the few
    tax versions are then known to be few, no line is shuffled to them."""
    return {"header": line_header(s, d), "taxes": _tax_versions(s, d)}


def _serviced(s, d) -> DataFrame:
    """Lines with their service's key, looked up while rows are narrow."""
    return key_lookup(s["InvoiceLine"], d["DimServiceType"].withColumnRenamed("SourceServiceTypeID", "ServiceTypeID"), "ServiceTypeID", "DimServiceTypeID")


def invoice_lines(s, d, month: bool = False, lookups: dict | None = None) -> DataFrame:
    """Transaction fact, one row per invoice line; a NULL discount is 0. ``month`` adds that of the invoice, to lay the fact out by.
    ``lookups`` are ``line_lookups`` of the same sources, where they are at hand."""
    lookups = lookups or line_lookups(s, d)
    return _line_fact(_serviced(s, d).join(lookups["header"], "InvoiceID"), lookups["taxes"], month)


def _line_fact(lines, taxes, month: bool = False) -> DataFrame:
    lines = version_lookup(lines, taxes, "TaxID", "InvoiceDate", "DimTaxID", how="left")
    quantity, net = F.col("Quantity"), F.col("NetAmount").cast(MONEY)
    discount = F.coalesce(F.col("DiscountPercent"), F.lit(0)).cast("decimal(6,4)")
    return lines.select(
        "DimInvoiceID", "DimCustomerID", "DimServiceTypeID", "DimTaxID", "DimDateID",
        quantity.alias("Quantity"),
        F.col("UnitPrice").cast(MONEY).alias("UnitPrice"),
        (quantity * F.col("UnitPrice")).cast(MONEY).alias("GrossAmount"),
        discount.alias("DiscountPercent"),
        net.alias("NetAmount"),
        F.col("TaxAmount").cast(MONEY).alias("TaxAmount"),
        F.when(quantity == 0, F.lit(0)).otherwise(net / F.when(quantity != 0, quantity)).cast("decimal(29,15)").alias("EffectiveRate"),
        F.col("InvoiceLineID").alias("SourceInvoiceLineID"),
        *([month_of("InvoiceDate").alias(MONTH)] if month else []),
    )


def payments(s, d, month: bool = False) -> DataFrame:
    """Transaction fact, one row per payment; the amount left is measured against that payment alone. ``month`` adds the payment's."""
    header = key_lookup(_invoices(s), d["DimInvoice"], "InvoiceNumber", "DimInvoiceID")
    header = header.join(version_lists(d["DimCustomer"], "CustomerCode", "DimCustomerID"), "CustomerCode")
    rows = s["Payment"].join(header.select("InvoiceID", "InvoiceDate", "TotalAmount", "_versions", "DimInvoiceID"), "InvoiceID")
    methods = d["DimPaymentMethod"].withColumnRenamed("PaymentMethodName", "PaymentMethod")
    rows = key_lookup(rows, methods, "PaymentMethod", "DimPaymentMethodID")
    rows = rows.withColumn("DimCustomerID", version_on("PaymentDate"))
    rows = rows.join(date_keys(d["DimDate"], "DimDateID", PaymentDate="DimDateID")["PaymentDate"], "PaymentDate")
    return rows.select(
        "DimPaymentMethodID", "DimInvoiceID", "DimCustomerID", "DimDateID",
        F.col("Amount").cast(MONEY).alias("PaymentAmount"),
        F.date_diff("PaymentDate", "InvoiceDate").alias("DaysToPayment"),
        (F.col("TotalAmount") - F.col("Amount")).cast(MONEY).alias("RemainingAmount"),
        (F.col("Amount") >= F.col("TotalAmount")).alias("IsFullPayment"),
        F.lit(0).alias("PartialPaymentCount"),
        F.col("PaymentID").alias("SourcePaymentID"),
        *([month_of("PaymentDate").alias(MONTH)] if month else []),
    )


def _per_invoice(s) -> DataFrame:
    """Line and payment totals per invoice: the only place line-level rows are shuffled for the snapshot."""
    lines = s["InvoiceLine"].groupBy("InvoiceID").agg(
        F.sum("NetAmount").alias("_net"),
        F.sum("TaxAmount").alias("_tax"),
        F.sum(F.col("Quantity") * F.col("UnitPrice") * F.coalesce(F.col("DiscountPercent"), F.lit(0))).cast("decimal(38,8)").alias("_discount"),
        F.lit(1).alias("_billed"),
    )
    # sum of (payment date - invoice date) needs only the summed payment day numbers
    paid = s["Payment"].groupBy("InvoiceID").agg(
        F.sum("Amount").alias("_paid"), F.sum(F.unix_date("PaymentDate")).alias("_pay_days"), F.count(F.lit(1)).alias("_payments")
    )
    return _invoices(s).join(lines, "InvoiceID", "left").join(paid, "InvoiceID", "left")


def billing_snapshot(s, d, reference_grain: bool = False) -> DataFrame:
    """Monthly snapshot per customer, invoice month and billing cycle.

    Totals add up across rows. ``reference_grain`` instead totals per customer and month and repeats the totals
    for every contract the customer has.
    """
    grain = ["CustomerID", "CustomerCode", "SnapshotDate"] + ([] if reference_grain else ["BillingCycleID"])
    totals = (
        _per_invoice(s)
        .withColumn("SnapshotDate", month_start("InvoiceDate"))
        .groupBy(*grain)
        .agg(
            F.count("_billed").alias("TotalInvoiceCount"),
            F.sum("_net").alias("_net"),
            F.sum("_tax").alias("_tax"),
            F.sum("_discount").alias("_discount"),
            F.coalesce(F.sum("_paid"), F.lit(0)).alias("_paid"),
            F.sum("_payments").alias("_payments"),
            F.sum(F.col("_pay_days") - F.col("_payments") * F.unix_date("InvoiceDate")).alias("_delay"),
        )
        .where("TotalInvoiceCount > 0")
    )
    if reference_grain:
        totals = totals.join(s["Contract"].select("CustomerID", "BillingCycleID"), "CustomerID")
    cycles = s["BillingCycle"].select("BillingCycleID", "CycleName")
    totals = key_lookup(totals.join(cycles, "BillingCycleID"), d["DimBillingCycle"], "CycleName", "DimBillingCycleID")
    totals = version_lookup(totals, d["DimCustomer"], "CustomerCode", "SnapshotDate", "DimCustomerID")
    totals = totals.join(date_keys(d["DimDate"], "DimDateID", SnapshotDate="DimDateID")["SnapshotDate"], "SnapshotDate")
    delay = F.when(F.col("_payments") > 0, F.expr("_delay div _payments")).otherwise(F.lit(0))
    return totals.select(
        "DimCustomerID", "DimDateID", "DimBillingCycleID", "TotalInvoiceCount",
        F.col("_net").cast(MONEY).alias("TotalNetAmount"),
        F.col("_tax").cast(MONEY).alias("TotalTaxAmount"),
        F.col("_discount").cast(MONEY).alias("TotalDiscount"),
        F.col("_paid").cast(MONEY).alias("TotalPaid"),
        delay.cast("decimal(10,2)").alias("AveragePaymentDelay"),
        (F.col("_net") + F.col("_tax") - F.col("_paid")).cast(MONEY).alias("MaxOutstandingAmount"),
    )


def _lifecycle_keys(s, d) -> DataFrame:
    """Invoices that find their dimensions, with the keys of these. What depends on the contract is looked up once a contract."""
    contracts = key_lookup(_contracts(s), d["DimContract"], "ContractNumber", "DimContractID")
    contracts = contracts.join(version_lists(d["DimCustomer"], "CustomerCode", "DimCustomerID"), "CustomerCode")
    rows = s["Invoice"].select("InvoiceID", "ContractID", "InvoiceNumber", "InvoiceDate", "DueDate", "TotalAmount")
    rows = rows.join(contracts.select("ContractID", "DimContractID", "_versions"), "ContractID")
    rows = rows.withColumn("DimCustomerID", version_on("InvoiceDate")).drop("_versions")
    rows = key_lookup(rows, d["DimInvoice"], "InvoiceNumber", "DimInvoiceID")
    for day, lookup in date_keys(d["DimDate"], "DimDateID", InvoiceDate="InvoiceDateID", DueDate="DueDateID").items():
        rows = rows.join(lookup, day)
    return rows


def invoice_lifecycle(s, d, month: bool = False) -> DataFrame:
    """Accumulating snapshot, one row per invoice, with its payment milestones. ``month`` adds that of the invoice."""
    paid = s["Payment"].groupBy("InvoiceID").agg(
        F.sum("Amount").alias("_paid"), F.count(F.lit(1)).alias("_count"),
        F.min("PaymentDate").alias("FirstPayDate"), F.max("PaymentDate").alias("LastPayDate"),
    )
    rows = _lifecycle_keys(s, d).join(paid, "InvoiceID", "left")
    for day, lookup in date_keys(d["DimDate"], "DimDateID", FirstPayDate="FirstPaymentDateID", LastPayDate="FinalPaymentDateID").items():
        rows = rows.join(lookup, day, "left")
    amount = F.coalesce(F.col("_paid"), F.lit(0))
    last = F.date_diff("LastPayDate", "InvoiceDate")
    return rows.select(
        "DimInvoiceID", "DimCustomerID", "DimContractID", "InvoiceDateID", "DueDateID", "FirstPaymentDateID", "FinalPaymentDateID",
        F.col("TotalAmount").cast(MONEY).alias("TotalAmount"),
        amount.cast(MONEY).alias("PaidAmount"),
        (F.col("TotalAmount") - amount).cast(MONEY).alias("OutstandingAmount"),
        F.coalesce(F.col("_count"), F.lit(0)).alias("PaymentCount"),
        F.date_diff("FirstPayDate", "InvoiceDate").alias("FirstPaymentDelay"),
        last.alias("FinalPaymentDelay"),
        last.alias("DaysToClose"),
        *([month_of("InvoiceDate").alias(MONTH)] if month else []),
    )


def contract_activations(s, d) -> DataFrame:
    """Factless fact: a contract started on a day."""
    rows = key_lookup(_contracts(s), d["DimContract"], "ContractNumber", "DimContractID")
    rows = version_lookup(rows, d["DimCustomer"], "CustomerCode", "StartDate", "DimCustomerID")
    rows = rows.join(date_keys(d["DimDate"], "DimDateID", StartDate="DimDateID")["StartDate"], "StartDate")
    return rows.select("DimDateID", "DimCustomerID", "DimContractID")


FACTS = {
    "FactInvoiceLineTransaction": invoice_lines,
    "FactCustomerPaymentTransaction": payments,
    "FactCustomerBillingMonthlySnapshot": billing_snapshot,
    "FactInvoiceLifecycleAccumulating": invoice_lifecycle,
    "FactCustomerContractActivationFactless": contract_activations,
}

# Columns that recognise a row when the source id is left out of account.
REFERENCE_KEYS = {
    "FactInvoiceLineTransaction": ("DimInvoiceID", "DimCustomerID", "DimServiceTypeID", "Quantity", "UnitPrice", "NetAmount"),
}


def update_invoice_lines(current, s, d, reference_keys: bool = False, lookups: dict | None = None) -> DataFrame:
    """New lines come in, told by the source id or by ``reference_keys``. These hold the invoice's key: the loaded keys are brought to their
    staged invoices and shuffled with the staged lines, which so meet their invoice and the loaded keys at once."""
    if reference_keys:
        lookups, keys = lookups or line_lookups(s, d), REFERENCE_KEYS["FactInvoiceLineTransaction"]
        owner = ["DimInvoiceID", "DimCustomerID"]
        loaded = current.select(*keys).join(lookups["header"].select("InvoiceID", *owner), owner).withColumnsRenamed({c: f"_{c}" for c in owner})
        lines = _serviced(s, d).withColumns({c: F.col(c).cast(MONEY) for c in ("UnitPrice", "NetAmount")})
        rows = lines.unionByName(loaded.withColumn("_loaded", F.lit(True)), allowMissingColumns=True).join(lookups["header"], "InvoiceID")
        rows = rows.where(F.col("_loaded").isNull() | ((F.col("_DimInvoiceID") == F.col("DimInvoiceID")) & (F.col("_DimCustomerID") == F.col("DimCustomerID"))))
        return increment.append(current, _line_fact(increment.unmarked(rows, ["InvoiceID", *keys], "_loaded"), lookups["taxes"]))
    fresh = increment.unloaded(s["InvoiceLine"], current, "InvoiceLineID", "SourceInvoiceLineID")
    return increment.append(current, invoice_lines(Overlay(s, InvoiceLine=fresh), d, lookups=lookups))


def update_payments(current, s, d) -> DataFrame:
    fresh = increment.unloaded(s["Payment"], current, "PaymentID", "SourcePaymentID")
    return increment.append(current, payments(Overlay(s, Payment=fresh), d))


BILLED = ("DimCustomerID", "DimDateID", "DimBillingCycleID")


def billing_inputs(s, d) -> DataFrame:
    """One row per invoice: the snapshot key that it counts under, and signatures of its lines and payments."""
    rows = _invoices(s).select("InvoiceID", "InvoiceDate", "CustomerCode", "BillingCycleID").withColumn("SnapshotDate", month_start("InvoiceDate"))
    rows = rows.join(s["BillingCycle"].select("BillingCycleID", "CycleName"), "BillingCycleID")
    rows = key_lookup(rows, d["DimBillingCycle"], "CycleName", "DimBillingCycleID")
    rows = version_lookup(rows, d["DimCustomer"], "CustomerCode", "SnapshotDate", "DimCustomerID")
    rows = rows.join(date_keys(d["DimDate"], "DimDateID", SnapshotDate="DimDateID")["SnapshotDate"], "SnapshotDate")
    for table in ("InvoiceLine", "Payment"):
        rows = rows.join(signature.signed(table, *SIGNED_CHILDREN[table], s), "InvoiceID", "left")
    return rows


SIGNED_INVOICE = ["InvoiceID", "InvoiceDate", *signature.named("InvoiceLine"), *signature.named("Payment")]


def billing_signatures(s, d) -> DataFrame:
    return signature.signatures(billing_inputs(s, d), BILLED, SIGNED_INVOICE)


def update_billing_snapshot(current, s, d, seen=None, keep=lambda rows, name: rows, now=None) -> DataFrame:
    """The rows of a first load over today's sources, by touching only the keys that an invoice, line or payment has changed, moved
    to or left. ``seen`` has the signatures published with ``current``, ``now`` today's, if they are at hand; without ``seen`` all
    rows are built and compared, and the latest loaded month and later ones count as new. ``keep`` writes what is needed several times."""
    if seen is None:
        days = d["DimDate"].select("DimDateID", F.col("FullDate").alias("_month"))
        latest = current.join(days, "DimDateID").agg(F.coalesce(F.max("_month"), F.lit("0001-01-01").cast("date"))).scalar()
        built = billing_snapshot(s, d)
        return signature.follow_rows(current, built, BILLED, built.join(days.where(F.col("_month") >= latest), "DimDateID", "left_semi"))
    inputs = keep(billing_inputs(s, d).select("SnapshotDate", *BILLED, *SIGNED_INVOICE), "billing_inputs")
    now = signature.signatures(inputs, BILLED, SIGNED_INVOICE) if now is None else now
    changed = keep(signature.touched(seen, now, BILLED), "billing_changed")
    invoices = keep(inputs.join(changed, list(BILLED), "left_semi").select("InvoiceID", "SnapshotDate"), "billing_invoices")
    months = [r[0] for r in invoices.select("SnapshotDate").distinct().collect()]  # as many as there are months
    ids = invoices.select("InvoiceID")
    touched = {"Invoice": s["Invoice"].where(signature.in_months("InvoiceDate", months)).join(ids, "InvoiceID", "left_semi")}
    touched |= {table: s[table].join(ids, "InvoiceID", "left_semi") for table in SIGNED_CHILDREN}
    return increment.replace_keys(current, billing_snapshot(Overlay(s, **touched), d), BILLED, changed)


MILESTONES = (
    "FirstPaymentDateID", "FinalPaymentDateID", "PaidAmount", "OutstandingAmount",
    "PaymentCount", "FirstPaymentDelay", "FinalPaymentDelay", "DaysToClose",
)


def update_invoice_lifecycle(current, s, d) -> DataFrame:
    return increment.merge(current, invoice_lifecycle(s, d), ["DimInvoiceID"], MILESTONES)


def lifecycle_signatures(s, d) -> DataFrame:
    """One signature per invoice month of the invoices, their keys and their payments."""
    paid = signature.signed("Payment", *SIGNED_CHILDREN["Payment"], s)
    rows = _lifecycle_keys(s, d).join(paid, "InvoiceID", "left").withColumn(MONTH, month_of("InvoiceDate"))
    used = ["DimInvoiceID", "DimCustomerID", "DimContractID", "InvoiceDateID", "DueDateID", "TotalAmount", *signature.named("Payment")]
    return signature.signatures(rows, [MONTH], used)


def merge_invoice_lifecycle(current, s, d, months) -> tuple[DataFrame, list[int]]:
    """The rows of the months that invoices of ``months`` touch after ``update_invoice_lifecycle``, and these months. A row stays in the
    month that it was first published in."""
    invoices = s["Invoice"].where(dated_in("InvoiceDate", months))
    cut = Overlay(s, Invoice=invoices, Payment=s["Payment"].join(invoices.select("InvoiceID"), "InvoiceID", "left_semi"))
    touched = homes(current, _lifecycle_keys(cut, d), ["DimInvoiceID"], months)
    built = invoice_lifecycle(cut, d, month=True)
    return increment.merge(current.where(F.col(MONTH).isin(touched)), built, ["DimInvoiceID"], MILESTONES), touched


def update_contract_activations(current, s, d) -> DataFrame:
    return increment.append_unseen(current, contract_activations(s, d), ["DimDateID", "DimCustomerID", "DimContractID"])


UPDATES = {
    "FactInvoiceLineTransaction": update_invoice_lines,
    "FactCustomerPaymentTransaction": update_payments,
    "FactCustomerBillingMonthlySnapshot": update_billing_snapshot,
    "FactInvoiceLifecycleAccumulating": update_invoice_lifecycle,
    "FactCustomerContractActivationFactless": update_contract_activations,
}

# Line-level tables whose signatures staging publishes by the invoice they belong to: (key, columns the snapshot uses)
SIGNED_CHILDREN = {
    "InvoiceLine": (["InvoiceID"], ["InvoiceLineID", "Quantity", "UnitPrice", "DiscountPercent", "NetAmount", "TaxAmount"]),
    "Payment": (["InvoiceID"], ["PaymentID", "PaymentDate", "Amount"]),
}
SIGNATURES = {"FactCustomerBillingMonthlySnapshot": billing_signatures}
FOLLOWED = {}

# Facts and dimensions updated in place, month by month: (signatures of the sources, rows of the touched months), and the day of a member
MERGED = {"FactInvoiceLifecycleAccumulating": (lifecycle_signatures, merge_invoice_lifecycle)}
MEMBER_DAYS = {"DimInvoice": "CreatedDate"}

# Facts published by the month of their source rows
PERIODS = {
    "FactInvoiceLineTransaction": Period("InvoiceLine", "InvoiceLineID", "SourceInvoiceLineID", "InvoiceDate", "Invoice", "InvoiceID"),
    "FactCustomerPaymentTransaction": Period("Payment", "PaymentID", "SourcePaymentID", "PaymentDate"),
}
