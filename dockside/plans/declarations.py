"""Declared columns of the finance mart. Keys are wider than declared (bigint for int), ids composed of several columns are text."""

# Column types, lengths and NOT NULL as the warehouse declares them.
STAGED = {
    "Customer": "CustomerID bigint not null, CustomerCode varchar(50) not null, CustomerName varchar(200) not null, CustomerType varchar(100) not null, "
    "TIN varchar(50), VATNumber varchar(50), Phone varchar(50), Email varchar(200), Address varchar(500), CountryID int",
    "BillingCycle": "BillingCycleID bigint not null, CycleName varchar(100) not null, CycleLengthInDays int not null",
    "ServiceType": "ServiceTypeID bigint not null, ServiceName varchar(200) not null, ServiceCategory varchar(100), BaseRate decimal(18,4) not null, "
    "UnitOfMeasure varchar(50) not null, Taxable boolean not null, IsActive boolean not null",
    "Tax": "TaxID bigint not null, TaxName varchar(100) not null, TaxRate decimal(6,3) not null, TaxType varchar(100) not null, "
    "EffectiveFrom date not null, EffectiveTo date",
    "Tariff": "TariffID bigint not null, ServiceTypeID bigint not null, ValidFrom date not null, ValidTo date, UnitRate decimal(18,4) not null",
    "Contract": "ContractID bigint not null, CustomerID bigint not null, ContractNumber varchar(100) not null, StartDate date not null, EndDate date, "
    "BillingCycleID bigint not null, PaymentTerms varchar(200), ContractStatus varchar(100) not null",
    "Invoice": "InvoiceID bigint not null, ContractID bigint not null, InvoiceNumber varchar(100) not null, InvoiceDate date not null, "
    "DueDate date not null, Status varchar(100) not null, TotalAmount decimal(18,4) not null, TaxAmount decimal(18,4) not null, "
    "CreatedBy varchar(150), CreatedDate timestamp_ntz not null",
    "InvoiceLine": "InvoiceLineID varchar(100) not null, InvoiceID bigint not null, ServiceTypeID bigint not null, TaxID bigint, Quantity int not null, "
    "UnitPrice decimal(18,4) not null, DiscountPercent decimal(6,4), TaxAmount decimal(18,4) not null, NetAmount decimal(18,4) not null",
    "Payment": "PaymentID varchar(100) not null, InvoiceID bigint not null, PaymentDate date not null, Amount decimal(18,4) not null, "
    "PaymentMethod varchar(100) not null",
    "RevenueRecognition": "RecognitionID varchar(100) not null, InvoiceID bigint not null, DateRecognized date not null, Amount decimal(18,4) not null",
}
DIMENSIONS = {
    "DimCustomer": "DimCustomerID bigint not null, CustomerCode varchar(50) not null, CustomerName varchar(200) not null, "
    "CustomerType varchar(100) not null, CountryName varchar(200), VATNumber varchar(50), Address varchar(500), Email varchar(200), "
    "Phone varchar(50), StartDate date not null, EndDate date, IsCurrent boolean not null",
    "DimServiceType": "DimServiceTypeID bigint not null, SourceServiceTypeID bigint not null, ServiceName varchar(200) not null, "
    "ServiceCategory varchar(100), UnitOfMeasure varchar(50) not null, Taxable boolean not null, IsActive boolean not null",
    "DimTax": "DimTaxID bigint not null, TaxName varchar(100) not null, TaxRate decimal(18,4) not null, TaxType varchar(100) not null, "
    "EffectiveFrom date not null, EffectiveTo date, StartDate date not null, EndDate date, IsCurrent boolean not null",
    "DimBillingCycle": "DimBillingCycleID bigint not null, CycleName varchar(100) not null, CycleLengthInDays int not null",
    "DimPaymentMethod": "DimPaymentMethodID bigint not null, PaymentMethodName varchar(100) not null",
    "DimContract": "DimContractID bigint not null, ContractNumber varchar(100) not null, ContractStatus varchar(100) not null, "
    "PrevContractStatus1 varchar(100), PrevContractStatus2 varchar(100), PaymentTerms varchar(200), StartDateActual date not null, EndDateActual date",
    "DimInvoice": "DimInvoiceID bigint not null, InvoiceNumber varchar(100) not null, InvoiceStatus varchar(100) not null, CreatedBy varchar(150), "
    "CreatedDate timestamp_ntz not null",
}
FACTS = {
    "FactInvoiceLineTransaction": "DimInvoiceID bigint not null, DimCustomerID bigint not null, DimServiceTypeID bigint not null, DimTaxID bigint, "
    "DimDateID bigint not null, Quantity int not null, UnitPrice decimal(18,4) not null, DiscountPercent decimal(6,4), "
    "NetAmount decimal(18,4) not null, TaxAmount decimal(18,4) not null",
    "FactCustomerPaymentTransaction": "DimPaymentMethodID bigint not null, DimInvoiceID bigint not null, DimCustomerID bigint not null, "
    "DimDateID bigint not null, PaymentAmount decimal(18,4) not null, DaysToPayment int, RemainingAmount decimal(18,4), "
    "IsFullPayment boolean not null, PartialPaymentCount int",
    "FactCustomerBillingMonthlySnapshot": "DimCustomerID bigint not null, DimDateID bigint not null, DimBillingCycleID bigint, "
    "TotalInvoiceCount int not null, TotalNetAmount decimal(18,4) not null, TotalTaxAmount decimal(18,4) not null, TotalDiscount decimal(18,4), "
    "TotalPaid decimal(18,4) not null, AveragePaymentDelay decimal(10,2), MaxOutstandingAmount decimal(18,4)",
    "FactInvoiceLifecycleAccumulating": "DimInvoiceID bigint not null, DimCustomerID bigint not null, DimContractID bigint, "
    "InvoiceDateID bigint not null, DueDateID bigint not null, FirstPaymentDateID bigint, FinalPaymentDateID bigint, "
    "TotalAmount decimal(18,4) not null, PaidAmount decimal(18,4) not null, OutstandingAmount decimal(18,4) not null, PaymentCount int not null, "
    "FirstPaymentDelay int, FinalPaymentDelay int, DaysToClose int",
    "FactCustomerContractActivationFactless": "DimDateID bigint not null, DimCustomerID bigint not null, DimContractID bigint not null",
}
#: By the names that the loads publish.
PUBLISHED = {f"finance.{table}": columns for table, columns in STAGED.items()} | DIMENSIONS | FACTS
