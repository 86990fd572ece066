"""Declared references: between operational tables, from facts to their dimensions, and on the way from a staged row to its fact."""

from dockside.operators.rejects import Link

# Fixed values: (table, column, referenced table, its key)
SOURCE_LINKS = [
    ("Customer", "CountryID", "Country", "CountryID"),
    ("Contract", "CustomerID", "Customer", "CustomerID"),
    ("Contract", "BillingCycleID", "BillingCycle", "BillingCycleID"),
    ("Invoice", "ContractID", "Contract", "ContractID"),
    ("InvoiceLine", "InvoiceID", "Invoice", "InvoiceID"),
    ("InvoiceLine", "ServiceTypeID", "ServiceType", "ServiceTypeID"),
    ("InvoiceLine", "TaxID", "Tax", "TaxID"),
    ("Payment", "InvoiceID", "Invoice", "InvoiceID"),
    ("RevenueRecognition", "InvoiceID", "Invoice", "InvoiceID"),
    ("Tariff", "ServiceTypeID", "ServiceType", "ServiceTypeID"),
    ("Department", "ManagerID", "Employee", "EmployeeID"),
    ("EmploymentHistory", "EmployeeID", "Employee", "EmployeeID"),
    ("EmploymentHistory", "JobTitleID", "JobTitle", "JobTitleID"),
    ("EmploymentHistory", "DepartmentID", "Department", "DepartmentID"),
    ("SalaryPayment", "EmployeeID", "Employee", "EmployeeID"),
    ("Attendance", "EmployeeID", "Employee", "EmployeeID"),
    ("Termination", "EmployeeID", "Employee", "EmployeeID"),
    ("EmployeeTraining", "EmployeeID", "Employee", "EmployeeID"),
    ("EmployeeTraining", "TrainingProgramID", "TrainingProgram", "TrainingProgramID"),
    ("LeaveRequest", "EmployeeID", "Employee", "EmployeeID"),
    ("LeaveRequest", "LeaveTypeID", "LeaveType", "LeaveTypeID"),
    ("Ship", "CountryID", "Country", "CountryID"),
    ("Voyage", "ShipID", "Ship", "ShipID"),
    ("Voyage", "DeparturePortID", "Port", "PortID"),
    ("Voyage", "ArrivalPortID", "Port", "PortID"),
    ("PortCall", "VoyageID", "Voyage", "VoyageID"),
    ("PortCall", "PortID", "Port", "PortID"),
    ("Berth", "PortID", "Port", "PortID"),
    ("BerthAllocation", "PortCallID", "PortCall", "PortCallID"),
    ("BerthAllocation", "BerthID", "Berth", "BerthID"),
    ("Container", "ContainerTypeID", "ContainerType", "ContainerTypeID"),
    ("CargoOperation", "PortCallID", "PortCall", "PortCallID"),
    ("CargoOperation", "ContainerID", "Container", "ContainerID"),
    ("Equipment", "EquipmentTypeID", "EquipmentType", "EquipmentTypeID"),
    ("Yard", "PortID", "Port", "PortID"),
    ("YardSlot", "YardID", "Yard", "YardID"),
    ("ContainerYardMovement", "ContainerID", "Container", "ContainerID"),
    ("ContainerYardMovement", "YardSlotID", "YardSlot", "YardSlotID"),
    ("OperationEquipmentAssignment", "CargoOpID", "CargoOperation", "CargoOpID"),
    ("OperationEquipmentAssignment", "EquipmentID", "Equipment", "EquipmentID"),
    ("OperationEquipmentAssignment", "EmployeeID", "Employee", "EmployeeID"),
]

# facts' key columns and the dimension each refers to
FINANCE_KEYS = {
    "DimInvoiceID": "DimInvoice", "DimCustomerID": "DimCustomer", "DimServiceTypeID": "DimServiceType", "DimTaxID": "DimTax", "DimDateID": "DimDate",
    "DimPaymentMethodID": "DimPaymentMethod", "DimBillingCycleID": "DimBillingCycle", "DimContractID": "DimContract",
}
HR_KEYS = {"EmployeeKey": "DimEmployee", "DepartmentKey": "DimDepartment", "JobTitleKey": "DimJobTitle", "TerminationReasonKey": "DimTerminationReason"}
PORT_KEYS = {"ShipSK": "DimShip", "PortSK": "DimPort", "ContainerSK": "DimContainer", "EquipmentSK": "DimEquipment", "EmployeeSK": "DimPortEmployee"}
FACT_KEYS = {"finance": FINANCE_KEYS, "hr": HR_KEYS, "port": PORT_KEYS}

# What a staged row needs to become a fact row, in the order in which a missing link is named; last, what remains if all are there.
_BILLED = (
    Link("InvoiceID", "Invoice", "InvoiceID", ("ContractID", "InvoiceNumber", "InvoiceDate")),
    Link("Invoice_ContractID", "Contract", "ContractID", ("CustomerID",)),
    Link("Contract_CustomerID", "Customer", "CustomerID", ("CustomerCode",)),
    Link("Invoice_InvoiceNumber", "DimInvoice", "InvoiceNumber", built=True),
    Link("Customer_CustomerCode", "DimCustomer", "CustomerCode", built=True),
)
_WORKED = (
    Link("CargoOpID", "CargoOperation", "CargoOpID", ("PortCallID", "ContainerID", "OperationDateTime")),
    Link("CargoOperation_PortCallID", "PortCall", "PortCallID", ("VoyageID", "PortID")),
    Link("PortCall_VoyageID", "Voyage", "VoyageID", ("ShipID",)),
    Link("PortCall_PortID", "DimPort", "PortID", built=True),
    Link("CargoOperation_ContainerID", "DimContainer", "ContainerID", built=True),
    Link("EquipmentID", "DimEquipment", "EquipmentID", built=True),
)
REJECT_LINKS = {
    "FactInvoiceLineTransaction": (
        (*_BILLED, Link("Invoice_InvoiceDate", "DimDate", "FullDate", built=True), Link("ServiceTypeID", "DimServiceType", "SourceServiceTypeID", built=True)), "unexplained",
    ),
    "FactCustomerPaymentTransaction": (
        (*_BILLED, Link("PaymentDate", "DimDate", "FullDate", built=True), Link("PaymentMethod", "DimPaymentMethod", "PaymentMethodName", built=True)), "unexplained",
    ),
    "FactSalaryPayment": (
        (Link("EmployeeID", "DimEmployee", "EmployeeID", built=True), Link("PaymentDate", "DimDateHR", "FullDate", built=True)), "DimEmployee in force on the day",
    ),
    "FactEmployeeAttendance": ((Link("AttendanceDate", "DimDateHR", "FullDate", built=True),), "unexplained"),
    "FactCargoOperationTransactional": (
        (*_WORKED, Link("cast(CargoOperation_OperationDateTime as date)", "DimDate", "FullDate", built=True), Link("Voyage_ShipID", "DimShip", "ShipID", built=True)), "unexplained",
    ),
    "FactEquipmentAssignment": ((*_WORKED, Link("cast(StartTime as date)", "DimDate", "FullDate", built=True)), "unexplained"),
}
