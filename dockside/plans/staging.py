"""Staging loads: validate an operational table, widen its types, stamp the load time."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from dockside.operators.quality import Checks, validation_report


@dataclass(frozen=True)
class Stage:
    """``non_blank`` names the required string columns where '' counts as missing."""

    area: str
    table: str
    required: tuple
    non_blank: tuple = ()
    types: dict = field(default_factory=dict)
    load_date: bool = True

    @property
    def key(self) -> tuple:
        return self.required[:1]

    @property
    def checks(self) -> Checks:
        return Checks(self.key, self.required, self.non_blank)


def _stage(area, table, required, non_blank="", load_date=True, **types):
    return Stage(area, table, tuple(required.split()), tuple(non_blank.split()), types, load_date)


_MONEY = "decimal(18,4)"

# The first required column is the primary key.
STAGES: dict[str, Stage] = {
    "customer": _stage("finance", "Customer", "CustomerID CustomerCode CustomerName CustomerType"),
    "billing_cycle": _stage("finance", "BillingCycle", "BillingCycleID CycleName"),
    "service_type": _stage("finance", "ServiceType", "ServiceTypeID ServiceName", BaseRate=_MONEY),
    "tax": _stage("finance", "Tax", "TaxID TaxName TaxRate TaxType EffectiveFrom", TaxRate="decimal(6,3)"),
    "tariff": _stage("finance", "Tariff", "TariffID ServiceTypeID ValidFrom UnitRate", UnitRate=_MONEY),
    "contract": _stage("finance", "Contract", "ContractID CustomerID ContractNumber"),
    "invoice": _stage(
        "finance", "Invoice", "InvoiceID ContractID InvoiceNumber InvoiceDate DueDate TotalAmount TaxAmount", TotalAmount=_MONEY, TaxAmount=_MONEY
    ),
    "invoice_line": _stage(
        "finance", "InvoiceLine", "InvoiceLineID InvoiceID ServiceTypeID Quantity UnitPrice TaxAmount NetAmount",
        UnitPrice=_MONEY, DiscountPercent="decimal(6,4)", TaxAmount=_MONEY, NetAmount=_MONEY,
    ),
    "payment": _stage("finance", "Payment", "PaymentID InvoiceID PaymentDate Amount PaymentMethod", Amount=_MONEY),
    "revenue_recognition": _stage("finance", "RevenueRecognition", "RecognitionID InvoiceID DateRecognized Amount", Amount=_MONEY),
    "employee": _stage("hr", "Employee", "EmployeeID FullName"),
    "department": _stage("hr", "Department", "DepartmentID DepartmentName"),
    "job_title": _stage("hr", "JobTitle", "JobTitleID JobTitleName"),
    "employment_history": _stage("hr", "EmploymentHistory", "EmploymentHistoryID EmployeeID JobTitleID DepartmentID StartDate"),
    "termination": _stage("hr", "Termination", "TerminationID EmployeeID TerminationDate TerminationReason"),
    "attendance": _stage("hr", "Attendance", "AttendanceID EmployeeID AttendanceDate Status"),
    "salary_payment": _stage("hr", "SalaryPayment", "SalaryPaymentID EmployeeID PaymentDate Amount NetAmount"),
    "training_program": _stage("hr", "TrainingProgram", "TrainingProgramID ProgramName"),
    "employee_training": _stage("hr", "EmployeeTraining", "EmployeeTrainingID EmployeeID TrainingProgramID TrainingDate CompletionStatus"),
    "leave_type": _stage("hr", "LeaveType", "LeaveTypeID LeaveTypeName"),
    "leave_request": _stage("hr", "LeaveRequest", "LeaveRequestID EmployeeID LeaveTypeID StartDate EndDate Status RequestDate"),
    "country": _stage("port", "Country", "CountryID CountryName", "CountryName", False),
    "employee_port": _stage("port", "Employee", "EmployeeID FullName", "FullName", False),
    "container_type": _stage("port", "ContainerType", "ContainerTypeID Description MaxWeightKG", "Description", False),
    "equipment_type": _stage("port", "EquipmentType", "EquipmentTypeID Description", "Description", False),
    "container": _stage("port", "Container", "ContainerID ContainerNumber ContainerTypeID OwnerCompany", "OwnerCompany", False),
    "equipment": _stage("port", "Equipment", "EquipmentID EquipmentTypeID Model", "Model", False),
    "port": _stage("port", "Port", "PortID Name", "Name", False),
    "ship": _stage("port", "Ship", "ShipID IMO_Number Name", "IMO_Number Name", False),
    "voyage": _stage("port", "Voyage", "VoyageID ShipID VoyageNumber", "", False),
    "port_call": _stage("port", "PortCall", "PortCallID VoyageID PortID ArrivalDateTime", "", False),
    "berth": _stage("port", "Berth", "BerthID PortID Name", "Name", False),
    "berth_allocation": _stage("port", "BerthAllocation", "AllocationID PortCallID BerthID", "", False),
    "yard": _stage("port", "Yard", "YardID PortID Name", "Name", False),
    "yard_slot": _stage("port", "YardSlot", "YardSlotID YardID Block", "Block", False),
    "container_yard_movement": _stage(
        "port", "ContainerYardMovement", "MovementID ContainerID YardSlotID MovementType MovementDateTime", "MovementType", False
    ),
    "cargo_operation": _stage(
        "port", "CargoOperation", "CargoOpID PortCallID ContainerID OperationType OperationDateTime Quantity WeightKG", "OperationType", False
    ),
    "operation_equipment_assignment": _stage(
        "port", "OperationEquipmentAssignment", "AssignmentID CargoOpID EquipmentID StartTime EndTime", "", False
    ),
}


def stage(source: DataFrame, spec: Stage, run_time=None) -> tuple[DataFrame, DataFrame]:
    """(rows to write, validation report). Both are lazy; loads make the same checks with the write (``Stage.checks``)."""
    report = validation_report(source, spec.key, spec.required, spec.non_blank)
    staged = source.withColumns({c: F.col(c).cast(t) for c, t in spec.types.items() if c in source.columns})
    if spec.load_date and run_time is not None:
        staged = staged.withColumn("LoadDate", F.lit(run_time).cast("timestamp_ntz"))
    return staged, report
