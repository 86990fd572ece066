"""Port-operations mart: 6 dimensions besides the calendar, 4 facts."""

from pyspark.sql import DataFrame, functions as F

from dockside.operators import additive, increment, signature
from dockside.operators.lookup import date_keys, key_lookup, version_lists, version_lookup, version_on
from dockside.operators.period import MONTH, Period, dated_in, laid_out, month_of
from dockside.operators.quality import missing_values
from dockside.operators.scd import Dimension
from dockside.sources.overlay import Overlay
from dockside.sources.shared import stored

_PERIOD = dict(start="EffectiveFrom", end="EffectiveTo")

DIMENSIONS = {
    dim.name: dim
    for dim in [
        Dimension("DimShip", "ShipSK", ("ShipID",), ("IMO_Number", "Name", "CountryID"), "versioned", required=("ShipID", "IMO_Number", "Name"), end_offset_days=0, **_PERIOD),
        Dimension("DimPort", "PortSK", ("PortID",), ("Name", "Location"), "overwrite", required=("PortID", "Name")),
        Dimension(
            "DimContainer", "ContainerSK", ("ContainerID",), ("ContainerNumber", "ContainerTypeID", "Current_OwnerCompany"), "previous_value",
            tracked=("Current_OwnerCompany",), required=("ContainerID", "ContainerNumber"),
            chain=("Current_OwnerCompany", "Original_OwnerCompany"), seed_chain=True, stamp="EffectiveDate", null_equals_blank=True,
        ),
        Dimension("DimEquipment", "EquipmentSK", ("EquipmentID",), ("EquipmentTypeID", "Model"), "overwrite", required=("EquipmentID", "EquipmentTypeID"), constants={"IsActive": True}),
        Dimension(
            "DimPortEmployee", "EmployeeSK", ("EmployeeID",),
            ("FullName", "Position", "NationalID", "HireDate", "BirthDate", "Gender", "MaritalStatus", "Address", "Phone", "Email", "EmploymentStatus"),
            "versioned", tracked=("FullName", "Position", "NationalID", "HireDate", "EmploymentStatus"), required=("EmployeeID", "FullName"),
            end_offset_days=0, **_PERIOD,
        ),
        Dimension("DimYardSlot", "YardSlotSK", ("YardSlotID",), ("YardID", "Block", "RowNumber", "TierLevel"), "overwrite", required=("YardSlotID", "YardID")),
    ]
}


def dimension_source(name: str, s) -> DataFrame:
    if name == "DimContainer":
        return s["Container"].withColumnRenamed("OwnerCompany", "Current_OwnerCompany")
    return s["Employee" if name == "DimPortEmployee" else name.removeprefix("Dim")]


def _calls(s, d) -> DataFrame:
    """Port call -> port key and ship; one row per call."""
    calls = s["PortCall"].select("PortCallID", "VoyageID", "PortID").join(s["Voyage"].select("VoyageID", "ShipID"), "VoyageID")
    return key_lookup(calls, d["DimPort"], "PortID", "PortSK").select("PortCallID", "ShipID", "PortSK")


ASSIGNED = "OperationEquipmentAssignment"
WORKED = ("FactCargoOperationTransactional", "FactEquipmentAssignment")


def _employee(rows, d, day, workers):
    """The employee's key on the day. ``workers`` are rows with every EmployeeID that ``rows`` may have, and cheaper to read: where they
    name few employees, only these are sent to the rows, which are not shuffled by employee."""
    employees = d["DimPortEmployee"]
    if workers is not None:
        employees = employees.join(workers.select("EmployeeID").distinct(), "EmployeeID", "left_semi")
    rows = version_lookup(rows, employees, "EmployeeID", day, "EmployeeSK", "EffectiveFrom", "left")
    return rows.withColumn("EmployeeSK", F.coalesce("EmployeeSK", F.lit(-1)))


def cargo_operations(s, d, month: bool = False, workers: DataFrame | None = None) -> DataFrame:
    """Transaction fact, one row per equipment assignment of a cargo operation; no known employee is key -1. ``month`` adds that of the
    assignment, to lay the fact out by. For ``workers`` see ``_employee``."""
    calls = _calls(s, d).join(version_lists(d["DimShip"], "ShipID", "ShipSK", "EffectiveFrom"), "ShipID").drop("ShipID")
    started = [month_of(F.col("StartTime").cast("date")).alias(MONTH)] if month else []
    rows = s["OperationEquipmentAssignment"].select("AssignmentID", "CargoOpID", "EquipmentID", "EmployeeID", *started)
    operations = s["CargoOperation"].select("CargoOpID", "PortCallID", "ContainerID", "OperationType", "Quantity", "WeightKG", "OperationDateTime")
    # the assignments first, which are few in an update: the further lookups see their operations only, without the ids
    rows = rows.join(operations, "CargoOpID").drop("CargoOpID").join(calls, "PortCallID").withColumn("FullDate", F.col("OperationDateTime").cast("date"))
    rows = rows.withColumn("ShipSK", version_on("FullDate")).drop("_versions", "PortCallID")
    rows = rows.join(date_keys(d["DimDate"], "DimDateID", FullDate="DateKey")["FullDate"], "FullDate")
    rows = key_lookup(rows, d["DimContainer"], "ContainerID", "ContainerSK")
    rows = key_lookup(rows, d["DimEquipment"], "EquipmentID", "EquipmentSK")
    rows = _employee(rows, d, "FullDate", workers)
    return rows.select(
        "DateKey", "FullDate", "ShipSK", "PortSK", "ContainerSK", "EquipmentSK", "EmployeeSK", "OperationType", "Quantity",
        F.col("WeightKG").cast("decimal(10,2)").alias("WeightKG"), "OperationDateTime",
        F.col("AssignmentID").alias("SourceAssignmentID"), *([MONTH] if month else []),
    )


def port_call_snapshot(s, d) -> DataFrame:
    """Periodic snapshot per port call and berth. Allocations and operations are counted apart, then joined, so
    the two never multiply; a call without a berth is kept under berth -1."""
    allocations = s["BerthAllocation"].groupBy("PortCallID", "BerthID").agg(F.count("AllocationID").alias("AllocationCount"))
    operations = s["CargoOperation"].groupBy("PortCallID").agg(F.count("CargoOpID").alias("TotalOps"))
    calls = s["PortCall"].withColumn("FullDate", F.col("ArrivalDateTime").cast("date"))
    calls = calls.join(date_keys(d["DimDate"], "DimDateID", FullDate="DateKey")["FullDate"], "FullDate")
    calls = key_lookup(calls, d["DimPort"], "PortID", "PortSK")
    calls = calls.join(allocations, "PortCallID", "left").join(operations, "PortCallID", "left")
    zero = F.lit(0).cast("bigint")
    return calls.select(
        "DateKey", "FullDate", "PortCallID", "VoyageID", "PortSK",
        F.coalesce("BerthID", F.lit(-1).cast("bigint")).alias("BerthID"), "Status",
        F.coalesce("AllocationCount", zero).alias("AllocationCount"), F.coalesce("TotalOps", zero).alias("TotalOps"),
    )


def container_movements(s, d) -> DataFrame:
    """Aggregate per port and container type; rows are cut to five columns before the joins."""
    quantity, kind = F.col("Quantity"), F.col("OperationType")
    calls = key_lookup(s["PortCall"].select("PortCallID", "PortID"), d["DimPort"], "PortID", "PortSK").select("PortCallID", "PortSK")
    moved = s["CargoOperation"].select("PortCallID", "ContainerID", "OperationType", "Quantity")
    moved = moved.join(s["Container"].select("ContainerID", "ContainerTypeID"), "ContainerID").join(calls, "PortCallID")
    return moved.groupBy("PortSK", "ContainerTypeID").agg(
        F.sum(F.when(kind == "LOAD", quantity).otherwise(0)).alias("TotalLoads"),
        F.sum(F.when(kind == "UNLOAD", quantity).otherwise(0)).alias("TotalUnloads"),
        F.sum(quantity).alias("TotalTEU"),
    )


# The totals by port and container type are sums of parts by call and month of the operations.
MOVED = ("TotalLoads", "TotalUnloads", "TotalTEU")
MOVED_BY, MOVED_KEY = ("PortSK", "ContainerTypeID"), ("PortCallID", MONTH)


def movement_entries(s, d) -> DataFrame:
    quantity, kind = F.col("Quantity"), F.col("OperationType")
    calls = key_lookup(s["PortCall"].select("PortCallID", "PortID"), d["DimPort"], "PortID", "PortSK").select("PortCallID", "PortSK")
    moved = laid_out(s["CargoOperation"], "OperationDateTime").select("PortCallID", MONTH, "ContainerID", "OperationType", "Quantity")
    moved = moved.join(_box_types(s), "ContainerID").join(calls, "PortCallID")
    loads, unloads = (F.when(kind == k, quantity) for k in ("LOAD", "UNLOAD"))
    return additive.entries(moved, MOVED_KEY, MOVED_BY, TotalLoads=loads, TotalUnloads=unloads, TotalTEU=quantity)


def _box_types(s) -> DataFrame:
    return s["Container"].select("ContainerID", "ContainerTypeID")


def movements_by_call(s) -> DataFrame:
    """Signatures of the operations by call and month, as staging publishes them."""
    rows = laid_out(s["CargoOperation"], "OperationDateTime")
    return signature.signatures(rows, MOVED_KEY, ["CargoOpID", "ContainerID", "OperationType", "Quantity"])


def movement_signatures(s, d) -> DataFrame:
    """One signature per call and month, of its operations and the call's port."""
    published = s.signatures("CargoOperation.moves") if hasattr(s, "signatures") else None
    calls = key_lookup(s["PortCall"].select("PortCallID", "PortID"), d["DimPort"], "PortID", "PortSK").select("PortCallID", "PortSK")
    rows = (movements_by_call(s) if published is None else published).join(calls, "PortCallID")
    return signature.signatures(rows, MOVED_KEY, ["PortSK", *signature.SIGNED])


def movement_state(s, d) -> dict[str, DataFrame]:
    """What is published beside the totals: their signed parts, the signatures of the sources, and each container's type."""
    return {"entries": movement_entries(s, d), "signatures": movement_signatures(s, d), "types": _box_types(s)}


def movement_deltas(state, s, d) -> DataFrame | None:
    """Signed parts of the calls that differ from ``state``; None if there are none. Only the months of such operations are read; operations
    are searched for containers only if some have another type than before."""
    changed = stored(signature.touched(state["signatures"], movement_signatures(s, d), MOVED_KEY), "moved")  # read four times
    old, new = state["types"].withColumnRenamed("ContainerTypeID", "_before"), _box_types(s)
    boxes = old.join(new, "ContainerID", "full_outer").where("not (_before <=> ContainerTypeID)").select("ContainerID")
    if not boxes.isEmpty():
        moved = laid_out(s["CargoOperation"], "OperationDateTime").join(boxes, "ContainerID", "left_semi")
        changed = changed.unionByName(moved.select(*MOVED_KEY)).distinct()
    months = sorted(r[0] for r in changed.select(MONTH).distinct().collect())  # as many as there are months
    if not months:
        return None
    moved = laid_out(s["CargoOperation"].where(dated_in("OperationDateTime", months)), "OperationDateTime")
    cut = Overlay(s, CargoOperation=moved.join(changed, list(MOVED_KEY), "left_semi").drop(MONTH))
    before = state["entries"].where(F.col(MONTH).isin(months)).join(changed, list(MOVED_KEY), "left_semi")
    return additive.deltas(before, movement_entries(cut, d), MOVED_KEY, MOVED_BY, MOVED)


def container_movement_gaps(s) -> DataFrame:
    """Joined validation: operations whose port call or container is missing or incomplete."""
    calls = s["PortCall"].select("PortCallID", F.col("PortID").alias("CallPortID"))
    boxes = s["Container"].select("ContainerID", F.col("ContainerTypeID").alias("BoxTypeID"))
    joined = s["CargoOperation"].join(calls, "PortCallID", "left").join(boxes, "ContainerID", "left")
    return missing_values(joined, ["CargoOpID", "OperationType", "Quantity", "CallPortID", "BoxTypeID"])


def equipment_assignments(s, d, month: bool = False, workers: DataFrame | None = None) -> DataFrame:
    """Factless fact: equipment worked on a day, by whom, where, on which kind of container. ``month`` adds the day's. For ``workers`` see
    ``_employee``."""
    rows = s["OperationEquipmentAssignment"].withColumn("WorkDate", F.col("StartTime").cast("date")).select("AssignmentID", "CargoOpID", "EquipmentID", "EmployeeID", "WorkDate")
    # the assignments first, as above
    rows = rows.join(s["CargoOperation"].select("CargoOpID", "PortCallID", "ContainerID"), "CargoOpID").drop("CargoOpID")
    rows = rows.join(_calls(s, d).select("PortCallID", "PortSK"), "PortCallID").drop("PortCallID")
    rows = rows.join(d["DimContainer"].select("ContainerID", "ContainerTypeID"), "ContainerID").drop("ContainerID")
    rows = rows.join(date_keys(d["DimDate"], "DimDateID", WorkDate="DateKey")["WorkDate"], "WorkDate")
    rows = key_lookup(rows, d["DimEquipment"], "EquipmentID", "EquipmentSK")
    rows = _employee(rows, d, "WorkDate", workers)
    return rows.select("DateKey", "EquipmentSK", "EmployeeSK", "PortSK", "ContainerTypeID", F.col("AssignmentID").alias("SourceAssignmentID"), *([month_of("WorkDate").alias(MONTH)] if month else []))


FACTS = {
    "FactCargoOperationTransactional": cargo_operations,
    "FactPortCallPeriodicSnapshot": port_call_snapshot,
    "FactContainerMovementsAcc": container_movements,
    "FactEquipmentAssignment": equipment_assignments,
}

def _unassigned(current, s) -> Overlay:
    """The assignments not loaded yet."""
    return Overlay(
        s, OperationEquipmentAssignment=increment.unloaded(s["OperationEquipmentAssignment"], current, "AssignmentID", "SourceAssignmentID")
    )


def update_cargo_operations(current, s, d) -> DataFrame:
    return increment.append(current, cargo_operations(_unassigned(current, s), d, workers=s[ASSIGNED]))


def update_equipment_assignments(current, s, d) -> DataFrame:
    return increment.append(current, equipment_assignments(_unassigned(current, s), d, workers=s[ASSIGNED]))


def update_container_movements(current, s, d) -> DataFrame:
    return increment.rebuild(container_movements(s, d))


def call_signatures(s, d) -> DataFrame:
    """One signature per port call, of the call itself, its keys, its allocations and its operations."""
    rows = s["PortCall"].withColumn("FullDate", F.col("ArrivalDateTime").cast("date"))
    rows = rows.join(date_keys(d["DimDate"], "DimDateID", FullDate="DateKey")["FullDate"], "FullDate")
    rows = key_lookup(rows, d["DimPort"], "PortID", "PortSK")
    for table in SIGNED_CHILDREN:
        rows = rows.join(signature.signed(table, *SIGNED_CHILDREN[table], s), "PortCallID", "left")
    used = ["DateKey", "FullDate", "VoyageID", "PortSK", "Status", *(c for table in SIGNED_CHILDREN for c in signature.named(table))]
    return signature.signatures(rows, ["PortCallID"], used)


def update_port_call_snapshot(current, s, d, seen=None, now=None) -> DataFrame:
    """The rows of a first load over today's sources, by touching only calls that have changed, come, gone, or got other allocations
    or operations. ``seen`` has the signatures published with ``current``, ``now`` today's, if they are at hand; without ``seen`` all
    rows are built and compared, and the calls of the latest loaded day and later ones count as new."""
    if seen is None:
        latest = current.agg(F.coalesce(F.max("FullDate"), F.lit("0001-01-01").cast("date"))).scalar()
        built = port_call_snapshot(s, d)
        return signature.follow_rows(current, built, ["PortCallID"], built.where(F.col("FullDate") >= latest))
    changed = signature.touched(seen, call_signatures(s, d) if now is None else now, ["PortCallID"])
    fresh = {table: s[table].join(changed, "PortCallID", "left_semi") for table in ("PortCall", *SIGNED_CHILDREN)}
    return increment.replace_keys(current, port_call_snapshot(Overlay(s, **fresh), d), ["PortCallID"], changed)


UPDATES = {
    "FactCargoOperationTransactional": update_cargo_operations,
    "FactEquipmentAssignment": update_equipment_assignments,
    "FactContainerMovementsAcc": update_container_movements,
    "FactPortCallPeriodicSnapshot": update_port_call_snapshot,
}

# Tables whose signatures staging publishes by port call: (key, columns the snapshot uses)
SIGNED_CHILDREN = {"BerthAllocation": (["PortCallID"], ["AllocationID", "BerthID"]), "CargoOperation": (["PortCallID"], ["CargoOpID"])}
SIGNATURES = {"FactPortCallPeriodicSnapshot": call_signatures}
FOLLOWED = {}
# Totals kept by signed parts: (state beside the totals, parts to add, groups, measures)
ADDITIVE = {"FactContainerMovementsAcc": (movement_state, movement_deltas, MOVED_BY, MOVED)}
# Further signatures that staging publishes: {table: {name: function of the staged tables}}
STAGED_SIGNATURES = {"CargoOperation": {"moves": movements_by_call}}

# Facts published by the month of their source rows
_ASSIGNED = Period("OperationEquipmentAssignment", "AssignmentID", "SourceAssignmentID", "StartTime")
PERIODS = {"FactCargoOperationTransactional": _ASSIGNED, "FactEquipmentAssignment": _ASSIGNED}
