"""Synthetic port tables of any size for trial runs: every value is a hash of its row number, so the same seed
gives the same tables on any cluster. Child rows point at existing parents."""

from pyspark.sql import DataFrame, SparkSession

FIRST_DAY = "2022-03-01"
CONTAINER_TYPES = "array('Short box', 'Long box', 'Cooled short box', 'Cooled long box', 'Open top')"
EQUIPMENT_TYPES = "array('Gantry', 'Lift truck', 'Quay tractor', 'Spreader', 'Tower lift')"
USAGE = "array('INBOUND', 'OUTBOUND', 'STORAGE')"
MOVES = "array('ARRIVE', 'LEAVE', 'SHIFT')"


def _pick(count: int, salt: str, seed: int) -> str:
    """1..count, evenly."""
    return f"pmod(xxhash64(id, '{salt}', {seed}), {count}) + 1"


def _of(values: str, index: str) -> str:
    return f"element_at({values}, cast({index} as int))"


def port_tables(spark: SparkSession, operations: int = 1_000_000, assignments: int = 1_000_000, movements: int = 200_000, seed: int = 1) -> dict[str, DataFrame]:
    ports, voyages, calls, containers, equipment, employees, ships = 20, 500, 1000, 10_000, 50, 100, 20
    yards, berths, slots = ports * 3, ports * 5, ports * 150
    pick = lambda count, salt: _pick(count, salt, seed)
    moment = lambda salt: f"timestampadd(SECOND, cast({pick(86400 * 500, salt)} as int), timestamp_ntz'{FIRST_DAY} 00:00:00')"
    day = lambda salt, span: f"date_add(date'{FIRST_DAY}', -cast({pick(span, salt)} as int))"
    # a call belongs to one voyage, a berth and a yard to one port: parents follow from the row number
    port_of = f"pmod(id, {ports}) + 1"
    columns = {
        "Country": (ports, "id as CountryID, concat('Country ', id) as CountryName, cast(id as string) as CountryCode"),
        "Port": (ports, "id as PortID, concat('Port ', id) as Name, concat('Coast ', id) as Location"),
        "Ship": (ships, f"id as ShipID, concat('IMO', lpad(id, 7, '0')) as IMO_Number, concat('Ship ', id) as Name, {pick(ports, 'flag')} as CountryID"),
        "Employee": (
            employees,
            f"id as EmployeeID, concat('Emp ', id) as FullName, if(id % 3 = 0, 'Operator', 'Clerk') as Position, lpad(id, 10, '0') as NationalID, "
            f"{day('hire', 900)} as HireDate, {day('birth', 15000)} as BirthDate, if(id % 2 = 0, 'Male', 'Female') as Gender, 'Single' as MaritalStatus, "
            "concat('Quay ', id) as Address, lpad(id, 11, '09') as Phone, concat('e', id, '@x.test') as Email, 'Active' as EmploymentStatus",
        ),
        "ContainerType": (5, f"id as ContainerTypeID, {_of(CONTAINER_TYPES, 'id')} as Description, cast(20000 + id * 2000 as double) as MaxWeightKG"),
        "EquipmentType": (5, f"id as EquipmentTypeID, {_of(EQUIPMENT_TYPES, 'id')} as Description"),
        "Container": (containers, f"id as ContainerID, concat('CONT', lpad(id, 8, '0')) as ContainerNumber, {pick(5, 'kind')} as ContainerTypeID, concat('Line ', {pick(10, 'owner')}) as OwnerCompany"),
        "Equipment": (equipment, f"id as EquipmentID, {pick(5, 'machine')} as EquipmentTypeID, concat('Model ', {pick(15, 'model')}) as Model"),
        "Yard": (yards, f"id as YardID, {port_of} as PortID, concat('Yard ', id) as Name, {_of(USAGE, 'id % 3 + 1')} as UsageType"),
        "YardSlot": (slots, f"id as YardSlotID, pmod(id, {yards}) + 1 as YardID, char(65 + cast(id % 5 as int)) as Block, cast(id % 10 + 1 as int) as RowNumber, cast(id % 4 + 1 as int) as TierLevel"),
        "Voyage": (voyages, f"id as VoyageID, {pick(ships, 'ship')} as ShipID, concat('VYG', lpad(id, 4, '0')) as VoyageNumber, {pick(ports, 'from')} as DeparturePortID, {pick(ports, 'to')} as ArrivalPortID"),
        "PortCall": (calls, f"id as PortCallID, pmod(id, {voyages}) + 1 as VoyageID, {pick(ports, 'at')} as PortID, {moment('arrive')} as ArrivalDateTime, if(id % 2 = 0, 'Docked', 'Departed') as Status"),
        "Berth": (berths, f"id as BerthID, {port_of} as PortID, concat('Berth ', id) as Name, cast(100 + 20 * (id % 5) as double) as LengthMeters"),
        "BerthAllocation": (calls * 5, f"id as AllocationID, pmod(id, {calls}) + 1 as PortCallID, {pick(berths, 'berth')} as BerthID, {moment('berthed')} as AllocationStart"),
        "CargoOperation": (
            operations,
            f"id as CargoOpID, {pick(calls, 'call')} as PortCallID, {pick(containers, 'box')} as ContainerID, if({pick(2, 'way')} = 1, 'LOAD', 'UNLOAD') as OperationType, "
            f"{moment('worked')} as OperationDateTime, cast({pick(8, 'amount')} as int) as Quantity, ({pick(2400, 'weight')} + 300) / 100.0 as WeightKG",
        ),
        "OperationEquipmentAssignment": (
            assignments,
            f"id as AssignmentID, pmod(id, {operations}) + 1 as CargoOpID, {pick(equipment, 'machine')} as EquipmentID, {pick(employees, 'driver')} as EmployeeID, "
            f"{moment('start')} as StartTime, timestampadd(MINUTE, cast(4 + {pick(80, 'minutes')} as int), {moment('start')}) as EndTime",
        ),
        "ContainerYardMovement": (
            movements,
            f"id as MovementID, pmod(id, {containers}) + 1 as ContainerID, pmod(id, {slots}) + 1 as YardSlotID, {_of(MOVES, pick(3, 'move'))} as MovementType, {moment('moved')} as MovementDateTime",
        ),
    }
    return {name: spark.sql(f"select {text} from range(1, {rows + 1})") for name, (rows, text) in columns.items()}
