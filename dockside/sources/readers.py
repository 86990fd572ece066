"""Delimited text exports into source tables: declared schema, header skipped; bad rows refuse the file or go into quarantine."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dockside.operators.declared import problems, schema_of, typed

MALFORMED = "_malformed"

# Column order of the exported files; clock times stay text, they are copied and never computed on.
EXPORTS = {
    "Employee": (
        ":",
        "EmployeeID bigint, FullName string, Position string, NationalID string, HireDate date, BirthDate date, Gender string, "
        "MaritalStatus string, Address string, Phone string, Email string, EmploymentStatus string",
    ),
    "Attendance": (
        ",",
        "AttendanceID bigint, EmployeeID bigint, AttendanceDate date, Status string, CheckInTime string, CheckOutTime string, "
        "HoursWorked decimal(5,2), Notes string",
    ),
    "SalaryPayment": (
        ",",
        "SalaryPaymentID bigint, EmployeeID bigint, PaymentDate date, Amount decimal(15,2), Bonus decimal(15,2), Deductions decimal(15,2), "
        "NetAmount decimal(15,2), PaymentMethod string, ReferenceNumber string",
    ),
}


def read_delimited(spark: SparkSession, path: str, schema: str, separator: str = ",") -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", separator)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_export(spark: SparkSession, path: str, table: str) -> DataFrame:
    separator, schema = EXPORTS[table]
    return read_delimited(spark, path, schema, separator)


def read_quarantined(spark: SparkSession, path: str, declared: str | T.StructType, separator: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows as declared, quarantine). The quarantine has (SourceFile, Line, Problems): lines with too few or too many fields, and lines
    with values that their columns cannot hold, each problem named. Every line is in one of the two; repeated lines stay, an empty
    field is null, empty lines are no rows. Fields are read as text first, so that no value is lost before it is judged.
    """
    schema = schema_of(declared)
    names = [f.name for f in schema.fields]
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, MALFORMED]])
    lines = (
        spark.read.schema(text)
        .option("header", header)
        .option("enforceSchema", False)
        .option("sep", separator)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)  # with it, a line's fields would be counted only as far as a query reads them
        .csv(path)
        .withColumn("SourceFile", F.input_file_name())
    )
    judged = lines.withColumn("Problems", F.when(F.col(MALFORMED).isNotNull(), F.array(F.lit("line: fields"))).otherwise(problems(schema)))
    line = F.coalesce(MALFORMED, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]), {"sep": separator}))
    rows = judged.where(F.size("Problems") == 0).select(*[typed(f).alias(f.name) for f in schema.fields])
    return rows, judged.where(F.size("Problems") > 0).select("SourceFile", line.alias("Line"), "Problems")
