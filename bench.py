"""Times the headline loads at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from dockside.queries import registry
from dockside.session import local_session

HEADLINE = [
    "stage_invoice_line",
    "stage_cargo_operation",
    "duplicate_keys",
    "surrogate_keys",
    "dim_customer_update",
    "dim_service_type_update",
    "dim_contract_update",
    "dim_invoice_update",
    "dim_container_update",
    "fact_invoice_line_first",
    "fact_invoice_line_update",
    "fact_customer_payment_first",
    "fact_billing_snapshot_first",
    "fact_invoice_lifecycle_first",
    "fact_invoice_lifecycle_update",
    "fact_contract_activation_first",
    "fact_salary_payment_first",
    "fact_employee_attendance_update",
    "fact_monthly_performance_first",
    "fact_employee_lifecycle_first",
    "fact_cargo_operation_first",
    "fact_cargo_operation_update",
    "fact_port_call_snapshot_first",
    "fact_container_movements_first",
    "fact_equipment_assignment_first",
    "asof_lookup",
]


def main():
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("dockside-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    available = registry()
    available["row_counts"](spark, directory).collect()  # JVM and schema warm-up
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        started = time.time()
        available[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
