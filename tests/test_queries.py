"""Registered queries against their SQL, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from compare import difference
from dockside.queries import registry
from oracle.sql import statements

TABLES = "region nation customer supplier part orders lineitem events".split()
CHOSEN = [
    "stage_invoice_line", "stage_department", "dim_date_hr_first", "dim_date_missing_days", "dim_customer_update", "dim_tax_update", "dim_contract_update",
    "dim_employee_update", "dim_container_update", "dim_job_title_update", "fact_invoice_line_first", "fact_billing_snapshot_reference_grain",
    "fact_invoice_lifecycle_update", "fact_customer_payment_update", "fact_termination_update", "fact_employee_lifecycle_update",
    "fact_monthly_performance_update", "fact_cargo_operation_update", "fact_port_call_snapshot_update", "fact_yearly_headcount", "load_port_facts_update",
    "fact_billing_snapshot_after_corrections", "fact_employee_lifecycle_after_corrections", "fact_port_call_snapshot_after_corrections",
    "referential_report", "staging_reconciliation", "report_top_invoice_lines", "report_latest_payments",
    "declared_types_finance_staging", "declared_types_finance_marts", "bulk_load_payments",
    "asof_lookup", "orphan_report", "hr_facts_after_two_nights", "finance_payments_shifted_days",
]


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(registry()) == set(statements()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, small, duck, name):
    assert difference(queries()[name](spark, small), duck.execute(oracle_sql()[name])) is None
