"""Column contracts of the raw inputs and of the warehouse tables."""

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    """Raw files are read as text; the operators cast column by column."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


PROJECTS_RAW = _text(
    "project_id", "project_name", "department", "status", "start_date", "end_date",
    "budget", "actual_cost", "project_manager_id", "priority", "region",
)

EMPLOYEES_RAW = _text(
    "employee_id", "full_name", "email", "department", "role", "level", "hire_date",
    "salary", "manager_id", "region", "status", "years_experience",
)

HISTORY_RAW = _text(
    "history_id", "employee_id", "effective_date", "end_date", "previous_salary",
    "new_salary", "new_role", "new_level", "change_type", "change_reason",
)

TRANSACTIONS_RAW = _text(
    "transaction_id", "project_id", "vendor_id", "vendor_name", "amount", "currency",
    "category", "payment_status", "transaction_date", "invoice_ref", "approved_by",
)

EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("project_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
])

STREAM_EVENTS = T.StructType(EVENTS.fields + [T.StructField("produced_at", T.TimestampType())])

MONEY = T.DecimalType(15, 2)
SALARY = T.DecimalType(12, 2)
PERCENT = T.DecimalType(12, 2)

DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("week", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("day_of_week", T.StringType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
])

DIM_PROJECT = T.StructType([
    T.StructField("project_key", T.LongType(), False),
    T.StructField("project_id", T.StringType(), False),
    T.StructField("project_name", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("status_category", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("duration_days", T.IntegerType()),
    T.StructField("budget", MONEY),
    T.StructField("actual_cost", MONEY),
    T.StructField("budget_variance", MONEY),
    T.StructField("is_over_budget", T.BooleanType()),
    T.StructField("budget_utilisation_pct", PERCENT),
    T.StructField("risk_level", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("project_manager_id", T.StringType()),
])

DIM_EMPLOYEE = T.StructType([
    T.StructField("employee_key", T.LongType(), False),
    T.StructField("employee_id", T.StringType(), False),
    T.StructField("full_name", T.StringType(), False),
    T.StructField("email", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("salary", SALARY),
    T.StructField("manager_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("years_experience", T.IntegerType()),
    T.StructField("valid_from", T.DateType(), False),
    T.StructField("valid_to", T.DateType(), False),
    T.StructField("is_current", T.BooleanType(), False),
    T.StructField("change_reason", T.StringType()),
])

DIM_VENDOR = T.StructType([
    T.StructField("vendor_key", T.LongType(), False),
    T.StructField("vendor_id", T.StringType(), False),
    T.StructField("vendor_name", T.StringType()),
])

BRIDGE_EMPLOYEE_PROJECT = T.StructType([
    T.StructField("bridge_key", T.LongType(), False),
    T.StructField("project_key", T.LongType(), False),
    T.StructField("employee_key", T.LongType(), False),
    T.StructField("role_in_project", T.StringType()),
    T.StructField("allocation_pct", T.DecimalType(5, 2)),
])

FACT_TRANSACTIONS = T.StructType([
    T.StructField("transaction_key", T.LongType(), False),
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("project_key", T.LongType(), False),
    T.StructField("employee_key", T.LongType(), False),
    T.StructField("vendor_key", T.LongType(), False),
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("amount_aed", MONEY),
    T.StructField("category", T.StringType()),
    T.StructField("payment_status", T.StringType()),
    T.StructField("invoice_ref", T.StringType()),
    T.StructField("is_approved", T.BooleanType()),
])

WAREHOUSE = {
    "dim_date": DIM_DATE,
    "dim_project": DIM_PROJECT,
    "dim_employee": DIM_EMPLOYEE,
    "dim_vendor": DIM_VENDOR,
    "bridge_employee_project": BRIDGE_EMPLOYEE_PROJECT,
    "fact_transactions": FACT_TRANSACTIONS,
}
