"""Classification catalog, masking, persona views, salary perturbation and retention."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spendlens.functions import exprs
from spendlens.plans.employees import DEFAULT_DOMAIN

INTERNAL, CONFIDENTIAL = "Internal", "Confidential"
PERSONAL, SENSITIVE = "Personal Data (PII)", "Confidential / Sensitive"

# fixed values: dataset, column, type, classification, personal reference
CATALOG = [
    ("projects", "project_id", "VARCHAR", INTERNAL, "No"),
    ("projects", "project_name", "VARCHAR", INTERNAL, "No"),
    ("projects", "department", "VARCHAR", INTERNAL, "No"),
    ("projects", "status", "VARCHAR", INTERNAL, "No"),
    ("projects", "start_date", "DATE", INTERNAL, "No"),
    ("projects", "end_date", "DATE", INTERNAL, "No"),
    ("projects", "budget", "NUMERIC", CONFIDENTIAL, "No"),
    ("projects", "actual_cost", "NUMERIC", CONFIDENTIAL, "No"),
    ("projects", "project_manager_id", "VARCHAR", INTERNAL, "Indirect"),
    ("projects", "priority", "VARCHAR", INTERNAL, "No"),
    ("projects", "region", "VARCHAR", INTERNAL, "No"),
    ("employees", "employee_id", "VARCHAR", INTERNAL, "Indirect"),
    ("employees", "full_name", "VARCHAR", PERSONAL, "Direct"),
    ("employees", "email", "VARCHAR", PERSONAL, "Direct"),
    ("employees", "department", "VARCHAR", INTERNAL, "No"),
    ("employees", "role", "VARCHAR", INTERNAL, "No"),
    ("employees", "level", "VARCHAR", INTERNAL, "No"),
    ("employees", "hire_date", "DATE", PERSONAL, "Indirect"),
    ("employees", "salary", "NUMERIC", SENSITIVE, "Indirect"),
    ("employees", "manager_id", "VARCHAR", INTERNAL, "Indirect"),
    ("employees", "region", "VARCHAR", INTERNAL, "No"),
    ("employees", "status", "VARCHAR", INTERNAL, "No"),
    ("employees", "years_experience", "INTEGER", INTERNAL, "No"),
    ("employees_salary_history", "history_id", "VARCHAR", INTERNAL, "No"),
    ("employees_salary_history", "employee_id", "VARCHAR", INTERNAL, "Indirect"),
    ("employees_salary_history", "effective_date", "DATE", PERSONAL, "Indirect"),
    ("employees_salary_history", "end_date", "DATE", INTERNAL, "No"),
    ("employees_salary_history", "previous_salary", "NUMERIC", SENSITIVE, "Indirect"),
    ("employees_salary_history", "new_salary", "NUMERIC", SENSITIVE, "Indirect"),
    ("employees_salary_history", "department", "VARCHAR", INTERNAL, "No"),
    ("employees_salary_history", "role", "VARCHAR", INTERNAL, "No"),
    ("employees_salary_history", "level", "VARCHAR", INTERNAL, "No"),
    ("employees_salary_history", "change_reason", "VARCHAR", INTERNAL, "No"),
    ("transactions", "transaction_id", "VARCHAR", INTERNAL, "No"),
    ("transactions", "project_id", "VARCHAR", INTERNAL, "No"),
    ("transactions", "vendor_id", "VARCHAR", INTERNAL, "No"),
    ("transactions", "vendor_name", "VARCHAR", CONFIDENTIAL, "No"),
    ("transactions", "amount", "NUMERIC", CONFIDENTIAL, "No"),
    ("transactions", "currency", "VARCHAR", INTERNAL, "No"),
    ("transactions", "amount_aed", "NUMERIC", CONFIDENTIAL, "No"),
    ("transactions", "category", "VARCHAR", INTERNAL, "No"),
    ("transactions", "payment_status", "VARCHAR", INTERNAL, "No"),
    ("transactions", "transaction_date", "DATE", INTERNAL, "No"),
    ("transactions", "invoice_ref", "VARCHAR", CONFIDENTIAL, "No"),
    ("transactions", "approved_by", "VARCHAR", INTERNAL, "Indirect"),
]

NONE, FULL, MASKED, AGGREGATED, OWN = "none", "full", "masked", "aggregated", "own"

# fixed values: what a persona sees of each dataset
PERSONAS: dict[str, dict[str, str]] = {
    "data_engineer": {"projects": FULL, "employees": FULL, "transactions": FULL, "employees_salary_history": NONE},
    "bi_analyst": {"projects": AGGREGATED, "employees": MASKED, "transactions": AGGREGATED, "employees_salary_history": NONE},
    "finance": {"projects": FULL, "employees": NONE, "transactions": FULL, "employees_salary_history": FULL},
    "hr": {"projects": NONE, "employees": FULL, "transactions": NONE, "employees_salary_history": FULL},
    "executive": {"projects": FULL, "employees": FULL, "transactions": FULL, "employees_salary_history": NONE},
    "auditor": {"projects": FULL, "employees": FULL, "transactions": FULL, "employees_salary_history": FULL},
    "project_manager": {"projects": OWN, "employees": OWN, "transactions": OWN, "employees_salary_history": NONE},
}
SEES_SALARY = ("hr", "auditor", "finance")

# fixed values: years a record is kept, counted from its date, and the date column. What is kept by
# employment gets its date from :func:`with_employment_end`.
RETENTION_YEARS: dict[str, tuple[str, int]] = {
    "employees": ("employment_end", 5),
    "employees_salary_history": ("employment_end", 10),
    "transactions": ("transaction_date", 7),
    "projects": ("end_date", 7),
    "events": ("timestamp", 1),
    "dq_results": ("run_at", 5),
}
COMPRESSED_EVENT_YEARS = 2  # fixed value: events stay two more years in compressed form


def catalog(spark: SparkSession) -> DataFrame:
    schema = "dataset string, column_name string, data_type string, classification string, pii string"
    return spark.createDataFrame(CATALOG, schema)


def mask_name(column: Column) -> Column:
    """First letter of each word, the rest as asterisks: ``A*** C***``."""
    return F.regexp_replace(F.trim(column), r"(\S)\S*", "$1***")


def mask_email(column: Column, domain: str = DEFAULT_DOMAIN) -> Column:
    return F.concat(F.sha2(column, 256), F.lit(f"@{domain}"))


def mask_employees(employees: DataFrame, domain: str = DEFAULT_DOMAIN) -> DataFrame:
    """Employee rows with masked names and hashed addresses."""
    return employees.withColumns({
        "full_name": mask_name(F.col("full_name")),
        "email": mask_email(F.col("email"), domain),
    })


def persona_view(
    df: DataFrame, dataset: str, persona: str, domain: str = DEFAULT_DOMAIN,
    personas: Mapping[str, Mapping[str, str]] = PERSONAS,
    person: str | None = None, projects: DataFrame | None = None,
) -> DataFrame:
    """``df`` as the persona may see it; ``PermissionError`` when there is no access.

    Masked access hashes identifiers of people, masks names and addresses and drops other
    personal columns. Aggregated access returns counts and sums over the public text columns
    with few values. Own access gives the projects that ``person`` manages, the transactions of these
    (``projects`` says which they are) and the names of the people who report to them. Salaries stay with the
    personas in ``SEES_SALARY``.
    """
    access = personas[persona].get(dataset, NONE)
    if access == NONE:
        raise PermissionError(f"{persona} has no access to {dataset}")
    classes = {name: (kind, pii) for table, name, _, kind, pii in CATALOG if table == dataset}
    unclassified = [name for name in df.columns if name not in classes]
    if access not in (FULL, OWN):
        df = df.drop(*unclassified)
    if persona not in SEES_SALARY:
        df = df.drop(*[name for name, (kind, _) in classes.items() if kind == SENSITIVE])
    if access == OWN:
        if person is None:
            raise PermissionError(f"{persona} sees own rows only: say whose")
        if dataset == "employees":
            return team_names(df, person)
        return own_projects(df, person) if dataset == "projects" else own_transactions(df, projects, person)
    if access == FULL:
        return df
    if access == AGGREGATED:
        return _aggregate_view(df, dataset, classes)

    def seen(name: str) -> Column | None:
        kind, pii = classes[name]
        if name == "full_name":
            return mask_name(F.col(name)).alias(name)
        if name == "email":
            return mask_email(F.col(name), domain).alias(name)
        if kind == PERSONAL:
            return None
        if pii == "Indirect":
            return F.sha2(F.col(name).cast("string"), 256).alias(name)
        return F.col(name)

    return df.select(*[column for column in map(seen, df.columns) if column is not None])


AGGREGATE_BY = {
    "projects": ("department", "status", "priority", "region"),
    "transactions": ("category", "payment_status", "currency"),
}


def _aggregate_view(df: DataFrame, dataset: str, classes: Mapping[str, tuple[str, str]]) -> DataFrame:
    measures = [
        name for table, name, kind, _, _ in CATALOG
        if table == dataset and kind == "NUMERIC" and name in df.columns
    ]
    return df.groupBy(*AGGREGATE_BY[dataset]).agg(
        F.count("*").alias("row_count"),
        *[F.sum(F.col(name).cast("decimal(28,2)")).alias(f"total_{name}") for name in measures],
    )


def own_projects(projects: DataFrame, manager_id: str) -> DataFrame:
    """The projects a project manager may see."""
    return projects.where(F.col("project_manager_id") == manager_id)


def own_transactions(transactions: DataFrame, projects: DataFrame, manager_id: str) -> DataFrame:
    """The transactions of a project manager's own projects."""
    return transactions.join(
        own_projects(projects, manager_id).select("project_id"), "project_id", "left_semi"
    )


def team_names(employees: DataFrame, manager_id: str) -> DataFrame:
    """Names of the people who report to a project manager."""
    return employees.where(F.col("manager_id") == manager_id).select("full_name")


def perturb_salaries(
    employees: DataFrame, seed: int = 7, spread: float = 0.05, limit: float = 0.10
) -> DataFrame:
    """Test copy with synthetic ids and salaries moved by Gaussian noise of at most ``limit``.

    The noise is a function of the id and the seed, so a repeated task gives the same rows.
    """
    noise = exprs.gaussian(seed, "employee_id") * spread
    clipped = F.greatest(F.least(noise, F.lit(limit)), F.lit(-limit))

    def synthetic(name: str) -> Column:
        text = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(name)), 256)
        return F.when(F.col(name).isNotNull(), F.concat(F.lit("SYN"), text))

    return employees.withColumns({
        "salary": F.round(exprs.as_double(employees, "salary") * (1 + clipped), 2),
        "employee_id": synthetic("employee_id"),
        "manager_id": synthetic("manager_id"),
    })


def retention(df: DataFrame, date_column: str, years: int, as_of: str, archive_years: int = 0) -> DataFrame:
    """Add ``retention_state``: keep, archive or expire by age; undated rows are kept."""
    day = exprs.as_date(df, date_column)
    today = F.lit(as_of).cast("date")
    return df.withColumn(
        "retention_state",
        F.when(day < F.add_months(today, -12 * (years + archive_years)), "expire")
        .when(day < F.add_months(today, -12 * years), "archive" if archive_years else "expire")
        .otherwise("keep"),
    )


def with_employment_end(df: DataFrame, employees: DataFrame, history: DataFrame) -> DataFrame:
    """Rows with ``employee_id`` and the last day on record of people who have left; null for all others."""
    ended = employees.where(F.trim("status").isin("Inactive", "Terminated")).select("employee_id").distinct()
    last = history.groupBy("employee_id").agg(F.max(exprs.as_date(history, "effective_date")).alias("employment_end"))
    return df.join(ended.join(last, "employee_id"), "employee_id", "left")


def event_retention(events: DataFrame, as_of: str) -> DataFrame:
    """Events are kept for their time, then archived in compressed form, then expire."""
    column, years = RETENTION_YEARS["events"]
    return retention(events, column, years, as_of, COMPRESSED_EVENT_YEARS)


def retention_split(df: DataFrame, date_column: str, years: int, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(kept, expired) rows."""
    tagged = retention(df, date_column, years, as_of)
    kept = tagged.where("retention_state = 'keep'").drop("retention_state")
    return kept, tagged.where("retention_state = 'expire'").drop("retention_state")
