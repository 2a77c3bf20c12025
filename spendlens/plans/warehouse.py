"""Star schema: calendar, projects, versioned employees, vendors, bridge and transaction facts."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spendlens import schemas
from spendlens.functions import exprs
from spendlens.operators import dedup, lookups, ordering, temporal
from spendlens.plans.employees import DEFAULT_DOMAIN
from spendlens.session import PACKED_TABLE, dealt_alike, materialize
from spendlens.sources.writers import enforce_schema

CALENDAR = ("2020-01-01", "2026-12-31")  # fixed values: default bounds of dim_date
RANGE = "_range"  # of ids, by which rows are dealt
UNKNOWN_EMPLOYEE_KEY = 1  # fixed value: key given to facts without a known approver


def _keyed(df: DataFrame, key: str, natural_key: str) -> DataFrame:
    """Dense surrogate key along the natural key; the first row of a repeated key is kept.

    The sort computes its input twice, for the borders of its ranges and to move the rows, from the last shuffle on, which is
    stored already. Repeats are looked for in the sorted copy, so unique input is shuffled a single time.
    """
    rows = ordering.ordered(df, natural_key)
    unique = dedup.unique_by(rows, natural_key)
    if unique is not rows:
        rows = ordering.ordered(ordering.without_order(unique), natural_key)
    return ordering.without_order(ordering.row_index(rows, key))


def calendar_bounds(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    """One row with the first and the last day of the calendar."""
    return spark.range(1).select(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"))


def build_dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last`` of the one-row frame ``bounds``."""
    d = F.col("d")
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("d"))
    return enforce_schema(
        days.select(
            exprs.date_key(d).alias("date_key"), d.alias("full_date"),
            F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week"),
            F.dayofmonth(d).alias("day"), F.date_format(d, "EEEE").alias("day_of_week"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        ),
        schemas.DIM_DATE,
    )


def build_dim_project(projects: DataFrame) -> DataFrame:
    money = schemas.MONEY
    typed = projects.withColumns({
        "status": F.trim("status"),
        "start_date": exprs.as_date(projects, "start_date"),
        "end_date": exprs.as_date(projects, "end_date"),
        "budget": exprs.zero_if_null(exprs.as_decimal(projects, "budget", money), money),
        "actual_cost": exprs.zero_if_null(exprs.as_decimal(projects, "actual_cost", money), money),
    })
    # what follows from other columns is added when they have been sorted
    keyed = _keyed(typed, "project_key", "project_id")
    used = F.col("actual_cost").cast("double") / F.col("budget").cast("double") * 100
    utilisation = F.when(F.col("budget") > 0, used).otherwise(F.lit(0.0))
    derived = keyed.withColumns({
        "status_category": exprs.lookup(
            F.col("status"), {"In Progress": "Active", "Completed": "Closed"}, "Pending"
        ),
        "duration_days": F.datediff("end_date", "start_date"),
        "budget_variance": (F.col("actual_cost") - F.col("budget")).cast(money),
        "is_over_budget": F.col("actual_cost") > F.col("budget"),
        "budget_utilisation_pct": F.round(utilisation, 2).cast(schemas.PERCENT),
        "risk_level": exprs.risk_level(
            F.col("priority"), F.col("actual_cost") > F.col("budget"), utilisation
        ),
    })
    return enforce_schema(derived, schemas.DIM_PROJECT)


def employee_versions(history: DataFrame, employees: DataFrame, domain: str = DEFAULT_DOMAIN) -> DataFrame:
    """One row per salary change of a known employee and one for each current state."""
    people = dedup.keep_first(employees, ["employee_id"])
    experience = exprs.as_int(employees, "years_experience")
    first_day = exprs.as_date(history, "effective_date")
    changes = history.select(
        "employee_id",
        F.col("new_role").alias("role"), F.col("new_level").alias("level"),
        exprs.as_decimal(history, "new_salary", schemas.SALARY).alias("salary"),
        first_day.alias("valid_from"),
        F.coalesce("change_reason", F.lit("Historical Revision")).alias("change_reason"),
        F.col("history_id").alias("source_key"),
    )
    identity = people.select(
        "employee_id",
        F.coalesce("full_name", F.lit("Staff Member")).alias("full_name"),
        F.coalesce("email", F.lit(f"unknown@{domain}")).alias("email"),
        "department", "manager_id",
        F.coalesce("region", F.lit("Abu Dhabi")).alias("region"),
        exprs.zero_if_null(experience, "int").alias("years_experience"),
    )
    past = lookups.spread_join(changes, identity, ["employee_id"], "inner").withColumn(
        "is_current", F.lit(False)
    )
    latest = changes.groupBy("employee_id").agg(F.max("valid_from").alias("latest"))
    present = people.join(latest, "employee_id", "left").select(
        "employee_id", "full_name", "email", "department", "role", "level",
        exprs.as_decimal(employees, "salary", schemas.SALARY).alias("salary"),
        "manager_id", "region",
        F.abs(exprs.zero_if_null(experience, "int")).alias("years_experience"),
        F.coalesce(
            F.date_add("latest", 1), exprs.as_date(employees, "hire_date"), F.lit("2020-01-01").cast("date")
        ).alias("valid_from"),
        F.lit("Current Position").alias("change_reason"),
        F.lit(None).cast("string").alias("source_key"),
        F.lit(True).alias("is_current"),
    )
    return past.unionByName(present)


def build_dim_employee(
    history: DataFrame,
    employees: DataFrame,
    closed_by: str = "lead",
    domain: str = DEFAULT_DOMAIN,
) -> DataFrame:
    """Type 2 employee dimension with closed-open validity ``[valid_from, valid_to)``.

    ``closed_by="lead"`` ends a version where the next one of the employee starts.
    ``"end_date"`` trusts the end date of the history file and keeps changes of people who
    have left the employee file.
    """
    if closed_by == "end_date":
        versions = _versions_with_end(history, employees, domain)
        keyed = ordering.row_index(
            ordering.ordered(versions, "employee_id", "valid_from", "is_current", "salary", "source_key"),
            "employee_key",
        )
        return enforce_schema(ordering.without_order(keyed), schemas.DIM_EMPLOYEE)
    if closed_by != "lead":
        raise ValueError(f"closed_by must be 'lead' or 'end_date', not {closed_by!r}")
    # one exchange deals the versions by ranges of their order, for the number and for the next one alike
    stored = materialize(employee_versions(history, employees, domain), "versions", "zstd")
    # neighbours are of one employee: what they share comes first
    rows = ordering.with_range(stored, ["employee_id", "valid_from"], RANGE).select(
        RANGE, "employee_id", "full_name", "email", "department", "manager_id", "region", "years_experience", "is_current",
        "role", "level", "change_reason", "source_key", "salary", "valid_from",
    )
    start = F.struct("employee_id", "valid_from")
    sizes = rows.groupBy(RANGE).agg(F.count("*").alias("_size"), F.min(start).alias("_head"))
    # one row per range: the rows before it, and the first of the next range, where versions of its last employee may go on
    heads = sizes.select(RANGE, F.lead("_head").over(Window.orderBy(RANGE)).alias("_head"))
    ranges = materialize(ordering.starts_of(sizes, RANGE).join(heads, RANGE), "range-starts")
    order = ["valid_from", "is_current", "salary", "source_key"]
    following = F.lead(F.struct("valid_from")).over(Window.partitionBy(RANGE, "employee_id").orderBy(*order))
    next_head = F.when(F.col("_head.employee_id").eqNullSafe(F.col("employee_id")), F.col("_head.valid_from"))
    closed = rows.withColumns({
        "_place": F.row_number().over(Window.partitionBy(RANGE).orderBy("employee_id", *order)), "_following": following,
    }).join(F.broadcast(ranges), RANGE).withColumn(
        "next_from", F.when(F.col("_following").isNotNull(), F.col("_following.valid_from")).otherwise(next_head))
    return enforce_schema(
        closed.withColumns({
            "employee_key": F.col("_start") + F.col("_place"),
            "valid_to": F.coalesce("next_from", F.lit(temporal.END_OF_TIME).cast("date")),
            "is_current": F.col("next_from").isNull(),
        }),
        schemas.DIM_EMPLOYEE,
    )


def _versions_with_end(history: DataFrame, employees: DataFrame, domain: str) -> DataFrame:
    people = dedup.keep_first(employees, ["employee_id"])
    experience = exprs.as_int(employees, "years_experience")
    end_of_time = F.lit(temporal.END_OF_TIME).cast("date")
    # a change row may bring its own department and manager; the employee file fills the gap
    own = {name: name in history.columns for name in ("department", "manager_id")}
    changes = history.select(
        "employee_id", F.col("new_role").alias("role"), F.col("new_level").alias("level"),
        exprs.as_decimal(history, "new_salary", schemas.SALARY).alias("salary"),
        exprs.as_date(history, "effective_date").alias("valid_from"),
        F.coalesce(exprs.as_date(history, "end_date"), end_of_time).alias("valid_to"),
        F.coalesce("change_reason", F.lit("Historical Revision")).alias("change_reason"),
        F.col("history_id").alias("source_key"),
        *[F.col(name) for name, present in own.items() if present],
    )
    identity = people.select(
        "employee_id", "full_name", "email", "region",
        exprs.zero_if_null(experience, "int").alias("years_experience"),
        *[F.col(name) for name, present in own.items() if not present],
    )
    past = lookups.spread_join(changes, identity, ["employee_id"]).withColumns({
        "full_name": F.coalesce("full_name", F.lit("Staff Member")),
        "email": F.coalesce("email", F.lit(f"unknown@{domain}")),
        "region": F.coalesce("region", F.lit("Abu Dhabi")),
        "years_experience": exprs.zero_if_null(F.col("years_experience"), "int"),
        "is_current": F.lit(False),
    })
    latest = history.groupBy("employee_id").agg(F.max(exprs.as_date(history, "end_date")).alias("latest"))
    present = people.join(latest, "employee_id", "left").select(
        "employee_id", "full_name", "email", "department", "role", "level",
        exprs.as_decimal(employees, "salary", schemas.SALARY).alias("salary"),
        "manager_id", "region",
        F.abs(exprs.zero_if_null(experience, "int")).alias("years_experience"),
        F.coalesce(
            "latest", exprs.as_date(employees, "hire_date"), F.lit("2020-01-01").cast("date")
        ).alias("valid_from"),
        end_of_time.alias("valid_to"),
        F.lit("Current Position").alias("change_reason"),
        F.lit(None).cast("string").alias("source_key"),
        F.lit(True).alias("is_current"),
    )
    return past.unionByName(present)


def build_dim_vendor(transactions: DataFrame) -> DataFrame:
    """One row per vendor id; the alphabetically first of several names wins."""
    vendors = (
        transactions.where(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id").agg(F.min("vendor_name").alias("vendor_name"))
    )
    return enforce_schema(_keyed(vendors, "vendor_key", "vendor_id"), schemas.DIM_VENDOR)


def build_bridge(dim_project: DataFrame, dim_employee: DataFrame) -> DataFrame:
    current = lookups.current_versions(dim_employee).select("employee_id", "employee_key")
    pairs = dim_project.join(current, F.col("project_manager_id") == F.col("employee_id")).select(
        "project_key", "employee_key",
        F.lit("Project Manager").alias("role_in_project"), F.lit(100).alias("allocation_pct"),
    )
    keyed = _keyed(pairs, "bridge_key", "project_key")
    return enforce_schema(keyed, schemas.BRIDGE_EMPLOYEE_PROJECT)


def transaction_rows(
    transactions: DataFrame,
    dim_project: DataFrame,
    dim_employee: DataFrame,
    dim_vendor: DataFrame,
    dim_date: DataFrame,
    unknown_key: int = UNKNOWN_EMPLOYEE_KEY,
) -> tuple[DataFrame, DataFrame]:
    """Facts with their dimension keys, not yet numbered, dealt by ranges of their ids, and the (range, _size) of every range.

    Rows of an unknown project, vendor or day are left out; the approver is the version valid
    on the transaction day, or ``unknown_key``. Projects and approvers are asked for by range with narrow rows, so that the facts
    themselves move a single time. ``transactions`` must be stored, as they are read for each of these.
    """
    amount = exprs.zero_if_null(exprs.as_decimal(transactions, "amount", schemas.MONEY), schemas.MONEY)
    # the calendar is one row per day between two literal dates
    calendar = F.broadcast(dim_date.select("date_key", F.col("full_date").alias("day")))
    rows = (
        ordering.with_range(transactions, ["transaction_id"], RANGE)
        .withColumns({
            "day": exprs.as_date(transactions, "transaction_date"),
            "amount": amount,
            "currency": F.coalesce("currency", F.lit("AED")),
        })
        .join(calendar.select("day"), "day", "left_semi")
        .join(dim_vendor.select("vendor_id", "vendor_key"), "vendor_id")
        # neighbours are often of one project: what they share comes first and numbers last, which packs best where rows move
        .select(RANGE, "project_id", "invoice_ref", "approved_by", "currency", "transaction_id", "payment_status", "category", "vendor_key", "day", "amount")
    )
    asked = rows.where(F.col("project_id").isNotNull()).groupBy(RANGE, "project_id").agg(F.count("*").alias("_size"))
    projects = materialize(asked.join(dim_project.select("project_id", "project_key"), "project_id"), "range-projects", "zstd")
    approvers = temporal.point_in_time(rows, dim_employee, "approved_by", "day", "employee_id", "employee_key", [RANGE])
    joined = lookups.dealt_join(rows, RANGE, [
        (["project_id"], projects.drop("_size"), "inner"), (["approved_by", "day"], approvers, "left"),
    ]).join(calendar, "day")
    facts = joined.select(
        RANGE, "transaction_id", "amount", "currency", "category", "payment_status", "invoice_ref",
        exprs.blank_to_null(F.col("approved_by")).isNotNull().alias("is_approved"),
        F.coalesce("employee_key", F.lit(unknown_key).cast("bigint")).alias("employee_key"),
        "date_key", "project_key", "vendor_key", F.col("amount").alias("amount_aed"),
    )
    return facts, projects.groupBy(RANGE).agg(F.sum("_size").alias("_size"))


def build_fact_transactions(
    transactions: DataFrame,
    dim_project: DataFrame,
    dim_employee: DataFrame,
    dim_vendor: DataFrame,
    dim_date: DataFrame,
    unknown_key: int = UNKNOWN_EMPLOYEE_KEY,
    save: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The stored facts, numbered along their ids; the first row of a repeated id is kept.

    A row's number is its place in its range plus the rows of the ranges before. Only where ids really repeat, the numbers have
    gaps after the first pass, which a second one closes.
    """
    save = save or (lambda df: materialize(df, "fact-transactions", "zstd"))
    facts, sizes = transaction_rows(transactions, dim_project, dim_employee, dim_vendor, dim_date, unknown_key)
    sizes = materialize(sizes, "range-sizes")
    same_id = Window.partitionBy(RANGE, "transaction_id").orderBy(*dedup.tie_break(facts, [RANGE, "transaction_id"]))
    along = Window.partitionBy(RANGE).orderBy("transaction_id")
    numbered = (
        facts.withColumn("_row", F.row_number().over(same_id)).where("_row = 1")
        .withColumn("_place", F.row_number().over(along))
        # one row per range
        .join(F.broadcast(ordering.starts_of(sizes, RANGE)), RANGE)
        .withColumn("transaction_key", F.col("_start") + F.col("_place"))
    )
    with dealt_alike(transactions.sparkSession):
        table = save(enforce_schema(numbered, schemas.FACT_TRANSACTIONS))
    if table.count() == (sizes.agg(F.sum("_size")).first()[0] or 0):
        return table
    kept = materialize(table, "facts-kept", "zstd")
    rows = ordering.row_index(ordering.ordered(kept.drop("transaction_key"), "transaction_id"), "transaction_key")
    return save(enforce_schema(ordering.without_order(rows), schemas.FACT_TRANSACTIONS))


class Warehouse:
    """The six tables under ``path``, each written when it is first asked for.

    A table is rebuilt from scratch, and tables that depend on it read it back from storage.
    """

    def __init__(
        self,
        path: str,
        projects: DataFrame,
        employees: DataFrame,
        history: DataFrame,
        transactions: DataFrame,
        calendar: DataFrame | None = None,
        unknown_key: int = UNKNOWN_EMPLOYEE_KEY,
    ):
        self.path = path
        self.spark = projects.sparkSession
        self.projects, self.employees = projects, employees
        self.history, self.transactions = history, transactions
        self.calendar = calendar if calendar is not None else calendar_bounds(self.spark)
        self.unknown_key = unknown_key

    def _saved(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").options(**PACKED_TABLE).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(schemas.WAREHOUSE[name]).parquet(f"{self.path}/{name}")

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._saved("dim_date", build_dim_date(self.calendar))

    @cached_property
    def dim_project(self) -> DataFrame:
        return self._saved("dim_project", build_dim_project(self.projects))

    @cached_property
    def dim_employee(self) -> DataFrame:
        return self._saved("dim_employee", build_dim_employee(self.history, self.employees))

    @cached_property
    def dim_vendor(self) -> DataFrame:
        # read from the stored copy if the facts have made one
        transactions = self.__dict__.get("stored_transactions", self.transactions)
        return self._saved("dim_vendor", build_dim_vendor(transactions))

    @cached_property
    def stored_transactions(self) -> DataFrame:
        """The facts read them for the days of approvers, for their vendors and for themselves."""
        return materialize(self.transactions, "transactions", "zstd")

    @cached_property
    def bridge_employee_project(self) -> DataFrame:
        return self._saved("bridge_employee_project", build_bridge(self.dim_project, self.dim_employee))

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return build_fact_transactions(
            self.stored_transactions, self.dim_project, self.dim_employee, self.dim_vendor,
            self.dim_date, self.unknown_key, lambda df: self._saved("fact_transactions", df),
        )

    def build(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in schemas.WAREHOUSE}


def multiple_current(dim_employee: DataFrame) -> DataFrame:
    """Employees with more than one current version; none in a sound dimension."""
    return dedup.duplicate_keys(lookups.current_versions(dim_employee), ["employee_id"], "current_count")


def version_counts(dim_employee: DataFrame, k: int = 10) -> DataFrame:
    """The employees with the most versions."""
    return (
        dim_employee.groupBy("employee_id")
        .agg(
            F.count("*").alias("version_count"),
            F.min("valid_from").alias("first_start"), F.max("valid_to").alias("latest_end"),
        )
        .orderBy(F.desc("version_count"), "employee_id").limit(k)
    )


def version_overlaps(dim_employee: DataFrame) -> DataFrame:
    """Pairs of versions of one employee that overlap; none in a sound dimension."""
    return temporal.overlaps(dim_employee, "employee_id", "employee_key")
