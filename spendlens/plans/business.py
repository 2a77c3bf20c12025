"""Business questions over the warehouse tables.

Facts are summed per key before they meet a dimension, so a hot project, vendor or manager is
one row per task when it is shuffled.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from spendlens.functions import exprs
from spendlens.operators import lookups

MONEY_SUM = T.DecimalType(38, 2)
OPEN_STATUSES = ("Pending", "Disputed")


def _total(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(28,2)"))


def department_spend(dim_project: DataFrame) -> DataFrame:
    """Budget, cost, spend share and overrun flag of every department."""
    sums = dim_project.groupBy("department").agg(
        _total("budget").alias("total_budget"), _total("actual_cost").alias("total_actual_cost")
    )
    return sums.withColumns({
        "spend_percentage": F.round(exprs.share_pct(
            F.col("total_actual_cost").cast("double"), F.col("total_budget").cast("double")), 2),
        "over_budget": F.col("total_actual_cost") > F.col("total_budget"),
    })


def dept_budget_performance(dim_project: DataFrame, min_pct: float = 90.0) -> DataFrame:
    """Departments that spent more than ``min_pct`` percent of their budget, or overran it."""
    sums = department_spend(dim_project)
    exact = exprs.share_pct(F.col("total_actual_cost").cast("double"), F.col("total_budget").cast("double"))
    return sums.where((exact > min_pct) | F.col("over_budget")).orderBy(
        F.desc("spend_percentage"), "department"
    )


def manager_workload(
    dim_project: DataFrame, dim_employee: DataFrame, min_projects: int = 3, strict: bool = True
) -> DataFrame:
    """Managers with more than ``min_projects`` active projects (at least that many if not strict)."""
    active = (
        dim_project.where((F.col("status") == "In Progress") | (F.col("status_category") == "Active"))
        .groupBy("project_manager_id")
        .agg(F.count("*").alias("n"), _total("budget").alias("b"), _total("actual_cost").alias("c"))
    )
    current = lookups.current_versions(dim_employee).select("employee_id", "full_name", "email")
    count = F.col("active_project_count")
    return (
        active.join(current, F.col("project_manager_id") == F.col("employee_id"))
        .groupBy("full_name", "email")
        .agg(
            F.sum("n").alias("active_project_count"),
            F.sum("b").cast(MONEY_SUM).alias("combined_budget_responsibility"),
            F.sum("c").cast(MONEY_SUM).alias("combined_actual_spend"),
        )
        .where(count > min_projects if strict else count >= min_projects)
        .orderBy(F.desc("active_project_count"), F.desc("combined_budget_responsibility"), "full_name", "email")
    )


def vendor_shares(fact: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """Spend, transaction count, share of all spend and risk flag of every vendor."""
    by_key = fact.groupBy("vendor_key").agg(
        F.sum(F.coalesce("amount_aed", "amount", F.lit(0)).cast("decimal(28,2)")).alias("spend"),
        F.count("*").alias("n"),
    )
    # its own scan of one or two columns, summed to one row per task
    grand_total = fact.agg(
        F.coalesce(_total("amount"), _total("amount_aed"), F.lit(0)).cast("double").alias("t")
    ).scalar()
    named = (
        by_key.join(dim_vendor, "vendor_key").groupBy("vendor_name")
        .agg(F.sum("spend").cast(MONEY_SUM).alias("total_spend"), F.sum("n").alias("transaction_count"))
    )
    share = F.col("percentage_of_total_spend")
    return named.withColumn(
        "percentage_of_total_spend",
        F.round(exprs.share_pct(F.col("total_spend").cast("double"), grand_total), 2),
    ).withColumn(
        "risk_flag", F.when(share > 10, "HIGH").when(share >= 5, "MEDIUM").otherwise("NORMAL")
    )


def vendor_concentration(
    fact: DataFrame, dim_vendor: DataFrame, min_pct: float | None = 5.0, k: int | None = None
) -> DataFrame:
    """Vendors above ``min_pct`` percent of all spend, largest first; optionally only the top ``k``."""
    shares = vendor_shares(fact, dim_vendor)
    if min_pct is not None:
        shares = shares.where(F.col("percentage_of_total_spend") > min_pct)
    ranked = shares.orderBy(F.desc("percentage_of_total_spend"), "vendor_name")
    return ranked if k is None else ranked.limit(k)


def open_financial_issues(fact: DataFrame, dim_project: DataFrame, min_value: float = 50_000) -> DataFrame:
    """Projects whose pending and disputed transactions sum to more than ``min_value``."""
    open_items = (
        fact.where(F.col("payment_status").isin(*OPEN_STATUSES))
        .groupBy("project_key")
        .agg(F.count("*").alias("open_transaction_count"), _total("amount").alias("open_transaction_value"))
    )
    # a project id has one key, so the sums per key are final
    return (
        open_items.where(F.col("open_transaction_value") > min_value)
        .join(dim_project, "project_key")
        .select(
            "project_id", "project_name", "department", F.col("status").alias("project_status"),
            "open_transaction_count", "open_transaction_value",
        )
        .orderBy(F.desc("open_transaction_value"), "project_id")
    )


def daily_category_spend(fact: DataFrame) -> DataFrame:
    """Spend per day and category: the small base of all trend tables."""
    return fact.groupBy("date_key", "category").agg(_total("amount").alias("spend"))


def monthly_spend_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly spend per category with running total and change against the previous month."""
    month = exprs.year_month(F.col("full_date"))
    monthly = (
        daily_category_spend(fact)
        .join(F.broadcast(dim_date.select("date_key", month.alias("year_month"))), "date_key")
        .groupBy("year_month", "category").agg(F.sum("spend").cast("decimal(28,2)").alias("monthly_spend"))
    )
    # one row per month and category: a window never holds more rows than there are months
    by_month = Window.partitionBy("category").orderBy("year_month")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.lag("monthly_spend").over(by_month).cast("double")
    return (
        monthly.withColumns({
            "running_total": F.sum("monthly_spend").over(so_far).cast(MONEY_SUM),
            "previous": previous,
        })
        .select(
            "year_month", "category", "monthly_spend", "running_total",
            F.round(
                F.when(F.col("previous").isNull() | (F.col("previous") == 0), F.lit(0.0))
                .otherwise(100 * (F.col("monthly_spend").cast("double") - F.col("previous")) / F.col("previous")),
                2,
            ).alias("month_over_month_pct_change"),
        )
        .orderBy("category", "year_month")
    )


def salary_changes(dim_employee: DataFrame) -> DataFrame:
    """Each version next to the salary of the version before it, whatever gaps the keys have.

    An employee has at most one version per day, so a window over one employee's versions stays small.
    """
    before = Window.partitionBy("employee_id").orderBy("employee_key")
    return dim_employee.select(
        "employee_id", "full_name", "employee_key", F.col("valid_from").alias("change_date"),
        F.lag("salary").over(before).alias("previous_salary"), F.col("salary").alias("new_salary"),
    ).where(F.col("previous_salary").isNotNull())


def largest_salary_increases(dim_employee: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest single salary increases."""
    raised = salary_changes(dim_employee).where(F.col("new_salary") > F.col("previous_salary"))
    amount = F.col("new_salary") - F.col("previous_salary")
    share = exprs.share_pct(amount.cast("double"), F.col("previous_salary").cast("double"))
    return (
        raised.withColumns({"increase_amount": amount, "increase_pct": F.round(share, 2)})
        .orderBy(F.desc("increase_amount"), "employee_key").limit(k)
        .drop("employee_key")
    )


def _pending(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("payment_status") == "Pending")


def _above_average(fact: DataFrame) -> DataFrame:
    """Pending facts above the average pending amount; the average is a scalar subquery."""
    pending = _pending(fact)
    # the exact sum keeps the threshold the same however the rows are split over tasks
    average = pending.agg(
        (_total("amount").cast("double") / F.count("amount")).alias("a")
    ).scalar()
    return pending.where(F.col("amount").cast("double") > average)


def pending_above_average(fact: DataFrame, dim_project: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Pending transactions above their average, with project and current manager."""
    managers = lookups.current_versions(dim_employee).select("employee_id", "full_name")
    projects = dim_project.join(
        managers, F.col("project_manager_id") == F.col("employee_id")
    ).select("project_key", "project_name", "full_name")
    return _above_average(fact).select("project_key", "amount").join(projects, "project_key").select(
        "full_name", "project_name", "amount"
    )


def pending_above_average_naive(fact: DataFrame, dim_project: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """What a join without the current-version filter returns, as distinct rows with a count.

    Every version of a manager matches, so each row comes back ``row_count`` times. The versions
    are counted per manager first; the copies themselves are never built.
    """
    versions = dim_employee.groupBy("employee_id", "full_name").agg(F.count("*").alias("versions"))
    items = (
        _above_average(fact).groupBy("project_key", "amount").agg(F.count("*").alias("items"))
        .join(dim_project.select("project_key", "project_name", "project_manager_id"), "project_key")
    )
    return (
        items.join(versions, F.col("project_manager_id") == F.col("employee_id"))
        .groupBy("full_name", "project_name", "amount")
        .agg(F.sum(F.col("items") * F.col("versions")).alias("row_count"))
    )


def pending_detail(
    fact: DataFrame, dim_project: DataFrame, dim_employee: DataFrame, dim_date: DataFrame,
    closed: tuple[str, ...] = ("Completed", "On Hold"),
) -> DataFrame:
    """Above-average pending transactions of open projects with all descriptive columns."""
    managers = lookups.current_versions(dim_employee).select(
        "employee_id", "full_name", F.col("department").alias("manager_department"), "role"
    )
    projects = (
        dim_project.where(~F.col("status").isin(*closed))
        .join(managers, F.col("project_manager_id") == F.col("employee_id"))
        .select("project_key", "project_name", "status", "budget", "actual_cost",
                "full_name", "manager_department", "role")
    )
    days = F.broadcast(dim_date.select("date_key", F.col("full_date").alias("transaction_date")))
    return (
        _above_average(fact).select("project_key", "date_key", "amount_aed", "category", "payment_status")
        .join(days, "date_key").join(projects, "project_key")
        .select(
            "full_name", F.col("manager_department").alias("department"), "role", "project_name", "status",
            "budget", "actual_cost", F.col("amount_aed").alias("amount"), "category", "payment_status",
            "transaction_date",
        )
        .orderBy("department", F.desc("amount"))
    )
