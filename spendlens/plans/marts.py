"""Reporting tables behind the executive dashboard."""

from pyspark.sql import DataFrame, Window, functions as F

from spendlens.functions import exprs
from spendlens.plans import business


def kpi_cards(dim_project: DataFrame, fact: DataFrame) -> DataFrame:
    """One row of headline figures."""
    money = business.MONEY_SUM
    projects = dim_project.agg(
        business._total("budget").cast(money).alias("total_budget"),
        business._total("actual_cost").cast(money).alias("total_actual_spend"),
        F.count_if("is_over_budget").alias("over_budget_projects"),
        F.count("*").alias("project_count"),
        F.count_if(F.col("status_category") == "Active").alias("active_projects"),
    )
    amounts = fact.agg(
        F.count("*").alias("n"), business._total("amount_aed").cast(money).alias("amount"),
        F.sum(F.when(F.col("payment_status") == "Disputed", F.col("amount_aed"))).cast(money).alias("disputed"),
    )
    facts = amounts.select(F.struct("n", "amount", "disputed").alias("f")).scalar()
    budget, spend = F.col("total_budget").cast("double"), F.col("total_actual_spend").cast("double")
    return projects.withColumn("facts", facts).select(
        "total_budget", "total_actual_spend",
        (F.col("total_actual_spend") - F.col("total_budget")).cast(money).alias("budget_variance"),
        F.round(F.coalesce(exprs.share_pct(spend, budget), F.lit(0.0)), 2).alias("utilisation_pct"),
        "over_budget_projects",
        F.round(F.coalesce(
            exprs.share_pct(F.col("over_budget_projects").cast("double"), F.col("project_count")), F.lit(0.0)
        ), 2).alias("over_budget_pct"),
        F.col("facts.n").alias("transaction_count"),
        F.col("facts.amount").alias("transaction_amount"),
        "active_projects",
        F.coalesce("facts.disputed", F.lit(0)).cast(money).alias("disputed_amount"),
    )


def department_spend_vs_budget(dim_project: DataFrame, red_above: float = 90.0) -> DataFrame:
    """Every department with a red flag above the spend limit or over budget."""
    return business.department_spend(dim_project).withColumn(
        "red_flag", exprs.flag(F.col("spend_percentage") > red_above) | exprs.flag(F.col("over_budget"))
    )


def top_variance_projects(dim_project: DataFrame, n: int = 10) -> DataFrame:
    return (
        dim_project.orderBy(F.desc("budget_variance"), "project_id").limit(n)
        .select("project_id", "project_name", "department", "status", "budget", "actual_cost",
                "budget_variance", "risk_level")
    )


def top_vendors_and_other(fact: DataFrame, dim_vendor: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest vendors and one row for all others."""
    shares = business.vendor_shares(fact, dim_vendor).select("vendor_name", "total_spend", "transaction_count")
    top = shares.orderBy(F.desc("total_spend"), "vendor_name").limit(n).select(
        "vendor_name", F.col("vendor_name").alias("bucket")
    )
    # the broadcast side has n rows
    return (
        shares.join(F.broadcast(top), "vendor_name", "left")
        .groupBy(F.coalesce("bucket", F.lit("Other")).alias("vendor"))
        .agg(
            F.sum("total_spend").cast(business.MONEY_SUM).alias("total_spend"),
            F.sum("transaction_count").alias("transaction_count"),
        )
    )


def portfolio_running_total(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Spend per calendar day and up to that day, over all categories."""
    daily = (
        fact.groupBy("date_key").agg(business._total("amount_aed").alias("daily_spend"))
        .join(F.broadcast(dim_date.select("date_key", "full_date")), "date_key")
    )
    # at most one row per calendar day reaches the single window
    so_far = Window.orderBy("full_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "full_date", F.col("daily_spend").cast(business.MONEY_SUM).alias("daily_spend"),
        F.sum("daily_spend").over(so_far).cast(business.MONEY_SUM).alias("running_total_spend"),
    )


def slice_facts(
    fact: DataFrame, dim_project: DataFrame, dim_date: DataFrame,
    region: str | None = None, status_category: str | None = None, year: int | None = None,
) -> DataFrame:
    """Facts behind the dashboard slicers; an unset slicer keeps everything."""
    projects = dim_project
    if region is not None:
        projects = projects.where(F.col("region") == region)
    if status_category is not None:
        projects = projects.where(F.col("status_category") == status_category)
    if projects is not dim_project:
        fact = fact.join(projects.select("project_key"), "project_key", "left_semi")
    if year is not None:
        # the key starts with the year, so the filter reaches the scan
        fact = fact.where(F.col("date_key").between(year * 10000, year * 10000 + 9999))
    return fact
