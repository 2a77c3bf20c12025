"""Project cleaning and derived budget columns."""

from pyspark.sql import DataFrame, functions as F

from spendlens.functions import exprs


def transform_projects(
    df: DataFrame,
    title: bool = True,
    rounded: bool = False,
    null_status: str | None = "Nan",
) -> DataFrame:
    """Raw projects plus variance, overrun flag, duration, utilisation, category and risk.

    ``title`` normalises the status casing; ``rounded`` rounds the utilisation to two digits
    (half even) before the risk rule sees it. ``null_status`` labels a missing status.
    """
    status = F.trim("status")
    if title:
        status = exprs.title_case(status)
    if null_status is not None:
        status = F.coalesce(status, F.lit(null_status))
    utilisation = exprs.percentage(F.col("actual_cost"), F.col("budget"))
    if rounded:
        utilisation = F.bround(utilisation, 2)
    return (
        df.withColumns({
            "budget": exprs.zero_if_null(exprs.as_double(df, "budget")),
            "actual_cost": exprs.zero_if_null(exprs.as_double(df, "actual_cost")),
            "start_date": exprs.as_date(df, "start_date"),
            "end_date": exprs.as_date(df, "end_date"),
            "status": status,
        })
        .withColumns({
            "budget_variance": F.col("actual_cost") - F.col("budget"),
            "is_over_budget": F.col("actual_cost") > F.col("budget"),
            "duration_days": F.datediff("end_date", "start_date"),
            "budget_utilisation_pct": utilisation,
            "status_category": exprs.lookup(F.col("status"), exprs.STATUS_CATEGORY, "Pending"),
        })
        .withColumn(
            "risk_level",
            exprs.risk_level(F.col("priority"), F.col("is_over_budget"), F.col("budget_utilisation_pct")),
        )
    )
