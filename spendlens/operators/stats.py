"""Profiling aggregates and exact medians."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spendlens.operators import ordering
from spendlens.session import materialize


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return unpivot_counts(counted, "column_name", "null_count")


def unpivot_counts(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """A one-row frame of counts as (name, value) rows."""
    return one_row.unpivot([], [F.col(c).cast("bigint").alias(c) for c in one_row.columns], name, value)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Number of rows per value, null included, most frequent first."""
    return (
        df.groupBy(column).agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc_nulls_last(column))
    )


def _same(left: str, right: str, groups: Sequence[str]) -> Column:
    condition = F.lit(True)
    for group in groups:
        condition &= F.col(f"{left}.{group}").eqNullSafe(F.col(f"{right}.{group}"))
    return condition


def exact_median(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Median per group as ``median`` (double), exact for any number of distinct values.

    Values are counted per group before anything else, and the counts ranked by a distributed running count.
    """
    if not groups:
        return exact_median(df.withColumn("_all", F.lit(0)), value, ["_all"]).drop("_all")
    groups = list(groups)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    )
    ranked = ordering.cumulate(counts, groups, ["_v"], F.col("_n"), "_upto")
    totals = materialize(ranked.groupBy(*groups).agg(F.max("_upto").alias("_total")), "totals")
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor(F.col("_total") / 2) + 1
    return (
        ranked.alias("r").join(totals.alias("t"), _same("r", "t", groups))
        .groupBy(*[F.col(f"t.{group}").alias(group) for group in groups])
        .agg(
            (
                (F.min(F.when(F.col("_upto") >= low, F.col("_v")))
                 + F.min(F.when(F.col("_upto") >= high, F.col("_v")))).cast("double") / 2
            ).alias("median")
        )
    )


def describe_by(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """count, mean, min, median and max of ``value`` per group."""
    groups = list(groups)
    summary = df.groupBy(*groups).agg(
        F.count(value).alias("value_count"), F.avg(value).alias("mean"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    medians = exact_median(df, value, groups)
    return summary.alias("s").join(medians.alias("m"), _same("s", "m", groups), "left").select(
        *[F.col(f"s.{group}").alias(group) for group in groups],
        "value_count", "mean", "min", "median", "max",
    )


def median_day(df: DataFrame, column: str) -> DataFrame:
    """Median of a date column as one row; a midpoint falls back to the earlier day.

    The aggregation buffer holds one counter per distinct day, so the built-in is bounded.
    """
    middle = F.median(F.unix_date(F.col(column)))
    return df.agg(F.date_from_unix_date(F.floor(middle).cast("int")).alias("median_day"))
