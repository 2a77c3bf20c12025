"""Complete runs: the event tables and the extract - gate - clean - verify - report chain."""

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from spendlens import session
from spendlens.operators import stats
from spendlens.plans import employees, events, projects, quality, transactions
from spendlens.sources import readers, writers

METRICS_SCHEMA = "run_id string, dataset string, stage string, metric string, value double"


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Row count as a by-product of the write, without a second pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def metrics_frame(spark: SparkSession, run_id: str, metrics: list[tuple[str, str, str, float]]) -> DataFrame:
    return spark.createDataFrame([(run_id, *m[:3], float(m[3])) for m in metrics], METRICS_SCHEMA)


# result table, builder, partition columns, whether it is a small table kept in one file
EVENT_TABLES: list[tuple[str, Callable[[DataFrame], DataFrame], tuple[str, ...], bool]] = [
    ("project_activity_summary", events.project_activity_summary, (), False),
    ("user_activity_summary", events.user_activity_summary, (), False),
    ("escalation_log", events.escalation_log, ("severity",), False),
    ("daily_event_volume", events.daily_event_volume, ("event_date",), False),
    ("peak_usage_analysis", events.peak_usage_analysis, (), True),
]


def run_events(spark: SparkSession, events_path: str, out_dir: str, run_id: str = "events") -> DataFrame:
    """Clean the events once, write the five tables, return rows and seconds per table.

    The cleaned events are a written table rather than a cache: five readers share it and a
    lost executor costs nothing. Each time covers the execution of its write.
    """
    started = time.perf_counter()
    counted, seen = _counted(events.validate_events(readers.read_events(spark, events_path)))
    clean = session.materialize(counted, "clean-events")
    total = seen.get["rows"]
    metrics = []
    for name, build, partition_cols, small in EVENT_TABLES:
        begin = time.perf_counter()
        result, rows = _counted(build(clean))
        writers.write_parquet(result, f"{out_dir}/{name}", partition_cols, single_file=small)
        metrics += [
            (name, "write", "rows", rows.get["rows"]),
            (name, "write", "seconds", time.perf_counter() - begin),
        ]
    elapsed = time.perf_counter() - started
    metrics += [
        ("events", "run", "rows", total),
        ("events", "run", "seconds", elapsed),
        ("events", "run", "rows_per_second", total / elapsed if elapsed else 0.0),
    ]
    return metrics_frame(spark, run_id, metrics)


def run_etl(
    spark: SparkSession,
    projects_path: str,
    employees_path: str,
    transactions_path: str,
    out_dir: str,
    run_id: str,
    as_of: str | None = None,
    domain: str = employees.DEFAULT_DOMAIN,
    one_object_per_line: bool = False,
) -> DataFrame:
    """Read the raw files, stop at a violated gate, write and verify the three clean sets, report."""
    # the text inputs are parsed once; gate, counts and cleaning read the columnar copy
    raw = {
        "projects": session.materialize(readers.read_projects(spark, projects_path), "raw-projects", "zstd"),
        "employees": session.materialize(readers.read_employees(spark, employees_path), "raw-employees", "zstd"),
        "transactions": session.materialize(
            readers.read_transactions(spark, transactions_path, one_object_per_line), "raw-transactions", "zstd"
        ),
    }
    quality.assert_gate(raw["projects"], raw["employees"], raw["transactions"])
    started = time.perf_counter()
    clean_projects = projects.transform_projects(raw["projects"], title=False, rounded=True)
    clean_employees = employees.clean_employees(raw["employees"], domain, as_of)
    clean = {
        "projects": clean_projects,
        "employees": clean_employees,
        "transactions": transactions.enrich_transactions(raw["transactions"], clean_projects, clean_employees, stored=True),
    }
    metrics = []
    raw_rows = {name: df.count() for name, df in raw.items()}
    for name, df in clean.items():
        counted, rows = _counted(df)
        path = f"{out_dir}/{name}_clean"
        with session.dealt_alike(spark):
            writers.write_csv(counted, path, packed=True)
        writers.verify_output(spark, path, "csv")
        metrics += [
            (name, "extract", "rows", raw_rows[name]),
            (name, "load", "rows", rows.get["rows"]),
        ]
    metrics += [
        ("all", "gate", "passed", 1),
        ("all", "run", "seconds", time.perf_counter() - started),
    ]
    frame = metrics_frame(spark, run_id, metrics)
    issues = issue_report_lines(
        employees.employee_issues(raw["employees"], as_of), raw_rows["projects"], raw_rows["employees"]
    )
    writers.write_lines(spark, [*report_lines(frame), *issues, *written_lines(out_dir, raw_rows)], f"{out_dir}/report_{run_id}")
    return frame


def written_lines(out_dir: str, datasets: Iterable[str]) -> list[str]:
    """Where a run has put its tables."""
    return ["Files written:", *[f"  - {out_dir}/{name}_clean" for name in sorted(datasets)]]


def report_lines(metrics: DataFrame) -> list[str]:
    """Text report of a run; the metrics are a handful of rows."""
    values = {(m.dataset, m.stage, m.metric): m.value for m in metrics.collect()}
    run_id = metrics.first().run_id
    lines = [f"Run report: {run_id}"]
    gate = values.get(("all", "gate", "passed"))
    if gate is not None:
        lines.append(f"Data quality gate: {'PASSED' if gate else 'FAILED'}")
    for dataset in sorted({key[0] for key in values}):
        before, after = values.get((dataset, "extract", "rows")), values.get((dataset, "load", "rows"))
        if before is not None and after is not None:
            lines.append(f"{dataset}: {before:.0f} raw rows, {after:.0f} clean rows, delta {after - before:+.0f}")
    seconds = values.get(("all", "run", "seconds"))
    if seconds is not None:
        lines.append(f"Elapsed: {seconds:.2f} s")
    return lines


def issue_report_lines(issues: DataFrame, projects_count: int, employees_count: int) -> list[str]:
    """Text report of the employee repairs (seven rows)."""
    return [
        f"Projects processed: {projects_count}",
        f"Employees processed: {employees_count}",
        *[f"  - {row.issue}: {row.row_count} rows fixed" for row in issues.collect()],
    ]


def quality_report(tables: dict[str, DataFrame], out_dir: str) -> DataFrame:
    """Run every suite, write one Markdown report per dataset, return the summary."""
    spark = next(iter(tables.values())).sparkSession
    results = session.materialize(quality.run_all(tables), "dq-results")
    for dataset in tables:
        lines = quality.markdown_lines(results.where(F.col("dataset") == dataset))
        writers.write_lines(spark, lines, f"{out_dir}/dq_report_{dataset}")
    return quality.summary(results)


def profile(df: DataFrame, group: str, value: str, categories: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Shape, types, null counts, value counts and a grouped description of ``value``."""
    spark = df.sparkSession
    return {
        "shape": df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns))),
        "types": spark.createDataFrame(df.dtypes, "column_name string, data_type string"),
        "nulls": stats.null_counts(df),
        **{f"values:{name}": stats.value_counts(df, name) for name in categories},
        "describe": stats.describe_by(df, [group], value),
    }
