
from __future__ import annotations

import datetime
import sys
import time
import zipfile
from collections.abc import Callable
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import ORACLES
from spendlens import schemas
from spendlens.functions import exprs
from spendlens.operators import dedup, lookups, stats, temporal
from spendlens.plans import (
    binding, business, employees, events, governance, marts, projects, quality, runs, transactions, versions, warehouse,
)
from spendlens.session import fresh_path, materialize
from spendlens.sources import readers, writers
from spendlens.streaming import committed, event_stream

AS_OF = "2024-01-01"
RETENTION_AS_OF = "2006-01-01"
RANGES = 128  # of a text that small byte ranges would cut into more, while they stay below LARGEST_RANGE
LARGEST_RANGE = 128 << 20
EVENTS_PER_FILE = 100_000  # at least, where a batch of played-back events is several files

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Types that compare alike in every engine: text for times, double for decimals, bigint."""
    def column(field: T.StructField):
        name, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            name = name.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            name = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DecimalType):
            name = name.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            name = name.cast("bigint")
        return name.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


# ---- inputs ------------------------------------------------------------------------------

def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "projects": binding.projects(spark, d),
        "employees": binding.employees(spark, d),
        "transactions": binding.transactions(spark, d),
        "employees_salary_history": binding.history(spark, d),
    }


def _clean_events(spark: SparkSession, d: str) -> DataFrame:
    return events.validate_events(binding.events(spark, d))


def _star(query: Callable[[warehouse.Warehouse], DataFrame]) -> Query:
    return lambda spark, d: query(binding.warehouse(spark, d))


def _on_events(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: query(_clean_events(spark, d))


def _without_payload(query: Callable[[DataFrame], DataFrame]) -> Query:
    """Copies that differ in their payload alone are equal without it, so reports that need none leave it out before the cleaning."""
    return lambda spark, d: query(events.validate_events(binding.events(spark, d).drop("payload")))


# ---- cleaning ----------------------------------------------------------------------------

def _projects_clean(spark: SparkSession, d: str) -> DataFrame:
    return projects.transform_projects(binding.projects(spark, d))


def _project_risk_counts(spark: SparkSession, d: str) -> DataFrame:
    rounded = projects.transform_projects(binding.projects(spark, d), title=False, rounded=True)
    return lookups.counts_by(rounded, ["risk_level", "status_category"], "project_count")


def _employees_clean(spark: SparkSession, d: str) -> DataFrame:
    return employees.clean_employees(binding.employees(spark, d), as_of=AS_OF, keep_flags=True)


def _employee_emails(spark: SparkSession, d: str) -> DataFrame:
    people = binding.employees(spark, d)
    filled = employees.fill_emails(people.withColumn("was_missing", exprs.is_blank(F.col("email"))))
    return filled.where("was_missing").select("employee_id", "full_name", "email")


def _transactions_enriched(spark: SparkSession, d: str) -> DataFrame:
    return transactions.enrich_transactions(
        binding.transactions(spark, d), binding.projects(spark, d), binding.employees(spark, d)
    )


# ---- warehouse ---------------------------------------------------------------------------

def _fact_asof_employee(spark: SparkSession, d: str) -> DataFrame:
    """Version of the approver on the transaction day, for every transaction."""
    return temporal.temporal_left_join(
        binding.transactions(spark, d).select("transaction_id", "approved_by", "transaction_date"),
        binding.warehouse(spark, d).dim_employee,
        "approved_by", "transaction_date", "employee_id", "employee_key",
    )


def _fact_asof_merge(spark: SparkSession, d: str) -> DataFrame:
    """The same versions, found by sorting days and versions together."""
    # read twice: for its days, and to take the versions
    rows = materialize(binding.transactions(spark, d).select("transaction_id", "approved_by", "transaction_date"), "probes")
    found = temporal.as_of(rows, binding.warehouse(spark, d).dim_employee, "approved_by", "transaction_date", "employee_id", "employee_key")
    return lookups.spread_join(rows, found, ["approved_by", "transaction_date"])


def _scd2_end_date(spark: SparkSession, d: str) -> DataFrame:
    """Versions closed by the file's own end date: here 30 days after each change."""
    history = binding.history(spark, d).withColumn("end_date", F.date_add("effective_date", 30))
    return warehouse.build_dim_employee(history, binding.employees(spark, d), closed_by="end_date")


def _scd2_overlaps_found(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps of changes that all claim to last 30 days."""
    changes = binding.history(spark, d).select(
        "employee_id", F.col("history_id").cast("bigint").alias("employee_key"),
        F.col("effective_date").alias("valid_from"), F.date_add("effective_date", 30).alias("valid_to"),
    )
    return temporal.overlaps(changes, "employee_id", "employee_key")


def _scd2_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The dimension from three deltas, changes in any order, people known late, and one delta applied twice."""
    store = versions.VersionStore(spark, fresh_path(spark, "versions"), buckets=8)
    history, people = materialize(binding.history(spark, d), "history"), materialize(binding.employees(spark, d), "employees")
    part, late = F.col("history_id").cast("bigint") % 3, F.col("employee_id").cast("bigint") % 2 == 0
    store.apply(history.where(part == 2), people.where(~late))
    first = materialize(store.keys().withColumnRenamed("employee_key", "first_key"), "first-keys")
    store.apply(history.where(part == 0), people.where(late))
    for _ in range(2):
        store.apply(history.where(part == 1), people.limit(0))
    same = [F.col(f"k.{name}").eqNullSafe(F.col(f"f.{name}")) for name in ("employee_id", "present", "source_key")]
    kept = store.keys().alias("k").join(first.alias("f"), same[0] & same[1] & same[2], "left").select(
        "employee_key", (F.col("first_key").isNull() | (F.col("first_key") == F.col("employee_key"))).alias("key_kept"))
    return store.dimension().join(kept, "employee_key").drop("employee_key")


# ---- sources and sinks -------------------------------------------------------------------

def _csv_projects(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    writers.write_csv(binding.projects(spark, d), path)
    writers.verify_output(spark, path, "csv")
    return readers.read_projects(spark, path)


def _csv_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Files with columns in another order, and without one of them, are read by name."""
    path = fresh_path(spark, "csv-layouts")
    rows = binding.projects(spark, d)
    even = F.col("project_id").cast("bigint") % 2 == 0
    writers.write_csv(rows.where(even), f"{path}/a")
    writers.write_csv(rows.where(~even).select(*[c for c in reversed(rows.columns) if c != "region"]), f"{path}/b")
    return readers.read_projects(spark, f"{path}/*")


def _csv_line_breaks(spark: SparkSession, d: str) -> DataFrame:
    """Names with line breaks, quotes and commas in files of three layouts, read in ranges of 32 KB or more."""
    path = fresh_path(spark, "csv-breaks")
    name = F.concat(F.col("project_name"), F.when(F.col("project_id").cast("bigint") % 3 == 0, F.lit('\nsaid "so",\r\n\n')).otherwise(F.lit("")))
    rows = materialize(binding.projects(spark, d).withColumn("project_name", name), "projects")
    kind = F.col("project_id").cast("bigint") % 4
    layouts = [rows.columns, [*reversed(rows.columns)], [c for c in rows.columns if c != "region"]]
    for i, columns in enumerate(layouts):
        writers.write_csv(rows.where(kind == i if i else kind.isin(0, 3)).select(*columns), f"{path}/{i}")
    with _small_ranges(spark, f"{path}/*", 32 * 1024):
        return materialize(readers.read_projects(spark, f"{path}/*"), "csv-breaks")


def _json_array(spark: SparkSession, d: str) -> DataFrame:
    """Transactions as indented arrays, several to a file, read in ranges of 256 KB or more."""
    path = fresh_path(spark, "json-array")
    rows = binding.transactions(spark, d)
    writers.write_json_arrays(rows, path)
    with _small_ranges(spark, path, 256 * 1024):
        raw = materialize(readers.read_transactions(spark, path), "json-array")
    return raw.withColumn("amount", exprs.as_double(raw, "amount"))


@contextmanager
def _small_ranges(spark: SparkSession, path: str, size: int):
    """Byte ranges that cut even small files, while a read is planned and run; a larger input is cut into some ``RANGES``."""
    key = "spark.sql.files.maxPartitionBytes"
    # lengths come from the listing, no content is read
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    size = max(size, min(total // RANGES, LARGEST_RANGE))
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _json_transactions(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "json")
    writers.write_json(binding.transactions(spark, d), path)
    raw = readers.read_transactions(spark, path, one_object_per_line=True)
    return raw.withColumn("amount", exprs.as_double(raw, "amount"))


def _jsonl_events(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "jsonl")
    writers.write_json(binding.events(spark, d), path)
    return lookups.counts_by(readers.read_events(spark, f"{path}/*.json.gz"), ["event_type"], "event_count")


def _partitioned_escalations(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "escalations")
    writers.write_parquet(events.escalation_log(_clean_events(spark, d)), path, ["severity"])
    # only the two partitions are listed and read
    log = spark.read.parquet(path).where(F.col("severity").isin("High", "Critical"))
    return log.groupBy("severity").agg(
        F.count("*").alias("raised"), F.count_if("resolved").alias("resolved")
    )


def _insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    known = binding.history(spark, d).select("employee_id").distinct().withColumn("seen_in", F.lit("history"))
    new = binding.employees(spark, d).select("employee_id", F.lit("employees").alias("seen_in"))
    return dedup.insert_if_absent(known, new, ["employee_id"])


def _table_contract(spark: SparkSession, d: str) -> DataFrame:
    """Transactions under the fact contract's types and defaults."""
    contract = T.StructType([
        f for f in schemas.FACT_TRANSACTIONS.fields
        if f.name in ("transaction_id", "amount", "currency", "category", "payment_status", "is_approved")
    ])
    defaults = {"amount": 0, "currency": "AED", "is_approved": False}
    return writers.enforce_schema(binding.transactions(spark, d), contract, defaults)


def _contract_violations(spark: SparkSession, d: str) -> DataFrame:
    """Projects against a contract that asks for budgets and for unique ids and departments."""
    contract = T.StructType([T.StructField(name, T.StringType(), name == "region") for name in ("project_id", "budget", "region")])
    return writers.contract_violations(binding.projects(spark, d), contract, ["project_id", "department"])


def _table_digest(spark: SparkSession, d: str) -> DataFrame:
    """Clean events written and read back whole; a copy that lacks one file of them is found out."""
    path = fresh_path(spark, "digest")
    rows = _clean_events(spark, d).repartition(4, "event_id")
    written = writers.write_verified(rows, path)
    whole = spark.read.schema(rows.schema).parquet(path)
    missing_one = spark.read.schema(rows.schema).parquet(*sorted(whole.inputFiles())[1:])
    try:
        writers.check_digest(missing_one, written, path)
        found_out = False
    except ValueError:
        found_out = True
    return whole.agg(F.count("*").alias("row_count")).withColumn("truncation_found", F.lit(found_out))


def _first_events(spark: SparkSession, d: str) -> DataFrame:
    return readers.first_events(_clean_events(spark, d), 1000).select("event_id", "event_type", "timestamp")


# ---- profiling and quality ---------------------------------------------------------------

def _null_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        stats.null_counts(df).withColumn("dataset", F.lit(name)) for name, df in _tables(spark, d).items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def _stored_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The bound tables as files, as raw inputs are: every key rule reads its columns again."""
    return {name: materialize(df, name) for name, df in _tables(spark, d).items()}


def _suite(dataset: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        parents = {parent for parent, _ in quality.RULES[dataset].get("foreign_keys", {}).values()}
        tables = {name: materialize(df, name) for name, df in _tables(spark, d).items() if name in {dataset, *parents}}
        return _verdicts(quality.run_suite(dataset, tables[dataset], quality.RULES[dataset], tables))
    return run


def _verdicts(results: DataFrame) -> DataFrame:
    return results.select("check", "dataset", "passed", "failed_rows", "metric_value", "expected")


EXTENDED_RULES = {
    "column_completeness": {"amount": 90.0, "approved_by": 95.0},
    "dominant_values": {"payment_status": 30.0, "category": 30.0},
    "freshness": {"transaction_date": {"as_of": AS_OF, "max_days": 30}},
    "outliers": {"amount": 3.0},
    "not_future": {"transaction_date": "2001-06-30"},
    "consistency_rules": [{"type": "custom_sql", "name": "paid_has_amount",
                           "expression": "payment_status <> 'Paid' OR amount IS NOT NULL"}],
}


def _dq_extended(spark: SparkSession, d: str) -> DataFrame:
    people = {
        "salary_for_level": [{"level": "level", "salary": "salary",
                              "bounds": {"Junior": (0, 50_000), "Director": (30_000, 250_000)}}],
    }
    # every rule on keys or medians reads its columns again
    on_transactions = quality.run_suite("transactions", materialize(binding.transactions(spark, d), "transactions"), EXTENDED_RULES)
    on_employees = quality.run_suite("employees", materialize(binding.employees(spark, d), "employees"), people)
    return _verdicts(on_transactions.unionByName(on_employees))


def _dq_missing_columns(spark: SparkSession, d: str) -> DataFrame:
    """Every check on a column that is not there, in the table or in the parent, fails for all rows."""
    gone = ["amount", "payment_status", "transaction_date"]
    rules = quality.RULES["transactions"] | {k: v for k, v in EXTENDED_RULES.items() if k != "consistency_rules"}
    context = {"projects": binding.projects(spark, d).drop("project_id"), "employees": binding.employees(spark, d)}
    found = quality.run_suite("transactions", binding.transactions(spark, d).drop(*gone), rules, context)
    return found.where(F.col("details").contains("missing from")).select("check", "passed", "failed_rows")


def _dq_summary(spark: SparkSession, d: str) -> DataFrame:
    return quality.summary(quality.run_all(_stored_tables(spark, d)))


def _gate(spark: SparkSession, d: str) -> DataFrame:
    tables = _tables(spark, d)
    return quality.gate_violations(tables["projects"], tables["employees"], tables["transactions"])


def _project_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Projects that no transaction refers to."""
    return lookups.orphan_keys(
        binding.projects(spark, d), "project_id", binding.transactions(spark, d), "project_id", lookups.FILTER_BITS
    )


def _duplicate_lines(spark: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_keys(binding.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _salary_describe(spark: SparkSession, d: str) -> DataFrame:
    described = stats.describe_by(binding.employees(spark, d), ["level"], "salary")
    return described.withColumn("mean", F.round("mean", 4))


# ---- streaming ---------------------------------------------------------------------------

def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = binding.table(spark, d, "events").schema
    # a pattern, so that the table may be one file or a folder
    raw = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    stream = binding.bind_events(raw)
    return stream.withColumn("produced_at", F.col("timestamp"))


def _stream_event_counts(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "stream-counts")
    event_stream.start_counts(_event_stream(spark, d), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


def _stream_critical(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "stream-critical")
    rows = event_stream.critical_escalations(_event_stream(spark, d)).drop("payload", "produced_at")
    event_stream.start_file_sink(rows, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


def _stream_summary(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "stream-summary")
    event_stream.start_summary(
        _event_stream(spark, d), "platform-events", f"{path}/out", f"{path}/checkpoint"
    ).awaitTermination()
    schema = (
        "topic string, total_messages_consumed bigint, critical_escalations_forwarded bigint,"
        " throughput_messages_per_second double, event_counts map<string,bigint>"
    )
    summary = spark.read.schema(schema).json(f"{path}/out")
    counts = F.explode("event_counts").alias("event_type", "event_count")
    return summary.select(
        "topic", "total_messages_consumed", "critical_escalations_forwarded",
        F.col("throughput_messages_per_second").alias("messages_per_second"), counts,
    )


def _stream_clean_events(spark: SparkSession, d: str) -> DataFrame:
    """Files of JSON lines played back one per batch, the latest events first and redelivered ones last."""
    path = fresh_path(spark, "stream-clean")
    rows = binding.events(spark, d)
    first = dedup.keep_first(rows, ["event_id"], ["timestamp"])
    again = rows.join(first.select("event_id", "timestamp"), ["event_id", "timestamp"], "left_anti")
    late = F.coalesce(F.month("timestamp") > 6, F.lit(False))
    for part in (first.where(late), first.where(~late), again):
        part.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{path}/in")
    stream = readers.stream_jsonl(spark, f"{path}/in", schemas.EVENTS, max_files_per_trigger=1)
    cleaned = event_stream.clean_stream(stream).withColumn("severity", F.col("payload")["severity"]).drop("payload")
    event_stream.start_file_sink(cleaned, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


def _played_back(spark: SparkSession, d: str, path: str) -> DataFrame:
    """The events as four batches of JSON lines, whose earlier-dated copies come first, last and in between.

    A batch is one file; of large inputs it is as many files as its smallest part fills, so that many tasks write it.
    """
    # copies are an hour apart
    part = F.coalesce((F.hour("timestamp") + F.minute("timestamp")) % 4, F.lit(0))
    rows = materialize(binding.events(spark, d).withColumn("_part", part), "played-back")
    sizes = {row["_part"]: row["count"] for row in rows.groupBy("_part").count().collect()}
    files = max(1, min(sizes.get(i, 0) for i in range(4)) // EVENTS_PER_FILE)
    for i in range(4):
        chosen = rows.where(F.col("_part") == i).drop("_part")
        chosen = chosen.repartition(files) if files > 1 else chosen.coalesce(1)
        chosen.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{path}/in")
    return readers.stream_jsonl(spark, f"{path}/in", schemas.EVENTS, max_files_per_trigger=files)


def _stream_corrected(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned by state and corrections, in whatever order copies come, with a restart after all is read."""
    path = fresh_path(spark, "stream-corrected")
    stream = _played_back(spark, d, path)
    for _ in range(2):
        committed.start_corrected(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return committed.corrected(spark, f"{path}/out").drop("payload")


def _stream_router(spark: SparkSession, d: str) -> DataFrame:
    """Counts and critical escalations of one commit per batch, as a reader finds them."""
    path = fresh_path(spark, "stream-router")
    stream = _played_back(spark, d, path).withColumn("produced_at", F.col("timestamp"))
    committed.start_router(stream, f"{path}/out", f"{path}/checkpoint", "platform-events").awaitTermination()
    tables = committed.CommittedTables(spark, f"{path}/out")
    sent = tables.all_batches("critical").groupBy("event_type").agg(F.count("*").alias("forwarded"))
    total = tables.latest("summary").select("total_messages_consumed")
    return tables.latest("counts").join(sent, "event_type", "left").join(F.broadcast(total))


def _stream_progress(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each batch of a query that fails while it writes its third batch and is started again."""
    path = fresh_path(spark, "stream-progress")
    stream = _played_back(spark, d, path)
    progress = committed.ProgressTable(spark, f"{path}/progress")
    spark.streams.addListener(progress)
    tables = committed.CommittedTables(spark, f"{path}/out")
    fail = [True]

    def save(rows: DataFrame, batch_id: int) -> None:
        if batch_id == 2 and fail.pop():
            rows.limit(10).write.mode("overwrite").parquet(tables.folder("events", batch_id))
            raise RuntimeError("lost before the commit")
        tables.commit(batch_id, {"events": rows})

    try:
        for attempt in range(2):
            query = stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            except StreamingQueryException:
                if attempt:
                    raise
                fail.append(False)
        # reports arrive after the batches they are about
        deadline = time.monotonic() + 60
        while len(progress.folder.names()) < 4 and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(progress)
    written = tables.all_batches("events")
    folder = F.regexp_extract(F.input_file_name(), r"batch-(\d+)", 1).cast("bigint")
    kept = written.groupBy(folder.alias("batch_id")).agg(F.count("*").alias("committed_rows"))
    return progress.read().select("batch_id", F.col("rows").alias("reported_rows")).join(kept, "batch_id").drop("batch_id")


# ---- governance and runs -----------------------------------------------------------------

def _retention_split(spark: SparkSession, d: str) -> DataFrame:
    column, years = governance.RETENTION_YEARS["transactions"]
    tagged = governance.retention(binding.transactions(spark, d), column, years, RETENTION_AS_OF)
    return tagged.groupBy("retention_state").agg(
        F.count("*").alias("row_count"), F.min(column).alias("oldest"), F.max(column).alias("newest")
    )


def _event_retention(spark: SparkSession, d: str) -> DataFrame:
    """Events by state: kept a year, archived for two more, then expired."""
    as_of = binding.events(spark, d).agg(F.min("timestamp").alias("t")).first().t + datetime.timedelta(days=380)
    tagged = governance.event_retention(binding.events(spark, d), as_of.date().isoformat())
    return tagged.groupBy("retention_state").agg(F.count("*").alias("row_count"))


def _project_retention(spark: SparkSession, d: str) -> DataFrame:
    column, years = governance.RETENTION_YEARS["projects"]
    kept, expired = governance.retention_split(binding.projects(spark, d), column, years, RETENTION_AS_OF)
    counted = [part.agg(F.count("*").alias("row_count"), F.count(column).alias("dated")).withColumn("part", F.lit(name))
               for name, part in (("kept", kept), ("expired", expired))]
    return counted[0].unionByName(counted[1])


def _catalog_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Classification of every column the tables have, with its missing cells."""
    return governance.catalog(spark).join(_null_counts(spark, d), ["dataset", "column_name"])


def _produced_events(spark: SparkSession, d: str) -> DataFrame:
    """Every event handed on carries the time of it."""
    return event_stream.stamp_produced(binding.events(spark, d)).groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.count("produced_at").alias("stamped"))


def _persona(dataset: str, persona: str) -> Query:
    return lambda spark, d: governance.persona_view(_tables(spark, d)[dataset], dataset, persona)


def _project_manager(spark: SparkSession, d: str) -> DataFrame:
    """Transactions of one project manager's own projects, as that persona sees them."""
    tables = _tables(spark, d)
    seen = governance.persona_view(
        tables["transactions"], "transactions", "project_manager", person="1", projects=tables["projects"])
    return seen.select("transaction_id", "project_id", "payment_status")


def _perturbed_check(spark: SparkSession, d: str) -> DataFrame:
    """Synthetic ids stay distinct and salaries within the limit."""
    people = binding.employees(spark, d).withColumn("old", F.col("salary").cast("double"))
    moved = governance.perturb_salaries(people)
    return moved.agg(
        F.count("*").alias("row_count"), F.count_distinct("employee_id").alias("distinct_ids"),
        F.count_if(F.abs(F.col("salary") - F.col("old")) <= F.abs(F.col("old")) * 0.1 + 0.01).alias("within_limit"))


def _employment_retention(spark: SparkSession, d: str) -> DataFrame:
    """Salary records by state, every third person taken to have left."""
    people, history = binding.employees(spark, d), binding.history(spark, d)
    left = F.when(F.col("employee_id").cast("bigint") % 3 == 0, "Terminated").otherwise("Active")
    dated = governance.with_employment_end(history, people.withColumn("status", left), history)
    column, years = governance.RETENTION_YEARS["employees_salary_history"]
    return governance.retention(dated, column, years, "2009-01-01").groupBy("retention_state").agg(F.count("*").alias("row_count"))


def _own_transactions(spark: SparkSession, d: str) -> DataFrame:
    """What each project manager's own projects spend, by payment status."""
    mine = binding.projects(spark, d).select("project_id", "project_manager_id")
    per_project = (
        binding.transactions(spark, d).groupBy("project_id", "payment_status")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("a"))
    )
    return (
        per_project.join(mine, "project_id").groupBy("project_manager_id", "payment_status")
        .agg(F.sum("n").alias("transaction_count"), F.sum("a").cast("decimal(28,2)").alias("amount"))
    )


def _events_run(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "events-run")
    writers.write_json(binding.events(spark, d), f"{path}/raw")
    metrics = runs.run_events(spark, f"{path}/raw/*.json.gz", f"{path}/out")
    return metrics.where("metric = 'rows'").select("dataset", F.col("value").cast("bigint").alias("row_count"))


def _etl_run(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "etl-run")
    writers.write_csv(binding.projects(spark, d), f"{path}/projects", packed=True)
    writers.write_csv(binding.employees(spark, d), f"{path}/employees", packed=True)
    writers.write_json(binding.transactions(spark, d), f"{path}/transactions")
    metrics = runs.run_etl(
        spark, f"{path}/projects", f"{path}/employees", f"{path}/transactions", f"{path}/out",
        "run", AS_OF, one_object_per_line=True,
    )
    return metrics.where("metric = 'rows'").select("dataset", "stage", F.col("value").cast("bigint").alias("row_count"))


_QUERIES: dict[str, Query] = {
    # cleaning
    "projects_clean": _projects_clean,
    "project_risk_counts": _project_risk_counts,
    "employees_clean": _employees_clean,
    "employee_issue_counts": lambda spark, d: employees.employee_issues(binding.employees(spark, d), AS_OF),
    "employee_emails": _employee_emails,
    "transactions_enriched": _transactions_enriched,
    # warehouse
    "dim_date": _star(lambda w: w.dim_date),
    "dim_project": _star(lambda w: w.dim_project),
    "dim_vendor": _star(lambda w: w.dim_vendor),
    "dim_employee_scd2": _star(lambda w: w.dim_employee),
    "dim_employee_end_date": _scd2_end_date,
    "bridge_employee_project": _star(lambda w: w.bridge_employee_project),
    "fact_transactions": _star(lambda w: w.fact_transactions),
    "fact_asof_employee": _fact_asof_employee,
    "fact_asof_merge": _fact_asof_merge,
    "scd2_incremental": _scd2_incremental,
    "scd2_multi_current": _star(lambda w: warehouse.multiple_current(w.dim_employee)),
    "scd2_version_counts": _star(lambda w: warehouse.version_counts(w.dim_employee)),
    "scd2_overlaps": _star(lambda w: warehouse.version_overlaps(w.dim_employee)),
    "scd2_overlaps_found": _scd2_overlaps_found,
    # business questions
    "q1_dept_budget": _star(lambda w: business.dept_budget_performance(w.dim_project, 80.0)),
    "q2_manager_workload": _star(lambda w: business.manager_workload(w.dim_project, w.dim_employee)),
    "q3_vendor_concentration": _star(
        lambda w: business.vendor_concentration(w.fact_transactions, w.dim_vendor, 1.0)),
    "q3_vendor_top10": _star(
        lambda w: business.vendor_concentration(w.fact_transactions, w.dim_vendor, None, 10)),
    "q4_open_issues": _star(lambda w: business.open_financial_issues(w.fact_transactions, w.dim_project)),
    "q5_monthly_spend": _star(lambda w: business.monthly_spend_trend(w.fact_transactions, w.dim_date)),
    "q6_salary_increases": _star(lambda w: business.largest_salary_increases(w.dim_employee)),
    "salary_changes": _star(lambda w: business.salary_changes(w.dim_employee)),
    "salary_changes_gapped": _star(lambda w: business.salary_changes(w.dim_employee.where("employee_key % 3 <> 1"))),
    "pending_naive": _star(lambda w: business.pending_above_average_naive(
        w.fact_transactions, w.dim_project, w.dim_employee)),
    "pending_above_avg": _star(lambda w: business.pending_above_average(
        w.fact_transactions, w.dim_project, w.dim_employee)),
    "pending_detail": _star(lambda w: business.pending_detail(
        w.fact_transactions, w.dim_project, w.dim_employee, w.dim_date)),
    # events
    "events_clean": _without_payload(lambda clean: clean),
    "project_activity": _without_payload(events.project_activity_summary),
    "user_activity": _without_payload(events.user_activity_summary),
    "escalation_log": _on_events(events.escalation_log),
    "daily_volume": _without_payload(events.daily_event_volume),
    "peak_usage": _without_payload(events.peak_usage_analysis),
    # streaming
    "stream_event_counts": _stream_event_counts,
    "stream_critical": _stream_critical,
    "stream_summary": _stream_summary,
    "stream_clean_events": _stream_clean_events,
    "stream_corrected": _stream_corrected,
    "stream_router": _stream_router,
    "stream_progress": _stream_progress,
    # quality and profiling
    "dq_projects": _suite("projects"),
    "dq_employees": _suite("employees"),
    "dq_transactions": _suite("transactions"),
    "dq_history": _suite("employees_salary_history"),
    "dq_extended": _dq_extended,
    "dq_summary": _dq_summary,
    "dq_gate": _gate,
    "dq_missing_columns": _dq_missing_columns,
    "fk_orphans": _project_orphans,
    "duplicate_keys": _duplicate_lines,
    "null_counts": _null_counts,
    "value_counts": lambda spark, d: stats.value_counts(binding.transactions(spark, d), "approved_by"),
    "salary_describe": _salary_describe,
    # sources and sinks
    "insert_if_absent": _insert_if_absent,
    "table_contract": _table_contract,
    "contract_violations": _contract_violations,
    "csv_projects": _csv_projects,
    "csv_layouts": _csv_layouts,
    "csv_line_breaks": _csv_line_breaks,
    "table_digest": _table_digest,
    "json_array": _json_array,
    "json_transactions": _json_transactions,
    "jsonl_events": _jsonl_events,
    "partitioned_escalations": _partitioned_escalations,
    "first_events": _first_events,
    # reporting marts
    "kpi": _star(lambda w: marts.kpi_cards(w.dim_project, w.fact_transactions)),
    "dept_spend": _star(lambda w: marts.department_spend_vs_budget(w.dim_project)),
    "top_variance": _star(lambda w: marts.top_variance_projects(w.dim_project)),
    "vendor_top5_other": _star(lambda w: marts.top_vendors_and_other(w.fact_transactions, w.dim_vendor)),
    "running_total": _star(lambda w: marts.portfolio_running_total(w.fact_transactions, w.dim_date)),
    "sliced_kpi": _star(lambda w: marts.kpi_cards(
        w.dim_project.where((F.col("region") == "ASIA") & (F.col("status_category") == "Active")),
        marts.slice_facts(w.fact_transactions, w.dim_project, w.dim_date, "ASIA", "Active", 1997))),
    # governance
    "masked_employees": lambda spark, d: governance.mask_employees(binding.employees(spark, d)),
    "perturbed_salaries": lambda spark, d: governance.perturb_salaries(binding.employees(spark, d)),
    "retention_split": _retention_split,
    "event_retention": _event_retention,
    "project_retention": _project_retention,
    "catalog_nulls": _catalog_nulls,
    "produced_events": _produced_events,
    "persona_view": _persona("employees", "bi_analyst"),
    "persona_engineer": _persona("employees", "data_engineer"),
    "persona_aggregated": _persona("transactions", "bi_analyst"),
    "persona_own_projects": _own_transactions,
    "persona_project_manager": _project_manager,
    "perturbed_salary_check": _perturbed_check,
    "employment_retention": _employment_retention,
    # complete runs
    "events_run": _events_run,
    "etl_run": _etl_run,
}


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators and their pipeline, where these are installed."""
    try:
        import corpus_pipeline
        from spendlens.llm import queries as operators
    except ImportError:
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    found = {**operators.QUERIES, "pipeline": corpus_pipeline.run}
    return {name: _importable(query) for name, query in found.items()}, {**operators.ORACLES, **sql}


@cache
def _ship(context: SparkContext) -> None:
    """Send the package to the Python workers of this application, on whichever nodes they run."""
    here = Path(__file__).resolve().parent
    # the driver serves it from the folder of its context, which goes with the application
    archive = Path(context._temp_dir) / "spendlens_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((here / "spendlens").rglob("*.py")):
            out.write(file, file.relative_to(here))
    context.addPyFile(str(archive))


def _importable(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _ship(spark.sparkContext)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    """One entry per implemented query or operator; each takes (spark, sf_dir)."""
    def plain(query: Query) -> Query:
        return lambda spark, sf_dir: _plain(query(spark, sf_dir))

    return {name: _importable(plain(query)) for name, query in _QUERIES.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the test tables, where SQL can express them."""
    return ORACLES | _training_data()[1]


def entry(spark: SparkSession) -> DataFrame:
    """Department budgets against cost, from the cleaned projects of the smallest test set."""
    return queries()["q1_dept_budget"](spark, "/root/testdata/sf0.001")
