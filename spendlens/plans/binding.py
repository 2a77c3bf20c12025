"""The test tables seen as the raw inputs of this engine (see FIXTURES.md, section 4)."""

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spendlens import session
from spendlens.functions import exprs
from spendlens.plans.warehouse import Warehouse

PRIORITY = {"1-URGENT": "Critical", "2-HIGH": "High", "3-MEDIUM": "Medium"}
SEGMENT_LEVEL = {
    "AUTOMOBILE": "Junior", "BUILDING": "Mid", "FURNITURE": "Senior", "HOUSEHOLD": "Lead",
}
PRIORITY_LEVEL = {
    "1-URGENT": "Director", "2-HIGH": "Lead", "3-MEDIUM": "Senior", "4-NOT SPECIFIED": "Mid",
}
CHANGE_TYPES = ("Hire", "Annual Raise", "Promotion", "Market Adjustment", "Role Change")
EVENT_TYPES = {
    "signup": "login", "view": "logout", "click": "task_completed",
    "error": "escalation_raised", "purchase": "escalation_resolved",
}


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # the schema is read from the files once per session
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(15,2)")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(cost).alias("cost"), F.max(F.to_date("l_shipdate")).alias("last_ship"))
    )
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    # names of places come last, so that no row carries them through the large joins
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("o_orderkey").alias("project_id"),
            F.concat(F.lit("Project "), _text("o_orderkey")).alias("project_name"),
            F.col("n_name").alias("department"),
            F.when(F.col("o_orderstatus") == "F", " Completed ")
            .when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 3 == 0), "in progress")
            .when(F.col("o_orderstatus") == "O", " In Progress")
            .otherwise("On Hold").alias("status"),
            F.to_date("o_orderdate").alias("start_date"),
            F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("end_date"),
            F.when(F.col("o_orderkey") % 97 != 0, _money("o_totalprice")).alias("budget"),
            F.round("cost", 2).cast("decimal(15,2)").alias("actual_cost"),
            _text("o_custkey").alias("project_manager_id"),
            exprs.lookup(F.col("o_orderpriority"), PRIORITY, "Low").alias("priority"),
            F.col("r_name").alias("region"),
        )
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    hired = F.date_add(F.lit("2005-01-01").cast("date"), (key % 5000).cast("int"))
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("c_custkey").alias("employee_id"),
            F.when(key % 3 == 0, "Ann Lee").when(key % 3 == 1, F.col("c_name"))
            .otherwise(F.concat(F.lit("Bob O'Neil "), F.col("n_name"))).alias("full_name"),
            F.when(key % 10 == 0, F.lit(None).cast("string"))
            .when(key % 10 == 5, "  ")
            .when(key == 3, "ann.lee@example.com")
            .when(key == 7, "Ann.Lee2@example.com")
            .otherwise(F.concat(F.lit("user"), _text("c_custkey"), F.lit("@example.com"))).alias("email"),
            F.col("n_name").alias("department"),
            F.col("n_name").alias("role"),
            exprs.lookup(F.col("c_mktsegment"), SEGMENT_LEVEL, "Director").alias("level"),
            F.when(key % 101 == 0, "not-a-date").when(key % 103 == 0, "1980-06-15")
            .otherwise(exprs.iso_date(hired)).alias("hire_date"),
            F.floor(20000 + 8 * F.abs("c_acctbal")).alias("salary"),
            (key % 50).cast("string").alias("manager_id"),
            F.col("n_name").alias("region"),
            F.lit("Active").alias("status"),
            F.floor(F.col("c_acctbal") / 300).cast("int").alias("years_experience"),
        )
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    kind = F.col("o_orderkey") % 5
    change = F
    for number, name in enumerate(CHANGE_TYPES):
        change = change.when(kind == number, name)
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("history_id"),
        _text("o_custkey").alias("employee_id"),
        F.to_date("o_orderdate").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(None).cast("decimal(12,2)").alias("previous_salary"),
        # tenths of the price, half up in whole cents
        (F.floor((cents + 5) / 10).cast("decimal(14,0)") / 100).cast("decimal(12,2)").alias("new_salary"),
        F.col("o_orderstatus").alias("new_role"),
        exprs.lookup(F.col("o_orderpriority"), PRIORITY_LEVEL, "Junior").alias("new_level"),
        change.alias("change_type"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("Reason "), (F.col("o_orderkey") % 4).cast("string")))
        .alias("change_reason"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    # what follows from a line alone is taken before the joins, in types of few bytes; other tables' texts come late
    status = F.when(flag == "R", 0).when(flag == "A", 1).when(line == "O", 2).otherwise(3)
    approval = (
        F.when(F.col("l_discount") == 0, 0).when(F.col("l_discount") == 0.01, 1).when(F.col("l_discount") == 0.02, 2).otherwise(3)
    )
    # status and whether there is a line number take the lower bits of one field with it
    number = F.col("l_linenumber").cast("int").cast("bigint")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", approval.alias("approval"),
        (F.coalesce(number, F.lit(0)) * 8 + F.when(number.isNull(), 4).otherwise(0) + status).alias("line"),
        F.to_date("l_shipdate").alias("day"), "l_suppkey", F.when(F.col("l_tax") != 0, _money("l_extendedprice")).alias("amount"), "l_partkey",
    )
    line, approval = F.col("line"), F.col("approval")
    status = line.bitwiseAND(F.lit(3))
    number = F.when(line.bitwiseAND(F.lit(4)) == 0, F.shiftright(line, 3))
    # orders last of the large ones: lines of an order come side by side, which keeps every later copy of them smaller
    return (
        lines
        .join(table(spark, sf_dir, "part").select("p_partkey", "p_type"),
              F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
              F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
              F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws(
                "-", _text("l_orderkey"), number.cast("string"), _text("l_partkey"),
                _text("l_suppkey"), exprs.iso_date(F.col("day")),
            ).alias("transaction_id"),
            _text("l_orderkey").alias("project_id"),
            _text("l_suppkey").alias("vendor_id"),
            F.col("s_name").alias("vendor_name"),
            "amount",
            F.when(number != 7, "AED").alias("currency"),
            F.col("p_type").alias("category"),
            F.when(status == 0, "Disputed").when(status == 1, "Paid").when(status == 2, "Pending")
            .otherwise("Cancelled").alias("payment_status"),
            F.col("day").alias("transaction_date"),
            F.concat(F.lit("INV-"), _text("l_orderkey")).alias("invoice_ref"),
            F.when(approval == 0, F.lit(None).cast("string"))
            .when(approval == 1, "None")
            .when(approval == 2, "")
            .otherwise(_text("o_custkey")).alias("approved_by"),
        )
    )


def bind_events(raw: DataFrame) -> DataFrame:
    """Works on a batch and on a streaming read of the events table alike."""
    k = F.get_json_object("props", "$.k").cast("int")
    event_type = exprs.lookup(F.col("event_type"), EVENT_TYPES, "other")
    severity = (
        F.when(k % 4 == 0, "Low").when(k % 4 == 1, "Medium").when(k % 4 == 2, "High").otherwise("Critical")
    )
    payload = F.create_map(
        F.lit("severity"), severity,
        F.lit("resolved_by"), F.when(k % 2 == 0, F.concat(F.lit("lead"), k.cast("string"))),
        F.lit("resolution"), F.concat(F.lit("case "), k.cast("string")),
    )
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        raw.withColumn("_shift", F.explode(copies))
        .select(
            _text("event_id").alias("event_id"),
            event_type.alias("event_type"),
            F.when(event_type != "login", (F.col("user_id") % 20).cast("string")).alias("project_id"),
            _text("user_id").alias("user_id"),
            (F.col("ts").cast("timestamp") + F.make_dt_interval(hours=F.col("_shift"))).alias("timestamp"),
            F.when(k % 11 != 0, payload).alias("payload"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_events(table(spark, sf_dir, "events"))


def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last day of the years the transactions span, as one row."""
    day = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").agg(
        F.trunc(F.min(day), "year").alias("first"),
        F.last_day(F.add_months(F.trunc(F.max(day), "year"), 11)).alias("last"),
    )


@cache
def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star schema over the test tables; each table is built once per session."""
    return Warehouse(
        session.fresh_path(spark, "warehouse"),
        projects(spark, sf_dir), employees(spark, sf_dir), history(spark, sf_dir),
        transactions(spark, sf_dir), calendar_bounds(spark, sf_dir),
    )
