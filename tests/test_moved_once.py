from pyspark.sql import functions as F
from spendlens import session
from spendlens.operators import dedup
from spendlens.plans import warehouse


def test_facts_read_their_transactions_once(spark, tmp_path):
    """The transactions are the result of joins: facts, vendors and approver days share one stored copy."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw = spark.createDataFrame(
        [(f"T{i}", f"P{i % 2}", f"V{i % 3}", "v", "5.5", None, "c", "Paid", "2024-01-02", "I", "E1") for i in range(10)],
        "transaction_id string, project_id string, vendor_id string, vendor_name string, amount string, currency string, category string,"
        " payment_status string, transaction_date string, invoice_ref string, approved_by string")
    projects = spark.createDataFrame(
        [(f"P{i}", "n", "d", "Completed", None, None, "10", "5", "E1", "Low", "r") for i in range(2)],
        "project_id string, project_name string, department string, status string, start_date string, end_date string, budget string,"
        " actual_cost string, project_manager_id string, priority string, region string")
    people = spark.createDataFrame(
        [("E1", "Ann", "a@x", "IT", "dev", "Mid", "100.5", "M", "R", "3", "2019-01-01")],
        "employee_id string, full_name string, email string, department string, role string, level string, salary string, manager_id string,"
        " region string, years_experience string, hire_date string")
    history = spark.createDataFrame([], "history_id string, employee_id string, effective_date string, new_salary string, new_role string,"
                                        " new_level string, change_reason string")
    star = warehouse.Warehouse(str(tmp_path), projects, people, history, raw.mapInArrow(count, raw.schema))
    assert star.fact_transactions.count() == 10 and star.dim_vendor.count() == 3
    assert read.value == 10
    assert star.fact_transactions.where("amount = amount_aed AND amount = 5.5").count() == 10


def test_repeated_and_null_keys(spark):
    """Equal hashes lead to the exact comparison."""
    once = session.materialize(spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")), "once")
    assert dedup.unique_by(once, "k") is once
    for extra in (["7"], [None, None]):
        rows = session.materialize(once.unionByName(spark.createDataFrame([(x, 1) for x in extra], "k string, v int")), "twice")
        assert dedup.unique_by(rows, "k").count() == (50 if extra == ["7"] else 51)
