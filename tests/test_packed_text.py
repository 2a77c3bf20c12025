"""Text that is written to be read again is packed, and lines are narrow before they are moved."""

import datetime
import os

from pyspark.sql import functions as F

from spendlens.plans import binding
from spendlens.sources import readers, writers


def files(path):
    return [name for name in os.listdir(path) if name.startswith("part-")]


def test_packed_text_is_read_back(spark, tmp_path):
    rows = [(str(i), None if i % 3 else 'a "b", c', f"  d{i} ") for i in range(50)]
    df = spark.createDataFrame(rows, "transaction_id string, vendor_name string, category string").coalesce(1)
    writers.write_json(df, f"{tmp_path}/json")
    writers.write_csv(df.toDF("project_id", "project_name", "region"), f"{tmp_path}/csv", packed=True)
    assert all(name.endswith(".gz") for path in ("json", "csv") for name in files(f"{tmp_path}/{path}"))
    found = readers.read_transactions(spark, f"{tmp_path}/json", one_object_per_line=True).select(*df.columns)
    assert sorted(map(tuple, found.collect())) == sorted(rows)
    found = readers.read_projects(spark, f"{tmp_path}/csv").select("project_id", "project_name", "region")
    assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_a_packed_file_has_bounded_rows(spark, tmp_path):
    most = int(writers.PACKED["maxRecordsPerFile"])
    writers.write_json(spark.range(2 * most + 1).coalesce(1), f"{tmp_path}/json")
    assert len(files(f"{tmp_path}/json")) == 3
    assert spark.read.json(f"{tmp_path}/json").count() == 2 * most + 1


def test_lines_are_narrow_before_the_joins_of_transactions(spark, tmp_path):
    day = datetime.datetime(2001, 2, 3)
    lines = [(1, 5, 7, 1, 10.005, 0.0, 0.0, "R", "F", day), (1, 5, 7, 7, 2.5, 0.01, 0.1, "A", "F", day), (1, 6, 7, 2, 3.0, 0.02, None, "N", "O", day),
             (2, 6, 8, 3, None, None, 0.1, None, "O", None), (2, 6, 8, 4, 4.0, 0.05, 0.1, "N", None, day), (3, 6, 8, 5, 4.0, 0.05, 0.1, "N", "F", day)]
    for name, rows, kind in (
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, "
                            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        ("orders", [(1, 11), (2, 12)], "o_orderkey long, o_custkey long"),
        ("supplier", [(7, "s7"), (8, "s8"), (8, "s8")], "s_suppkey long, s_name string"),
        ("part", [(5, "p5"), (6, "p6")], "p_partkey long, p_type string"),
    ):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    found = binding.transactions(spark, str(tmp_path))
    money = found.select("transaction_id", F.col("amount").cast("string"), "currency", "category", "payment_status", "approved_by", "vendor_name")
    assert sorted(map(tuple, money.collect())) == [
        ("1-1-5-7-2001-02-03", None, "AED", "p5", "Disputed", None, "s7"),
        ("1-2-6-7-2001-02-03", None, "AED", "p6", "Pending", "", "s7"),
        ("1-7-5-7-2001-02-03", "2.50", None, "p5", "Paid", "None", "s7"),
        *[("2-3-6-8", None, "AED", "p6", "Pending", "12", "s8")] * 2,
        *[("2-4-6-8-2001-02-03", "4.00", "AED", "p6", "Cancelled", "12", "s8")] * 2,
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("Join"):]
    assert "AS day" in moved and "AS approval" in moved  # taken below the joins
