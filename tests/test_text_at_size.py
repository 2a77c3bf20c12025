import json
import re

import __spark_entry__ as entry
from pyspark.sql import functions as F
from spendlens.sources import readers, writers


def test_arrays_of_bounded_size(spark, tmp_path):
    """No task gathers all objects of a part into one value."""
    rows = spark.range(2500).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("a } \" ] b").alias("category"), F.lit(None).cast("string").alias("currency"))
    writers.write_json_arrays(rows.coalesce(2), f"{tmp_path}/a", size=400)
    found = [text for row in spark.read.text(f"{tmp_path}/a", wholetext=True).collect()
             for text in re.findall(r"(?ms)^\[ .*?^\]$", row.value)]
    arrays = [json.loads(text) for text in found]
    assert max(map(len, arrays)) <= 400 and sum(map(len, arrays)) == 2500 and len(arrays) >= 7
    back = readers.read_transactions(spark, f"{tmp_path}/a")
    assert sorted(back.select("transaction_id", "category", "currency").collect()) == sorted(rows.collect())


def test_arrays_of_no_rows(spark, tmp_path):
    writers.write_json_arrays(spark.range(0).select(F.col("id").cast("string").alias("transaction_id")), f"{tmp_path}/a")
    assert readers.read_transactions(spark, f"{tmp_path}/a").isEmpty()


def test_number_of_ranges_is_bounded(spark, tmp_path, monkeypatch):
    """Ranges of a fixed size would grow in number with the text."""
    spark.range(20_000).select(F.lit("x" * 40).alias("value")).write.text(f"{tmp_path}/t")
    monkeypatch.setattr(entry, "RANGES", 8, raising=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with entry._small_ranges(spark, f"{tmp_path}/t", 1024):
        assert spark.read.text(f"{tmp_path}/t").select(F.count_distinct("_metadata.file_path", "_metadata.file_block_start")).first()[0] <= 8 + 8
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    with entry._small_ranges(spark, f"{tmp_path}/t", 1 << 20):
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 1 << 20
