import datetime as dt

import pytest
from pyspark.sql import functions as F
from spendlens import schemas
from spendlens.plans import events, versions, warehouse
from spendlens.sources import readers
from spendlens.streaming import committed


def test_readers_see_whole_batches_only(spark, tmp_path):
    tables = committed.CommittedTables(spark, str(tmp_path))
    assert tables.latest("t") is None and tables.all_batches("t") is None and tables.batches() == []
    assert tables.commit(0, {"t": spark.range(3), "u": spark.range(1)})
    # what a lost driver wrote without a record
    spark.range(100).write.parquet(tables.folder("t", 1))
    assert tables.latest("t").count() == 3 and tables.all_batches("t").count() == 3
    assert tables.commit(1, {"t": spark.range(5), "u": spark.range(2)})
    assert tables.latest("t").count() == 5 and tables.all_batches("t").count() == 8 and tables.all_batches("u").count() == 3
    assert not tables.commit(1, {"t": spark.range(50)})
    assert tables.latest("t").count() == 5 and tables.batches() == [0, 1]


def test_copies_in_any_order(spark, tmp_path):
    rows = [("a", 5, "late"), ("a", 1, "early"), ("a", 3, "middle"), ("b", 1, "x"), ("b", 1, "w"), ("b", 1, "x"), ("c", None, "undated"), ("c", 0, "z"), (None, 1, "no id")]
    frame = spark.createDataFrame([(i, "login", None, "u", dt.datetime(2024, 1, 1, h) if h is not None else None, {"severity": s}) for i, h, s in rows],
                                  "event_id string, event_type string, project_id string, user_id string, timestamp timestamp, payload map<string,string>")
    expected = sorted((r.event_id, r.payload["severity"]) for r in events.validate_events(frame).collect())
    order = [0, 5, 7, 2, 3, 8, 1, 6, 4]
    for name, some in (("forward", order), ("back", order[::-1])):
        for i in some:
            frame.where(F.lit(True)).collect()
            one = spark.createDataFrame([frame.collect()[i]], frame.schema)
            one.coalesce(1).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{tmp_path}/{name}/in")
        stream = readers.stream_jsonl(spark, f"{tmp_path}/{name}/in", schemas.EVENTS, max_files_per_trigger=3)
        committed.start_corrected(stream, f"{tmp_path}/{name}/out", f"{tmp_path}/{name}/c").awaitTermination()
        found = committed.corrected(spark, f"{tmp_path}/{name}/out").collect()
        assert sorted((r.event_id, r.payload["severity"]) for r in found) == expected


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("E1", "Ann", "a@x", "IT", "dev", "Mid", "100.5", "M", "R", "3", "2019-01-01"), ("E2", None, None, "HR", "hr", "Lead", "50", None, None, None, None)],
        "employee_id string, full_name string, email string, department string, role string, level string, salary string, manager_id string,"
        " region string, years_experience string, hire_date string")


def test_deltas_equal_a_rebuild(spark, tmp_path, people):
    history = spark.createDataFrame(
        [("H1", "E1", "2020-01-01", "10", "dev", "Junior", None), ("H2", "E1", "2021-01-01", "20", "dev", "Mid", "raise"),
         ("H3", "E2", "2020-06-01", "30", "hr", "Mid", "hire"), ("H4", "E9", "2020-06-01", "30", "hr", "Mid", "unknown person")],
        "history_id string, employee_id string, effective_date string, new_salary string, new_role string, new_level string, change_reason string")
    store = versions.VersionStore(spark, f"{tmp_path}/dim", buckets=3)
    content = [c for c in schemas.DIM_EMPLOYEE.names if c != "employee_key"]

    def rows(frame):
        return sorted(map(str, frame.select(content).collect()))

    store.apply(history.where("history_id IN ('H2', 'H3', 'H4')"), people.where("employee_id = 'E1'"))
    assert rows(store.dimension()) == rows(warehouse.build_dim_employee(history.where("history_id = 'H2'"), people.where("employee_id = 'E1'")))
    before = {tuple(r[:3]): r.employee_key for r in store.keys().collect()}
    store.apply(history.where("history_id = 'H1'"), people.where("employee_id = 'E2'"))
    rebuilt = rows(warehouse.build_dim_employee(history, people))
    assert rows(store.dimension()) == rebuilt
    after = {tuple(r[:3]): r.employee_key for r in store.keys().collect()}
    assert {k: after[k] for k in before} == before and len(set(after.values())) == len(after) == 5
    for again in ("H1", "H3"):
        store.apply(history.where(F.col("history_id") == again), people)
        assert rows(store.dimension()) == rebuilt and {tuple(r[:3]): r.employee_key for r in store.keys().collect()} == after
    store.apply(history.limit(0), people.limit(0))
    assert rows(store.dimension()) == rebuilt


def test_ids_share_a_state(spark, tmp_path):
    """Many ids to a state: as many calls as states, not as ids, and the same rows; states are given up id by id."""
    rows = spark.range(600).select(
        (F.col("id") % 200).cast("string").alias("event_id"), F.lit("login").alias("event_type"), F.lit(None).cast("string").alias("project_id"),
        F.lit("u").alias("user_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 37 % 100).alias("timestamp"),
        F.create_map(F.lit("severity"), F.col("id").cast("string")).alias("payload"))
    expected = sorted((r.event_id, r.payload["severity"]) for r in events.validate_events(rows).collect())
    for part in range(3):
        rows.where(F.floor(F.col("payload")["severity"].cast("int") / 200) == part).coalesce(1).write.mode("append").option(
            "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{tmp_path}/in")
    stream = readers.stream_jsonl(spark, f"{tmp_path}/in", schemas.EVENTS, max_files_per_trigger=1)
    for name, keep in (("kept", committed.KEEP_MS), ("given_up", 0)):
        sent = committed.earliest_copies(stream, keep, buckets=3)
        tables = committed.CommittedTables(spark, f"{tmp_path}/{name}/out")
        sent.writeStream.foreachBatch(lambda frame, n: tables.commit(n, {"events": frame}) and None).option(
            "checkpointLocation", f"{tmp_path}/{name}/c").trigger(availableNow=True).start().awaitTermination()
        found = committed.corrected(spark, f"{tmp_path}/{name}/out").collect()
        assert sorted((r.event_id, r.payload["severity"]) for r in found) == expected
