import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from spendlens import schemas
from spendlens.plans import events, runs
from spendlens.sources import readers, writers
from spendlens.streaming import event_stream


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour, minutes=minute)


ROWS = [
    ("e1", "escalation_raised", "p1", "u1", at(1), {"severity": "Critical"}),
    ("e1", "escalation_raised", "p1", "u1", at(5), {"severity": "Critical"}),
    ("e2", "escalation_raised", "p1", "u2", at(2), {}),
    ("e3", "escalation_raised", "p1", "u2", at(3), None),
    ("e4", "escalation_resolved", "p1", "u3", at(0, 30), {"resolved_by": "boss", "resolution": "done"}),
    ("e5", "escalation_resolved", "p1", "u3", at(4), None),
    ("e6", "escalation_raised", None, "u4", at(1), {"severity": "Low"}),
    ("e7", "escalation_resolved", None, "u4", at(2), None),
    ("e8", "escalation_resolved", "p2", "u4", at(2), None),
    ("e9", "login", None, "u1", at(26), None),
    ("e9", "login", None, "u1", at(26), None),
    (None, "login", None, "u1", at(1), None),
    ("e10", "logout", None, None, at(1), None),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, schemas.EVENTS).repartition(3)


@pytest.fixture(scope="module")
def clean(raw):
    return events.validate_events(raw)


def test_cleaning_keeps_the_earliest_copy(clean):
    rows = {r.event_id: r for r in clean.collect()}
    assert len(rows) == 9 and clean.count() == 9
    assert rows["e1"].timestamp == at(1) and rows["e9"].event_hour == 2 and rows["e9"].event_month == "2024-01"


def test_escalations_pair_in_order(clean):
    rows = {r.event_id: r for r in events.escalation_log(clean).collect()}
    assert sorted(rows) == ["e1", "e2", "e3", "e6"]
    # the first resolution lies before the first escalation
    assert (rows["e1"].resolved_by, rows["e1"].resolution, rows["e1"].resolution_time_hours) == ("boss", "done", -0.5)
    assert (rows["e2"].resolved_by, rows["e2"].resolution_time_hours, rows["e2"].severity) == ("u3", 2.0, "Medium")
    assert not rows["e3"].resolved and rows["e3"].resolution_time_hours is None
    assert not rows["e6"].resolved and rows["e6"].severity == "Low"


def test_summaries(clean):
    project = {r.project_id: r for r in events.project_activity_summary(clean).collect()}
    assert set(project) == {"p1", "p2"}
    assert (project["p1"].total_events, project["p1"].unique_users, project["p1"].unique_event_types) == (5, 3, 2)
    user = {r.user_id: r for r in events.user_activity_summary(clean).collect()}
    assert (user["u1"].login_count, user["u1"].actions_taken, user["u1"].active_days) == (1, 1, 2)
    assert user["u4"].projects_touched == 1
    daily = events.daily_event_volume(clean).where("event_type = 'login'").first()
    assert (daily.event_count, daily.cumulative_count) == (1, 1)
    peak = events.peak_usage_analysis(clean, 2).collect()
    assert [(r.event_hour, r.total_events) for r in peak] == [(2, 3), (1, 2)]


def test_pre_aggregation_shuffles_counts_not_events(spark):
    raw = spark.createDataFrame(ROWS, schemas.EVENTS)
    for query in (events.project_activity_summary, events.user_activity_summary, events.peak_usage_analysis):
        plan = query(events.with_time_parts(raw))._jdf.queryExecution().executedPlan().toString()
        first_exchange = plan.rindex("Exchange")
        assert "HashAggregate" in plan[first_exchange:] or "SortAggregate" in plan[first_exchange:]


@pytest.fixture(scope="module")
def folder(raw, tmp_path_factory):
    """The events as JSON lines in several files, with a broken line and a blank one."""
    path = tmp_path_factory.mktemp("events")
    rows = raw.collect()
    for part in range(3):
        lines = [
            json.dumps({**r.asDict(), "timestamp": r.timestamp.isoformat() + "Z" if r.timestamp else None,
                        "produced_at": f"2024-02-01T00:00:{i:02d}Z"})
            for i, r in enumerate(rows) if i % 3 == part
        ]
        (path / f"events_{part}.jsonl").write_text("\n".join([*lines, "", "{broken"]) + "\n")
    return path


def test_jsonl_with_broken_lines(spark, folder, clean):
    read = readers.read_events(spark, f"{folder}/events_*.jsonl")
    assert read.count() == len(ROWS) + 3
    again = events.validate_events(read)
    columns = [c for c in clean.columns if c != "payload"]
    assert sorted(map(str, again.select(columns).collect())) == sorted(map(str, clean.select(columns).collect()))


def test_nested_payload_values_arrive_as_text(spark, tmp_path):
    (tmp_path / "events_1.jsonl").write_text('{"event_id":"a","payload":{"n":1,"o":{"k":true},"s":"x"}}\n')
    payload = readers.read_events(spark, str(tmp_path)).first().payload
    assert payload == {"n": "1", "o": '{"k":true}', "s": "x"}


def test_stream_and_batch_agree(spark, folder, tmp_path):
    def stream():
        return readers.stream_jsonl(spark, str(folder), max_files_per_trigger=1).where("event_id is not null or user_id is not null")

    batch = readers.read_jsonl(spark, str(folder), schemas.STREAM_EVENTS).where("event_id is not null or user_id is not null")
    event_stream.start_counts(stream(), f"{tmp_path}/counts", f"{tmp_path}/c1").awaitTermination()
    assert sorted(spark.read.parquet(f"{tmp_path}/counts").collect()) == sorted(event_stream.running_counts(batch).collect())

    event_stream.start_file_sink(
        event_stream.critical_escalations(stream()), f"{tmp_path}/critical", f"{tmp_path}/c2").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/critical").count() == 2

    event_stream.start_summary(stream(), "topic", f"{tmp_path}/summary", f"{tmp_path}/c3").awaitTermination()
    summary = spark.read.json(f"{tmp_path}/summary").first()
    assert summary.total_messages_consumed == len(ROWS) and summary.critical_escalations_forwarded == 2
    assert summary.throughput_messages_per_second == round(len(ROWS) / 12, 2)

    clean = event_stream.clean_stream(stream()).drop("payload", "produced_at")
    for _ in range(2):  # a restart from the checkpoint adds nothing
        event_stream.start_file_sink(clean, f"{tmp_path}/clean", f"{tmp_path}/c4").awaitTermination()
    ids = [r.event_id for r in spark.read.parquet(f"{tmp_path}/clean").collect()]
    assert sorted(ids) == sorted({r[0] for r in ROWS if r[0] and r[3]})


def test_no_span_gives_no_rate(spark, raw):
    one = event_stream.running_counts(raw.withColumn("produced_at", F.lit(at(1))))
    assert event_stream.summarise(one, "t").first().throughput_messages_per_second is None


def test_parse_messages(spark):
    messages = spark.createDataFrame([('{"event_id":"a","payload":{"severity":"Low"}}',), ("junk",)], "value string")
    assert [r.event_id for r in readers.parse_messages(messages).collect()] == ["a", None]


def test_run_events_writes_five_tables(spark, folder, tmp_path):
    metrics = runs.run_events(spark, f"{folder}/events_*.jsonl", str(tmp_path))
    rows = {r.dataset: r.value for r in metrics.where("metric = 'rows'").collect()}
    assert rows["events"] == 9 and rows["escalation_log"] == 4 and len(rows) == 6
    for name, *_ in runs.EVENT_TABLES:
        writers.verify_output(spark, f"{tmp_path}/{name}")
    assert (tmp_path / "escalation_log" / "severity=Critical").is_dir()
    assert len(list((tmp_path / "peak_usage_analysis").glob("part-*"))) == 1
    with pytest.raises(ValueError):
        spark.createDataFrame([], "a int").write.parquet(f"{tmp_path}/empty")
        writers.verify_output(spark, f"{tmp_path}/empty")
