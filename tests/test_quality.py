import json

import pytest
from pyspark.sql import functions as F

from spendlens import schemas, session
from spendlens.plans import governance, quality, runs
from spendlens.sources import readers, writers

PROJECT = {"project_id": "P1", "project_name": "One", "department": "IT", "status": "Completed", "start_date": "2020-01-01",
           "end_date": "2020-02-01", "budget": "10", "actual_cost": "5", "project_manager_id": "E1", "priority": "Low", "region": "Dubai"}
EMPLOYEE = {"employee_id": "E1", "full_name": "Ann Lee", "email": "a@x.y", "department": "IT", "role": "Dev", "level": "Mid",
            "hire_date": "2019-01-01", "salary": "5000", "manager_id": "E2", "region": "Dubai", "status": "Active", "years_experience": "3"}
TRANSACTION = {"transaction_id": "T1", "project_id": "P1", "vendor_id": "V1", "vendor_name": "Acme", "amount": "10.50", "currency": "AED",
               "category": "Cloud", "payment_status": "Paid", "transaction_date": "2020-01-05", "invoice_ref": "I", "approved_by": "E1"}


def frame(spark, schema, base, *changes):
    rows = [{**base, **change} for change in changes or ({},)]
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)


def projects(spark, *changes):
    return frame(spark, schemas.PROJECTS_RAW, PROJECT, *changes)


def employees(spark, *changes):
    return frame(spark, schemas.EMPLOYEES_RAW, EMPLOYEE, *changes)


def transactions(spark, *changes):
    return frame(spark, schemas.TRANSACTIONS_RAW, TRANSACTION, *changes)


def verdicts(results):
    return {r.check: (r.passed, r.failed_rows, r.metric_value) for r in results.collect()}


def test_project_suite(spark):
    df = projects(
        spark, {}, {"project_id": "P1", "budget": "-1"}, {"project_id": None, "start_date": "2021-01-01"},
        {"project_id": "P2", "actual_cost": "-2", "end_date": "soon"}, {"project_id": "P3", "budget": None, "project_manager_id": "E9"},
    )
    got = verdicts(quality.run_suite("projects", df, quality.RULES["projects"], {"employees": employees(spark)}))
    assert got["completeness"] == (True, 2, "96.36%")
    assert got["primary_key:project_id"] == (False, 2, "2")
    assert got["numeric_range:budget"] == (False, 1, "0..10000000")
    assert got["valid_date:end_date"] == (False, 1, "4 valid / 1 invalid")
    assert got["before:start_date:end_date"] == (False, 1, "1 bad rows")
    assert got["non_negative:actual_cost"] == (False, 1, "1 negative rows")
    assert got["foreign_key:project_manager_id"] == (False, 1, "1 missing rows")
    assert list(got)[0] == "completeness" and len(got) == 9


def test_foreign_key_without_its_parent_is_skipped(spark):
    got = verdicts(quality.run_suite("projects", projects(spark), quality.RULES["projects"]))
    assert not any(name.startswith("foreign_key") for name in got)


def test_missing_column_fails_all_rows(spark):
    df = projects(spark, {}, {}).drop("budget")
    got = verdicts(quality.run_suite("projects", df, {"numeric_ranges": {"budget": {"min": 0, "max": 1}}}))
    assert got == {"numeric_range:budget": (False, 2, "Missing")}


def test_row_checks_share_one_pass(spark):
    rules = {k: v for k, v in quality.RULES["employees"].items() if k != "pk_columns"}
    plan = quality.run_suite("employees", employees(spark), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_extended_checks(spark):
    df = employees(spark, *[{"salary": str(1000 + i)} for i in range(20)], {"salary": "99999", "level": "Junior", "region": None})
    rules = {
        "column_completeness": {"region": 99.0}, "dominant_values": {"level": 30.0}, "outliers": {"salary": 3.0},
        "freshness": {"hire_date": {"as_of": "2019-01-31"}}, "not_future": {"hire_date": "2018-01-01"},
        "salary_for_level": [{"level": "level", "salary": "salary", "bounds": {"Junior": (0, 50_000)}}],
        "consistency_rules": [{"type": "custom_sql", "name": "paid", "expression": "CAST(salary AS INT) < 50000"}],
    }
    got = verdicts(quality.run_suite("employees", df, rules))
    assert got["column_completeness:region"] == (False, 1, "95.24%")
    assert got["dominant_value:level"] == (False, 20, "95.24%")
    assert got["outliers:salary"] == (False, 1, "1 outliers")
    assert got["freshness:hire_date"] == (True, 0, "30 days")
    assert got["not_future:hire_date"][1] == 21
    assert got["salary_for_level:salary"][1] == 1 and got["custom:paid"][1] == 1


@pytest.mark.parametrize("change, message", [
    (("p", {"priority": None}), "unknown priority"), (("p", {"project_id": "P1"}), "duplicate project_id"),
    (("e", {"employee_id": "E7", "salary": "0"}), "salary"), (("e", {"employee_id": "E7", "level": "Boss"}), "unknown level"),
    (("t", {"transaction_id": "T2", "amount": "-1"}), "negative amount"), (("t", {}), "duplicate transaction_id"),
])
def test_gate_names_the_violated_rule(spark, change, message):
    which, values = change
    if which == "p" and "project_id" not in values:
        values = {**values, "project_id": "P2"}
    tables = [projects(spark, *([{}, values] if which == "p" else [{}])), employees(spark, *([{}, values] if which == "e" else [{}])),
              transactions(spark, *([{}, values] if which == "t" else [{}]))]
    with pytest.raises(ValueError, match=message):
        quality.assert_gate(*tables)


def test_reports(spark, tmp_path):
    tables = {"projects": projects(spark), "employees": employees(spark), "transactions": transactions(spark)}
    summary = {r.dataset: (r.checks_run, r.checks_failed) for r in runs.quality_report(tables, str(tmp_path)).collect()}
    assert summary == {"projects": (9, 0), "employees": (8, 0), "transactions": (8, 0)}
    lines = [r.value for r in spark.read.text(f"{tmp_path}/dq_report_projects").collect()]
    assert lines[4:7] == ["Checks run: 9", "Checks passed: 9", "Checks failed: 0"]
    assert lines[10].startswith("| completeness | projects | True | 0 |") and len(lines) == 19


ARRAY = '[\n  {"transaction_id":"T1","project_id":"P1","amount":1.50,"approved_by":"E1"},\n{"transaction_id":"T2","amount":null}\n,{"transaction_id":"x, y]"}]\n'


@pytest.mark.parametrize("by_line", [True, False])
def test_json_array_layouts(spark, tmp_path, by_line):
    (tmp_path / "a.json").write_text(ARRAY)
    df = readers.read_transactions(spark, str(tmp_path), by_line)
    assert df.columns == schemas.TRANSACTIONS_RAW.names and df.count() == 3
    assert sorted((r.transaction_id, r.amount) for r in df.collect()) == [("T1", "1.50"), ("T2", None), ("x, y]", None)]


def test_nested_objects_are_flattened(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": {"b": "1", "c": {"d": "2"}}, "e": "3"}]')
    schema = schemas.T.StructType.fromDDL("a struct<b: string, c: struct<d: string>>, e string")
    df = readers.read_json_array(spark, str(tmp_path), schema)
    assert df.columns == ["a.b", "a.c.d", "e"] and tuple(df.first()) == ("1", "2", "3")


def test_csv_round_trip_keeps_blanks_and_quotes(spark, tmp_path):
    df = projects(spark, {"project_name": 'a "quoted", name', "status": "  in progress ", "region": None})
    writers.write_csv(df, f"{tmp_path}/p")
    assert readers.read_projects(spark, f"{tmp_path}/p").collect() == df.collect()


def test_csv_columns_are_found_by_name_and_null_texts_are_missing(spark, tmp_path):
    (tmp_path / "p.csv").write_text("status,extra,project_id,budget\nNA,1,P1,10\nnan,2,P2,\nNaNny,3,None,5\n")
    df = readers.read_projects(spark, str(tmp_path))
    assert df.columns == ["project_id", "status", "budget"]
    assert [tuple(r) for r in df.collect()] == [("P1", None, "10"), ("P2", None, None), (None, "NaNny", "5")]


def test_etl_stops_at_the_gate_and_reports(spark, tmp_path):
    def run(name, **change):
        base = tmp_path / name
        writers.write_csv(projects(spark, {**change}), f"{base}/projects")
        writers.write_csv(employees(spark, {}, {"employee_id": "E2", "email": None}), f"{base}/employees")
        (base / "t.json").write_text(json.dumps([TRANSACTION, {**TRANSACTION, "transaction_id": "T2", "approved_by": None}]))
        return runs.run_etl(spark, f"{base}/projects", f"{base}/employees", f"{base}/t.json", f"{base}/out", "r1", "2024-01-01")

    with pytest.raises(ValueError, match="unknown priority"):
        run("bad", priority="Urgent")
    assert not (tmp_path / "bad" / "out").exists()
    rows = {(r.dataset, r.stage): r.value for r in run("good").where("metric = 'rows'").collect()}
    assert rows == {(d, s): n for d, n in (("projects", 1), ("employees", 2), ("transactions", 2)) for s in ("extract", "load")}
    report = [r.value for r in spark.read.text(f"{tmp_path}/good/out/report_r1").collect()]
    assert "Data quality gate: PASSED" in report and "employees: 2 raw rows, 2 clean rows, delta +0" in report
    assert "  - missing_emails: 1 rows fixed" in report


def test_profile(spark):
    df = employees(spark, {}, {"salary": "7000", "region": None}).withColumn("salary", F.col("salary").cast("double"))
    result = runs.profile(df, "level", "salary", ("region",))
    assert result["shape"].first().row_count == 2
    assert {r.column_name: r.null_count for r in result["nulls"].collect()}["region"] == 1
    assert result["values:region"].count() == 2
    assert result["describe"].first().median == 6000.0


def test_table_contract(spark):
    raw = transactions(spark, {"amount": None, "currency": None}).drop("invoice_ref")
    contract = schemas.T.StructType([schemas.FACT_TRANSACTIONS[n] for n in ("transaction_id", "amount", "currency", "invoice_ref")])
    row = writers.enforce_schema(raw, contract, {"amount": 0, "currency": "AED"}).first()
    assert (row.amount, row.currency, row.invoice_ref) == (0, "AED", None)
    with pytest.raises(ValueError, match="transaction_key"):
        writers.enforce_schema(raw, schemas.FACT_TRANSACTIONS)


def test_masking_and_personas(spark):
    df = employees(spark)
    row = governance.mask_employees(df).first()
    assert row.full_name == "A*** L***" and row.email.endswith("@example.com") and len(row.email.split("@")[0]) == 64
    assert "salary" not in governance.persona_view(df, "employees", "data_engineer").columns
    assert "salary" in governance.persona_view(df, "employees", "hr").columns
    assert set(governance.persona_view(df, "employees", "bi_analyst").columns).isdisjoint({"salary", "hire_date"})
    with pytest.raises(PermissionError):
        governance.persona_view(df, "employees", "finance")
    total = governance.persona_view(projects(spark, {}, {"project_id": "P2"}), "projects", "bi_analyst").first()
    assert (total.row_count, total.total_budget) == (2, 20)
    assert governance.catalog(spark).count() == 45
    assert governance.own_transactions(transactions(spark), projects(spark), "E1").count() == 1
    assert governance.team_names(df, "E2").count() == 1


def test_perturbed_salaries_stay_within_the_limit(spark):
    df = employees(spark, *[{"employee_id": f"E{i}", "salary": "10000"} for i in range(200)])
    rows = governance.perturb_salaries(df).collect()
    assert all(9000 <= r.salary <= 11000 for r in rows) and len({r.salary for r in rows}) > 50
    assert sorted(map(str, rows)) == sorted(map(str, governance.perturb_salaries(df.repartition(3)).collect()))


def test_retention(spark):
    df = transactions(spark, *[{"transaction_date": d} for d in ("2010-01-01", "2017-01-01", "2019-01-01", None)])
    kept, expired = governance.retention_split(df, "transaction_date", 7, "2024-01-01")
    assert kept.count() == 3 and expired.count() == 1
    states = governance.retention(df, "transaction_date", 5, "2024-01-01", 2)
    assert [r.retention_state for r in states.orderBy("transaction_date").collect()] == ["keep", "expire", "archive", "keep"]


def test_scratch_folder(spark, monkeypatch):
    assert session.materialize(spark.range(3), "x").count() == 3
    assert session.scratch_root(spark).startswith(spark.conf.get(session.CHECKPOINT_CONF))
    # without the setting a local session gets a folder of its own, which can be dropped
    monkeypatch.setattr(session, "CHECKPOINT_CONF", "spark.checkpoint.unset")
    kept = session.materialize(spark.range(3), "x")
    assert kept.count() == 3
    session.drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|not exist"):
        kept.count()
