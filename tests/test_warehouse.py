import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens import schemas
from spendlens.plans import business, marts, projects, transactions, warehouse
from spendlens.session import fresh_path

PROJECTS = [
    ("P1", "One", "IT", " In Progress ", "2020-01-01", "2020-03-01", "1000", "900", "E1", "Low", "Dubai"),
    ("P2", "Two", "IT", "Completed", "2020-01-01", None, None, "50", "E1", "Low", "Dubai"),
    ("P3", "Three", "HR", None, "bad", "2020-03-01", "0", "0", "E2", "Critical", None),
    ("P4", "Four", "HR", "strange", "2020-05-01", "2020-03-01", "100000", "90004", "E2", "Medium", None),
    ("P1", "One again", "IT", "Completed", None, None, "1", "1", "E1", "Low", None),
]
EMPLOYEES = [
    ("E1", "Ann Lee", "a@x.y", "IT", "Dev", "Mid", "2019-05-05", "5000", None, "Dubai", "Active", "-3"),
    ("E2", "Bo Li", None, "HR", "Rep", "Mid", "2019-06-06", "4000", "E1", None, "Active", "2"),
    ("E3", "Cy", "c@x.y", "HR", "Rep", "Mid", "bad", "3000", "E1", None, "Active", None),
]
HISTORY = [
    ("H1", "E1", "2020-01-01", "2020-02-01", None, "3000", "Dev", "Junior", "Hire", None),
    ("H2", "E1", "2020-02-01", "2020-02-01", "3000", "3500", "Dev", "Junior", "Annual Raise", "r"),
    ("H3", "E1", "2020-02-01", "2020-04-01", "3500", "4000", "Dev", "Mid", "Promotion", "p"),
    ("H4", "GONE", "2020-01-01", None, None, "1", "x", "Mid", "Hire", None),
]
TRANSACTIONS = [
    ("T1", "P1", "V1", "Acme", "100.50", "AED", "Cloud", "Paid", "2020-01-31", "I1", "E1"),
    ("T2", "P1", "V1", "Acme Ltd", "200", None, "Cloud", "Pending", "2020-02-01", "I2", "E1"),
    ("T3", "P2", "V2", "Bolt", None, "AED", "Hardware", "Pending", "2020-04-01", "I3", "None"),
    ("T4", "P2", "V2", "Bolt", "abc", "AED", "Hardware", "Disputed", "2019-12-31", "I4", "E1"),
    ("T5", "P9", "V2", "Bolt", "9", "AED", "Hardware", "Paid", "2020-04-01", "I5", "E1"),
    ("T6", "P1", None, "Nobody", "9", "AED", "Hardware", "Paid", "2020-04-01", "I6", "E1"),
    ("T7", "P1", "V1", "Acme", "9", "AED", "Hardware", "Paid", "2030-04-01", "I7", "E1"),
    ("T8", "P1", "V1", "Acme", "7", "AED", "Cloud", "Paid", "2020-02-02", "I8", " "),
    ("T1", "P1", "V1", "Acme", "999", "AED", "Cloud", "Paid", "2020-01-31", "I1", "E1"),
]


@pytest.fixture(scope="module")
def raw(spark):
    make = spark.createDataFrame
    return {
        "projects": make(PROJECTS, schemas.PROJECTS_RAW), "employees": make(EMPLOYEES, schemas.EMPLOYEES_RAW),
        "history": make(HISTORY, schemas.HISTORY_RAW), "transactions": make(TRANSACTIONS, schemas.TRANSACTIONS_RAW),
    }


@pytest.fixture(scope="module")
def star(spark, raw):
    built = warehouse.Warehouse(
        fresh_path(spark, "test-warehouse"), **raw, calendar=warehouse.calendar_bounds(spark, "2019-01-01", "2020-12-31")
    )
    tables = built.build()
    for name, df in tables.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.WAREHOUSE[name]]
    return built


def test_default_calendar(spark):
    days = warehouse.build_dim_date(warehouse.calendar_bounds(spark))
    assert days.count() == 2557
    row = days.where("date_key = 20240101").first()
    assert (row.week, row.quarter, row.day_of_week, row.is_weekend, row.month_name) == (1, 1, "Monday", False, "January")


def test_dim_project(star):
    rows = {r.project_id: r for r in star.dim_project.collect()}
    assert sorted(r.project_key for r in rows.values()) == [1, 2, 3, 4]
    assert rows["P1"].status == "In Progress" and rows["P1"].project_name == "One"
    assert (rows["P1"].duration_days, rows["P1"].budget_utilisation_pct, rows["P1"].risk_level) == (60, Decimal("90.00"), "Low")
    assert rows["P2"].is_over_budget and rows["P2"].budget == 0 and rows["P2"].risk_level == "High"
    assert rows["P3"].status is None and rows["P3"].status_category == "Pending" and rows["P3"].start_date is None
    # 90.004 % rounds to 90.00 but is above 90
    assert rows["P4"].budget_utilisation_pct == Decimal("90.00") and rows["P4"].risk_level == "Medium"
    assert rows["P4"].duration_days == -61


def test_rounded_projects_see_the_rounded_share(raw):
    rows = {r.project_name: r for r in projects.transform_projects(raw["projects"], title=False, rounded=True).collect()}
    assert rows["Four"].risk_level == "Low" and rows["Three"].status == "Nan"
    exact = {r.project_name: r for r in projects.transform_projects(raw["projects"]).collect()}
    assert exact["Four"].risk_level == "Medium" and exact["Four"].status == "Strange" and exact["Two"].budget_utilisation_pct == 0


def test_scd2_versions(star):
    e1 = star.dim_employee.where("employee_id = 'E1'").orderBy("employee_key").collect()
    assert [(str(r.valid_from), str(r.valid_to), r.is_current, int(r.salary)) for r in e1] == [
        ("2020-01-01", "2020-02-01", False, 3000), ("2020-02-01", "2020-02-01", False, 3500),
        ("2020-02-01", "2020-02-02", False, 4000), ("2020-02-02", "9999-12-31", True, 5000),
    ]
    assert [r.years_experience for r in e1] == [-3, -3, -3, 3]
    others = {r.employee_id: r for r in star.dim_employee.where("employee_id <> 'E1'").collect()}
    assert str(others["E2"].valid_from) == "2019-06-06" and str(others["E3"].valid_from) == "2020-01-01"
    assert "GONE" not in others
    assert warehouse.multiple_current(star.dim_employee).count() == 0
    assert warehouse.version_overlaps(star.dim_employee).count() == 0
    assert star.dim_employee.count() == 3 + 3


def test_versions_closed_by_the_file(raw):
    dim = warehouse.build_dim_employee(raw["history"], raw["employees"], closed_by="end_date")
    rows = {(r.employee_id, int(r.salary)): r for r in dim.collect()}
    assert str(rows["GONE", 1].valid_to) == "9999-12-31" and rows["GONE", 1].full_name == "Staff Member"
    assert str(rows["E1", 5000].valid_from) == "2020-04-01" and rows["E1", 5000].is_current
    with pytest.raises(ValueError):
        warehouse.build_dim_employee(raw["history"], raw["employees"], closed_by="guess")


def test_facts(star):
    rows = {r.transaction_id: r for r in star.fact_transactions.collect()}
    assert sorted(rows) == ["T1", "T2", "T3", "T4", "T8"]
    salary = {r.employee_key: int(r.salary) for r in star.dim_employee.collect()}
    assert salary[rows["T1"].employee_key] == 3000
    assert salary[rows["T2"].employee_key] == 4000
    assert rows["T3"].employee_key == 1 and rows["T4"].employee_key == 1
    assert (rows["T3"].amount, rows["T4"].amount, rows["T2"].currency) == (0, 0, "AED")
    assert [rows[t].is_approved for t in ("T1", "T3", "T8")] == [True, False, False]
    vendors = {r.vendor_id: r.vendor_name for r in star.dim_vendor.collect()}
    assert vendors == {"V1": "Acme", "V2": "Bolt"}


def test_business_questions(star):
    spend = {r.department: r for r in business.dept_budget_performance(star.dim_project).collect()}
    assert set(spend) == {"IT", "HR"} and spend["IT"].spend_percentage == 95.0
    loose = business.manager_workload(star.dim_project, star.dim_employee, 1, strict=False).collect()
    assert [(r.full_name, r.active_project_count) for r in loose] == [("Ann Lee", 1)]
    assert business.manager_workload(star.dim_project, star.dim_employee).count() == 0
    shares = business.vendor_concentration(star.fact_transactions, star.dim_vendor).collect()
    assert [(r.vendor_name, r.risk_flag, r.percentage_of_total_spend) for r in shares] == [("Acme", "HIGH", 100.0)]
    raised = business.largest_salary_increases(star.dim_employee).collect()
    assert [int(r.increase_amount) for r in raised] == [1000, 500, 500]
    top = marts.top_vendors_and_other(star.fact_transactions, star.dim_vendor, 1).collect()
    assert {r.vendor: r.transaction_count for r in top} == {"Acme": 3, "Other": 2}
    kpi = marts.kpi_cards(star.dim_project, star.fact_transactions).first()
    assert (kpi.over_budget_projects, kpi.transaction_count, kpi.active_projects) == (1, 5, 1)


def test_enrichment_keeps_every_row(raw):
    rows = transactions.enrich_transactions(raw["transactions"], raw["projects"], raw["employees"]).collect()
    assert len(rows) == len(TRANSACTIONS)
    by_id = {r.transaction_id: r for r in rows if r.transaction_id != "T1"}
    assert by_id["T3"].approver_full_name == "Unassigned / Pending" and not by_id["T3"].is_approved
    # the text is compared untrimmed here
    assert by_id["T8"].is_approved and by_id["T8"].approved_by == " "
    assert by_id["T2"].approver_full_name == "Ann Lee" and by_id["T2"].transaction_year_month == "2020-02"
    assert by_id["T5"].project_name is None and by_id["T4"].amount == 0.0
