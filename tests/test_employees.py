import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spendlens import schemas
from spendlens.plans import employees


def assign_in_turn(rows, domain, fallback):
    """The rule as a reader would state it: one row after the other, first free address."""
    used = {r["email"].strip().lower() for r in rows if r["email"] and r["email"].strip()}
    result = {}
    for r in sorted(rows, key=lambda r: r["employee_id"]):
        if r["email"] and r["email"].strip():
            result[r["employee_id"]] = r["email"]
            continue
        words = "".join(c for c in r["full_name"].lower() if c.isalpha() or c.isspace()).split()
        base = f"{words[0]}.{words[-1]}" if len(words) > 1 else "".join(words)
        if not base and fallback:
            base = f"employee_{r['employee_id'].lower()}"
        n, address = 0, f"{base}@{domain}"
        while address in used:
            n += 1
            address = f"{base}{n}@{domain}"
        used.add(address)
        result[r["employee_id"]] = address
    return result


def frame(spark, rows):
    full = [{name: None for name in schemas.EMPLOYEES_RAW.names} | r for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in schemas.EMPLOYEES_RAW.names) for r in full], schemas.EMPLOYEES_RAW)


NAMED = [
    {"employee_id": "E01", "full_name": "Ann Lee", "email": None},
    {"employee_id": "E02", "full_name": "Ann Lee", "email": " "},
    {"employee_id": "E03", "full_name": "Ann Lee", "email": "Ann.Lee@example.com "},
    {"employee_id": "E04", "full_name": "Ann Lee", "email": "ann.lee2@example.com"},
    {"employee_id": "E05", "full_name": "ann van lee", "email": None},
    {"employee_id": "E06", "full_name": "Cher", "email": None},
    {"employee_id": "E07", "full_name": "Cher", "email": None},
    {"employee_id": "E08", "full_name": "José O'Neil", "email": None},
    {"employee_id": "E09", "full_name": "Jose ONeil", "email": "josé.oneil@example.com"},
    {"employee_id": "E10", "full_name": "Ann Lee", "email": "ann.lee@other.org"},
    {"employee_id": "E11", "full_name": "Ann Lee", "email": "ann.lee01@example.com"},
    {"employee_id": "E12", "full_name": "12345", "email": None},
    {"employee_id": "E13", "full_name": "X Y", "email": "employee_e12@example.com"},
]


@pytest.mark.parametrize("fallback", [True, False])
def test_emails_as_if_assigned_in_turn(spark, fallback):
    got = employees.fill_emails(frame(spark, NAMED), id_fallback=fallback).collect()
    assert {r.employee_id: r.email for r in got} == assign_in_turn(NAMED, "example.com", fallback)


def test_emails_of_a_hot_name_are_unique(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        name = "Hot Name" if i % 3 else rng.choice(["Ann Lee", "Bo Li", "Cy"])
        email = None if rng.random() < 0.5 else rng.choice(["hot.name", "ann.lee", "bo.li", "cy"]) + rng.choice(
            ["", *map(str, range(1, 60))]) + "@example.com"
        rows.append({"employee_id": f"E{i:04d}", "full_name": name, "email": email})
    got = {r.employee_id: r.email for r in employees.fill_emails(frame(spark, rows)).collect()}
    assert got == assign_in_turn(rows, "example.com", True)
    filled = [got[r["employee_id"]] for r in rows if r["email"] is None]
    assert len(set(filled)) == len(filled) and not set(filled) & {r["email"] for r in rows}


def test_nothing_to_fill(spark):
    df = frame(spark, [{"employee_id": "E1", "full_name": "A B", "email": "a@b.c"}])
    assert employees.fill_emails(df) is df


RAW = [
    {"employee_id": "E1", "full_name": "A B", "email": "a@x.y", "hire_date": "2010-01-01", "level": "Junior",
     "salary": "30000", "years_experience": "-5", "manager_id": "E9"},
    {"employee_id": "E2", "full_name": "C D", "email": "c@x.y", "hire_date": "not-a-date", "level": "Junior",
     "salary": "60000", "years_experience": "4", "manager_id": "E2"},
    {"employee_id": "E3", "full_name": "E F", "email": "e@x.y", "hire_date": "1985-05-05", "level": "Junior",
     "salary": "40001", "years_experience": "text", "manager_id": "E9"},
    {"employee_id": "E4", "full_name": "G H", "email": "g@x.y", "hire_date": "2030-01-01", "level": "Lead",
     "salary": "90000", "years_experience": None, "manager_id": None},
    {"employee_id": "E5", "full_name": "I J", "email": None, "hire_date": None, "level": "Mid",
     "salary": "50000", "years_experience": "2", "manager_id": "E9"},
    {"employee_id": "E5", "full_name": "Z J", "email": "z@x.y", "hire_date": "2011-01-02", "level": "Mid",
     "salary": "50000", "years_experience": "2", "manager_id": "E9"},
]


def test_clean_employees_repairs(spark):
    clean = employees.clean_employees(frame(spark, RAW), as_of="2024-01-01", keep_flags=True)
    assert clean.columns == [*employees.CANONICAL_COLUMNS, *employees.FLAGS]
    rows = {r.employee_id: r for r in clean.collect()}
    assert len(rows) == 5
    # parsed dates 1985-05-05, 2010-01-01, 2011-01-02, 2030-01-01: the median is between the middle two
    days = [dt.date(2010, 1, 1).toordinal(), dt.date(2011, 1, 2).toordinal()]
    middle = str(dt.date.fromordinal(sum(days) // 2))
    assert [rows[f"E{i}"].hire_date for i in range(1, 6)] == ["2010-01-01", middle, middle, middle, middle]
    assert [rows[f"E{i}"].years_experience for i in range(1, 6)] == [5, 4, 0, 0, 2]
    assert rows["E2"].manager_id == "EMP0000" and rows["E1"].manager_id == "E9"
    assert float(rows["E2"].salary) == 40001 and rows["E4"].salary == "90000"
    assert [rows[f"E{i}"].dq_invalid_hire_date for i in range(1, 6)] == [False, True, True, True, False]


def test_employee_issues(spark):
    got = {r.issue: r.row_count for r in employees.employee_issues(frame(spark, RAW), "2024-01-01").collect()}
    assert got == {
        "missing_emails": 1, "invalid_hire_dates": 1, "implausible_hire_dates": 2, "negative_years_experience": 1,
        "employee_is_own_manager": 1, "salary_level_mismatches": 1, "duplicate_employee_ids": 1,
    }


def test_status_rules_mark_conflicts(spark):
    df = frame(spark, RAW).withColumn("status", F.lit("Terminated"))
    clean = employees.clean_employees(
        df, as_of="2024-01-01", keep_flags=True, status_rules=("status = 'Terminated' AND level = 'Lead'",)
    )
    assert [r.employee_id for r in clean.where("dq_status_conflict").collect()] == ["E4"]
