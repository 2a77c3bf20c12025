"""Rows that are dealt by ranges of their order move once for all of their joins and for their numbers."""

import datetime as dt
import re

from pyspark.sql import functions as F

from spendlens.operators import lookups, ordering, temporal
from spendlens.plans import warehouse
from spendlens.session import dealt_alike, materialize


def test_ranges_follow_the_order(spark):
    rows = materialize(spark.range(3000).select(
        F.when(F.col("id") % 100 != 0, F.concat(F.lit("k\"é,"), (F.col("id") * 7919 % 1000).cast("string"))).alias("k"),
        F.when(F.col("id") % 7 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 3).cast("int"))).alias("d")), "rows")
    for keys in (["k"], ["k", "d"]):
        sizes = ordering.with_range(rows, keys, "r").groupBy(*keys, "r").count().orderBy(*keys).collect()
        numbers = [row.r for row in sizes]
        assert numbers == sorted(numbers) and numbers[0] == 0
        assert len({tuple(row[:-2]) for row in sizes}) == len(sizes)
        assert len(set(numbers)) > 32 and max(numbers) < 64


def test_no_range_is_needed(spark):
    for texts in ([], [None, None], ["a", "a"]):
        rows = materialize(spark.createDataFrame([(t,) for t in texts], "k string"), "few")
        assert ordering.with_range(rows, ["k"], "r").select("r").distinct().count() <= 1


def moved(df):
    """Exchanges by key in the plan, as the keys' names."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"(?<!Broadcast)Exchange hashpartitioning\(([^)]*), \d+\)", plan)]


def test_dealt_rows_move_once(spark):
    rows = materialize(spark.range(500).select(
        (F.col("id") % 10).cast("int").alias("p"), "id", F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("a"),
        F.when(F.col("id") % 5 > 0, F.lit("hot")).alias("b")), "rows")
    one = materialize(rows.where("a = '1'").select("p", "a").distinct().withColumn("x", F.concat("a", F.lit("!"))), "one")
    two = materialize(rows.where("b IS NOT NULL").select("p", "b").distinct().withColumn("y", F.lit(7)), "two")
    with dealt_alike(spark):
        left = lookups.dealt_join(rows, "p", [(["a"], one, "left"), (["b"], two, "left")])
        assert len(moved(left)) == 3
        found = {row.id: (row.a, row.x, row.b, row.y) for row in left.collect()}
        inner = lookups.dealt_join(rows, "p", [(["a"], one, "inner"), (["b"], two, "left")]).select("id").collect()
    assert len(found) == 500 and sorted(row.id for row in inner) == [i for i in range(500) if i % 3 == 1]
    for i, (a, x, b, y) in found.items():
        assert (a, x) == ((None, None) if i % 3 == 0 else (str(i % 3), "1!" if i % 3 == 1 else None))
        assert (b, y) == ((None, None) if i % 5 == 0 else ("hot", 7))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_versions_asked_for_by_part(spark):
    day = dt.date(2020, 1, 1)
    versions = spark.createDataFrame([("a", 1, day, dt.date(2020, 1, 3)), ("a", 2, dt.date(2020, 1, 3), dt.date(9999, 12, 31))],
                                     "id string, v long, valid_from date, valid_to date")
    probes = spark.createDataFrame([(p, "a", dt.date(2020, 1, d)) for p in (0, 1, 1) for d in (1, 3)] + [(2, None, day), (2, "a", None), (2, "b", day)],
                                   "p int, who string, d date")
    got = temporal.point_in_time(probes, versions, "who", "d", "id", "v", ["p"]).select("p", "who", "d", "v").collect()
    assert sorted(map(tuple, got)) == [(p, "a", dt.date(2020, 1, d), 1 if d == 1 else 2) for p in (0, 1) for d in (1, 3)]


HISTORY = "history_id string, employee_id string, effective_date string, new_salary string, new_role string, new_level string, change_reason string"
PEOPLE = ("employee_id string, full_name string, email string, department string, role string, level string, salary string, manager_id string,"
          " region string, years_experience string, hire_date string")


def test_versions_of_one_employee_are_dealt_out(spark):
    """Also where an employee takes many ranges, every version ends where the next one starts and numbers follow the order."""
    rows = [(f"H{i}", f"E{1 if i % 3 else i % 11}", str(dt.date(2000, 1, 1) + dt.timedelta(days=i * 37 % 700)), str(i), "r", "l", None) for i in range(900)]
    rows.append(("H900", "E1", None, "5", "r", "l", None))
    history = spark.createDataFrame(rows, HISTORY)
    people = spark.createDataFrame([(f"E{i}", "n", None, "d", "r", "l", "1", None, None, None, None) for i in range(11)], PEOPLE)
    found = warehouse.build_dim_employee(history, people).orderBy("employee_key").collect()
    assert [row.employee_key for row in found] == list(range(1, 913))
    least = dt.date(1, 1, 1)
    order = [(row.employee_id, row.valid_from or least) for row in found]
    assert order == sorted(order)
    for row, after in zip(found, [*found[1:], None]):
        same = after is not None and after.employee_id == row.employee_id
        assert row.valid_to == (after.valid_from if same else dt.date(9999, 12, 31)) and row.is_current == (not same)


def facts(spark, ids, save=None):
    """Facts of transactions with these ids, in the tables of two projects and vendors."""
    stored = materialize(spark.createDataFrame(
        [(t, f"P{i % 3}", f"V{i % 2}", "v", str(i), None, "c", "Paid", f"2024-01-0{1 + i % 5}", "I", "E1") for i, t in enumerate(ids)],
        "transaction_id string, project_id string, vendor_id string, vendor_name string, amount string, currency string, category string,"
        " payment_status string, transaction_date string, invoice_ref string, approved_by string"), "transactions")
    people = spark.createDataFrame([("E1", "Ann", "a@x", "IT", "dev", "Mid", "100.5", "M", "R", "3", "2024-01-03")], PEOPLE)
    projects = spark.createDataFrame([("P0", 1), ("P1", 2)], "project_id string, project_key long")
    days = materialize(warehouse.build_dim_date(warehouse.calendar_bounds(spark, "2024-01-01", "2024-01-04")), "days")
    people = materialize(warehouse.build_dim_employee(spark.createDataFrame([], HISTORY), people), "people")
    return warehouse.build_fact_transactions(
        stored, materialize(projects, "projects"), people, materialize(warehouse.build_dim_vendor(stored), "vendors"), days, 1, save)


def test_numbers_without_gaps(spark):
    ids = [f"T{i:04}" for i in range(600)]
    kept = [t for i, t in enumerate(ids) if i % 3 < 2 and i % 5 < 4]
    saved = []

    def save(df):
        saved.append(moved(df))
        return materialize(df, "facts")

    found = facts(spark, ids, save).orderBy("transaction_key").collect()
    assert [(r.transaction_key, r.transaction_id) for r in found] == [*zip(range(1, len(kept) + 1), kept)]
    # rows, their projects and approvers are dealt by range; the rest is to find the approvers
    assert len(saved) == 1 and saved[0].count("_range") == 3
    assert {keys for keys in saved[0] if keys != "_range"} <= {"_range, _key", "_key", "employee_id"}


def test_repeated_and_missing_ids(spark):
    ids = [None if i % 50 == 0 else f"T{i % 200:04}" for i in range(600)]
    saved = []
    found = facts(spark, ids, lambda df: saved.append(1) or materialize(df, "facts")).orderBy("transaction_key").collect()
    known = {t for i, t in enumerate(ids) if i % 3 < 2 and i % 5 < 4}
    assert [r.transaction_key for r in found] == list(range(1, len(known) + 1)) and len(saved) == 2
    assert [r.transaction_id for r in found] == sorted(known, key=lambda t: t or "")
    least = {}
    for i, t in enumerate(ids):
        if i % 3 < 2 and i % 5 < 4:
            least[t] = min(least.get(t, 10**9), i)
    assert {r.transaction_id: int(r.amount) for r in found} == least


def enriched(spark, stored):
    from spendlens.plans import transactions

    names = ("transaction_id", "project_id", "vendor_id", "vendor_name", "amount", "currency", "category", "payment_status",
             "transaction_date", "invoice_ref", "approved_by")
    rows = [(None if i % 90 == 0 else f"T{i % 250}", f"P{i % 7}" if i % 5 else None, "V", None, str(i), "AED", "c", "Paid", "2024-01-05", f"I{i}",
             (None, " ", "None", "E1", "E1", "E2", "E9")[i % 7]) for i in range(400)]
    raw = materialize(spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names)), "raw")
    projects = spark.createDataFrame([(f"P{i % 5}", f"n{i // 5}", None) for i in range(10)], "project_id string, project_name string, department string")
    people = spark.createDataFrame([("E1", "Ann"), ("E2", None), (None, "Nobody"), ("E1", "Zoe")], "employee_id string, full_name string")
    return transactions.enrich_transactions(raw, projects, people, **({"stored": True} if stored else {}))


def test_stored_transactions_move_once_for_both_names(spark):
    plain = enriched(spark, False)
    with dealt_alike(spark):
        dealt = enriched(spark, True)
        assert dealt.columns == plain.columns
        wide = [keys for keys in moved(dealt) if keys in ("approved_by", "project_id")]
        assert moved(dealt).count("_range") >= 1 and len(wide) <= 4
        found = sorted(map(str, dealt.collect()))
    assert found == sorted(map(str, plain.collect())) and len(found) == 400


def test_the_larger_side_is_added_last(spark):
    """The first exchange need not move what the second join adds."""
    joins = [line for line in enriched(spark, False)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert "project_id" in joins[0] and "approved_by" in joins[1]


def test_repeated_keys_are_told_by_their_hashes(spark):
    from spendlens.plans import quality

    for keys, copies in (([str(i) for i in range(60)], 0), (["a", "a", "b", None, None, None], 3), ([None, "a"], 0), ([], 0)):
        rows = spark.createDataFrame([(k,) for k in keys], "k string")
        found = spark.range(1).select(quality._extra_copies(rows, "k").alias("n"))
        assert found.first().n == copies
        # the keys themselves are grouped only if hashes repeat
        assert ("k#" in found._jdf.queryExecution().optimizedPlan().toString()) == bool(copies)
