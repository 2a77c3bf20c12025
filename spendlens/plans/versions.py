"""The Type 2 employee dimension kept in place: changes come in deltas, keys never change.

Versions are stored in folders by a hash of the employee. A delta reads and rewrites only the folders of the employees
it names, so a small delta costs as much as its folders hold, and the rest is not touched. A version is known by (employee, change id), and the
current state of an employee by the employee; each keeps the surrogate key it got when it first came. Applying a delta again, or parts of it in
another order, gives the same table. Changes of people who are not in the employee file yet wait in the
store and become versions when they are.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from spendlens import schemas
from spendlens.functions import exprs
from spendlens.operators import ordering, temporal
from spendlens.plans.employees import DEFAULT_DOMAIN
from spendlens.session import materialize
from spendlens.sources.writers import enforce_schema

BUCKETS = 64

_IDENTITY = ["full_name", "email", "department", "manager_id", "region", "years_experience"]
_STORED = T.StructType([
    T.StructField("employee_id", T.StringType()), T.StructField("present", T.BooleanType()), T.StructField("source_key", T.StringType()),
    T.StructField("role", T.StringType()), T.StructField("level", T.StringType()), T.StructField("salary", schemas.SALARY),
    T.StructField("starts", T.DateType()), T.StructField("change_reason", T.StringType()),
    T.StructField("full_name", T.StringType()), T.StructField("email", T.StringType()), T.StructField("department", T.StringType()),
    T.StructField("manager_id", T.StringType()), T.StructField("region", T.StringType()), T.StructField("years_experience", T.IntegerType()),
    T.StructField("employee_key", T.LongType()), T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType()),
    T.StructField("is_current", T.BooleanType()), T.StructField("bucket", T.IntegerType()),
])
_CONTENT = ["role", "level", "salary", "starts", "change_reason", *_IDENTITY]


class VersionStore:
    """Versions under ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _stored(self) -> DataFrame:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], _STORED)
        return self.spark.read.schema(_STORED).parquet(self.path)

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64("employee_id"), F.lit(self.buckets)).cast("int")

    def _delta(self, changes: DataFrame, employees: DataFrame) -> DataFrame:
        nothing = {name: F.lit(None).cast(_STORED[name].dataType) for name in _IDENTITY}
        past = changes.select(
            "employee_id", F.lit(False).alias("present"), F.col("history_id").alias("source_key"),
            F.col("new_role").alias("role"), F.col("new_level").alias("level"),
            exprs.as_decimal(changes, "new_salary", schemas.SALARY).alias("salary"),
            exprs.as_date(changes, "effective_date").alias("starts"),
            F.coalesce("change_reason", F.lit("Historical Revision")).alias("change_reason"),
            *[column.alias(name) for name, column in nothing.items()],
        )
        now = employees.select(
            "employee_id", F.lit(True).alias("present"), F.lit(None).cast("string").alias("source_key"), "role", "level",
            exprs.as_decimal(employees, "salary", schemas.SALARY).alias("salary"),
            F.coalesce(exprs.as_date(employees, "hire_date"), F.lit("2020-01-01").cast("date")).alias("starts"),
            F.lit("Current Position").alias("change_reason"), "full_name", "email", "department", "manager_id", "region",
            exprs.as_int(employees, "years_experience").alias("years_experience"),
        )
        return past.unionByName(now).where(F.col("employee_id").isNotNull()).withColumn("bucket", self._bucket())

    def apply(self, changes: DataFrame, employees: DataFrame) -> None:
        """Merge changes and current states, new or seen before, into the store; the delta wins over what is stored."""
        delta = materialize(self._delta(changes, employees), "delta")
        # at most one row per folder
        touched = [row.bucket for row in delta.select("bucket").distinct().collect()]
        if not touched:
            return
        stored = self._stored()
        last_key = stored.agg(F.max("employee_key")).first()[0] or 0
        old = stored.where(F.col("bucket").isin(touched))
        both = old.select(*_known(), *_CONTENT, "bucket", "employee_key", F.lit(0).alias("order")).unionByName(
            delta.select(*_known(), *_CONTENT, "bucket", F.lit(None).cast("long").alias("employee_key"), F.lit(1).alias("order")))
        content = F.struct(*_CONTENT)
        merged = both.groupBy(*_known(), "bucket").agg(
            F.max(F.struct("order", content.alias("content"))).alias("last"), F.max("employee_key").alias("employee_key"),
        ).select(*_known(), "bucket", "employee_key", "last.content.*")
        per_person = merged.groupBy("employee_id").agg(
            F.max(F.when(~F.col("present"), F.col("starts"))).alias("latest"), F.bool_or("present").alias("named"),
            F.max(F.when(F.col("present"), F.struct(*_IDENTITY))).alias("who"))
        # a stored side is broadcast or the rows of a hot key are divided
        per_person = materialize(per_person.withColumnRenamed("employee_id", "person"), "people")
        whole = merged.drop(*_IDENTITY).join(per_person, F.col("employee_id") == F.col("person")).select(
            *_known(), "bucket", "employee_key", "named", "role", "level", "salary", "starts", "change_reason",
            *[F.col("who")[name].alias(name) for name in _IDENTITY],
            F.when(F.col("present"), F.coalesce(F.date_add("latest", 1), "starts")).otherwise(F.col("starts")).alias("valid_from"))
        rows = ordering.ordered(whole, "employee_id", "valid_from", "present", "salary", "source_key")
        fresh = F.when(F.col("named") & F.col("employee_key").isNull(), 1).otherwise(0).cast("bigint")
        # rows dealt by range for the numbers stay where they are for the neighbours within an employee
        closed = ordering.following(_numbered(rows, fresh, "fresh"), ["employee_id"], "valid_from", "next_from")
        keyed = closed.withColumns({
            "employee_key": F.coalesce("employee_key", F.when(F.col("named"), F.col("fresh") + last_key)),
            "valid_to": F.coalesce("next_from", F.lit(temporal.END_OF_TIME).cast("date")),
            "is_current": F.col("next_from").isNull(),
        })
        # the sorted rows are stored, so the folders that are overwritten are not read any more
        keyed.select(*_STORED.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def dimension(self, domain: str = DEFAULT_DOMAIN) -> DataFrame:
        """The dimension under its contract."""
        rows = self._stored().where(F.col("employee_key").isNotNull())
        experience = exprs.zero_if_null(F.col("years_experience"), "int")

        def filled(name: str, default: str) -> F.Column:
            return F.when(F.col("present"), F.col(name)).otherwise(F.coalesce(name, F.lit(default)))

        return enforce_schema(rows.withColumns({
            "full_name": filled("full_name", "Staff Member"), "email": filled("email", f"unknown@{domain}"),
            "region": filled("region", "Abu Dhabi"),
            "years_experience": F.when(F.col("present"), F.abs(experience)).otherwise(experience),
        }), schemas.DIM_EMPLOYEE)

    def keys(self) -> DataFrame:
        """(employee_id, present, source_key, employee_key): the natural key of every version and its surrogate key."""
        return self._stored().where(F.col("employee_key").isNotNull()).select(*_known(), "employee_key")


def _known() -> list[str]:
    return ["employee_id", "present", "source_key"]


def _numbered(rows: DataFrame, counted: F.Column, name: str) -> DataFrame:
    """Running count along an order, over everything: sums within each range and those of the ranges before it."""
    valued = rows.withColumn("_one", counted)
    sizes = valued.groupBy(ordering.PART).agg(F.sum("_one").alias("_size"))
    before = Window.orderBy(ordering.PART).rowsBetween(Window.unboundedPreceding, -1)
    # one row per sorted range
    starts = sizes.select(ordering.PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(ordering.PART).orderBy(ordering.POSITION).rowsBetween(Window.unboundedPreceding, 0)
    return valued.withColumn(name, F.sum("_one").over(within)).join(F.broadcast(starts), ordering.PART).withColumn(
        name, F.col(name) + F.col("_start")).drop("_one", "_start")
