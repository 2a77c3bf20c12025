"""Closed-open validity intervals: versions, point-in-time lookup, overlaps."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from spendlens.operators import lookups, ordering

END_OF_TIME = "9999-12-31"


def point_in_time(
    probes: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    version_key: str,
    value: str,
    along: Sequence[str] = (),
) -> DataFrame:
    """For each distinct (key, day) of ``probes`` the version valid on that day, and for each value of the columns ``along`` beside them.

    A version is valid on ``valid_from <= day < valid_to``. Probes are reduced to distinct days
    and versions to one per key and start day, so a key never has more rows on either side than
    there are calendar days, whatever its share of the input. Where versions overlap the one
    that started last is taken, which keeps the result at one row per (key, day).
    """
    asked = probes.select(*along, F.col(key).alias("_key"), F.col(day).alias("_day")).where(
        F.col("_key").isNotNull() & F.col("_day").isNotNull()
    )
    # the days of a key are moved as one array, of at most as many as the calendar has
    days = (
        asked.groupBy(*along, "_key").agg(F.collect_set("_day").alias("_days")).repartition("_key")
        .select(*along, "_key", F.explode("_days").alias("_day"))
    )
    spans = (
        # moved once, for the aggregation and for the join
        versions.where(F.col("valid_from") < F.col("valid_to")).repartition(version_key)
        .groupBy(F.col(version_key).alias("_version_key"), F.col("valid_from").alias("_from"))
        .agg(
            F.max("valid_to").alias("_to"),
            F.max_by(F.col(value), F.struct("valid_to", value)).alias(value),
        )
    )
    valid = (
        (F.col("_key") == F.col("_version_key"))
        & (F.col("_day") >= F.col("_from"))
        & (F.col("_day") < F.col("_to"))
    )
    return (
        days.join(spans, valid)
        .groupBy(*along, "_key", "_day")
        .agg(F.max_by(value, "_from").alias(value))
        .withColumnsRenamed({"_key": key, "_day": day})
    )


def as_of(
    probes: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    version_key: str,
    value: str,
) -> DataFrame:
    """For each distinct (key, day) of ``probes`` the version valid on that day, by one merge of both sides.

    Probes and versions are sorted together by key and day, and every probe takes the last version started before it, if that still holds.
    No version meets more than its own place in the order, so a key with any number of days and versions is spread over
    the ranges of the sort. Versions of a key must not overlap, as those of a Type 2 dimension; see :func:`point_in_time` for others.
    """
    days = probes.select(F.col(key).alias("_key"), F.col(day).alias("_day")).where(
        F.col("_key").isNotNull() & F.col("_day").isNotNull()
    ).distinct().withColumns({"_probe": F.lit(True), "_version": F.lit(None).cast(_version_type(versions, value))})
    starts = versions.where(F.col("valid_from") < F.col("valid_to")).select(
        F.col(version_key).alias("_key"), F.col("valid_from").alias("_day"), F.lit(False).alias("_probe"),
        F.struct(F.col("valid_to").alias("to"), F.col(value).alias("value")).alias("_version"))
    # a version holds from its first day on, so it comes before the probes of that day
    rows = ordering.ordered(days.unionByName(starts), "_key", "_day", "_probe", "_version")
    found = ordering.last_known(rows, ["_key"], F.col("_version"), "_last").where("_probe")
    holds = F.col("_day") < F.col("_last.to")
    return found.where(holds).select(F.col("_key").alias(key), F.col("_day").alias(day), F.col("_last.value").alias(value))


def _version_type(versions: DataFrame, value: str) -> T.StructType:
    return T.StructType([T.StructField("to", versions.schema["valid_to"].dataType), T.StructField("value", versions.schema[value].dataType)])


def temporal_left_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    version_key: str,
    value: str,
) -> DataFrame:
    """Add the value valid on the row's day; null where no version covers it."""
    return lookups.spread_join(facts, point_in_time(facts, versions, key, day, version_key, value), [key, day])


def overlaps(versions: DataFrame, key: str, version_key: str) -> DataFrame:
    """Pairs of versions of one key whose intervals overlap.

    Sorted by start, the versions that overlap a later one form a run behind it. The length of
    that run is a difference of two running counts, so only overlapping pairs are ever built.
    """
    base = versions.select(
        F.col(key).alias("k"), F.col(version_key).alias("v"),
        F.col("valid_from").alias("f"), F.col("valid_to").alias("t"),
    )
    starts = base.select("k", F.col("f").alias("d"), F.lit(1).alias("is_start"), "v", "f", "t")
    ends = base.select("k", F.col("t").alias("d"), F.lit(0).alias("is_start"), "v", "f", "t")
    # an end sorts before the starts of its day: touching intervals do not overlap
    counted = ordering.cumulate(
        starts.unionByName(ends), ["k"], ["d", "is_start", "v"], F.col("is_start").cast("bigint"),
        "started",
    )

    numbered = counted.where("is_start = 1").select("k", "v", "f", "t", F.col("started").alias("n"))
    reach = counted.where("is_start = 0").select("k", "v", F.col("started").alias("last"))
    runs = numbered.join(reach, ["k", "v"]).where("last > n")
    # two explodes keep each generated array small even for a very long run
    step = 10_000
    pairs = (
        runs.withColumn("lo", F.explode(F.sequence(F.col("n") + 1, F.col("last"), F.lit(step).cast("bigint"))))
        .withColumn("m", F.explode(F.sequence("lo", F.least(F.col("lo") + step - 1, F.col("last")))))
        .select("k", "m", F.col("v").alias("v1"), F.col("f").alias("f1"), F.col("t").alias("t1"))
    )
    other = numbered.select(
        "k", F.col("n").alias("m"), F.col("v").alias("v2"), F.col("f").alias("f2"), F.col("t").alias("t2")
    )
    both = pairs.join(other, ["k", "m"]).where(
        (F.col("f1") < F.col("t2")) & (F.col("t1") > F.col("f2"))
    )
    in_order = F.col("v1") < F.col("v2")

    def side(first: str, second: str, name: str):
        return F.when(in_order, F.col(first)).otherwise(F.col(second)).alias(name)

    return both.select(
        F.col("k").alias(key),
        side("v1", "v2", "ver_1_key"), side("v2", "v1", "ver_2_key"),
        side("f1", "f2", "ver_1_from"), side("t1", "t2", "ver_1_to"),
        side("f2", "f1", "ver_2_from"), side("t2", "t1", "ver_2_to"),
    )
