"""De-duplication, distinct pairs and insert-if-absent."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def tie_break(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """Order over the remaining columns, so that keeping one row of many is repeatable.

    Maps have no order; they are compared as sorted entries, and columns that hold maps inside as text.
    """
    def comparable(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType):
            return F.to_json(F.array_sort(F.map_entries(column)))
        if "map<" in field.dataType.simpleString():
            return F.to_json(F.struct(column))
        return column

    return [comparable(field) for field in df.schema.fields if field.name not in skip]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """First row per key along ``order``.

    Spark limits each group to one row before the shuffle (``WindowGroupLimit``), so many
    copies of one key travel as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(name) for name in order], *tie_break(df, [*keys, *order])
    )
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).where(F.col(count_name) > 1)


def unique_by(rows: DataFrame, key: str) -> DataFrame:
    """First row per key of a stored table. The rows move only if some key really repeats;
    a unique key costs one pass over its column, of which only hashes move."""
    if duplicate_keys(rows.select(F.xxhash64(key).alias("_hash")), ["_hash"]).isEmpty():
        return rows
    return rows if duplicate_keys(rows, [key]).isEmpty() else keep_first(rows, [key])


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the rows of ``new`` whose key is not yet there; the first of equal keys wins."""
    known = existing.select(*keys)
    fresh = keep_first(new, keys).join(known, list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))
