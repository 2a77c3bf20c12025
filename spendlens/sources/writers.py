"""Sinks, table contracts and output verification."""

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


def enforce_schema(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Columns of the contract in its order and types, with defaults for nulls.

    A column the input lacks is taken from ``defaults`` or is null; a required one must exist.
    """
    defaults = defaults or {}

    def column(field: T.StructField) -> Column:
        if field.name in df.columns:
            value = F.col(field.name)
            if df.schema[field.name].dataType != field.dataType:
                value = value.cast(field.dataType)
            if field.name in defaults:
                value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        elif field.name in defaults or field.nullable:
            value = F.lit(defaults.get(field.name)).cast(field.dataType)
        else:
            raise ValueError(f"required column {field.name!r} is missing")
        return value.alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def contract_violations(df: DataFrame, schema: T.StructType, unique: Sequence[str] = ()) -> DataFrame:
    """(column_name, rule, row_count): missing values of required columns, and rows that repeat a unique value.

    All required columns are counted in one pass; a unique column costs one aggregation over itself.
    """
    required = [field.name for field in schema.fields if not field.nullable]
    lacking = [F.count_if(F.col(name).isNull()) if name in df.columns else F.count("*") for name in required]
    counted = df.agg(*[n.alias(name) for n, name in zip(lacking, required)])
    found = counted.unpivot([], required, "column_name", "row_count").select(
        "column_name", F.lit("NOT NULL").alias("rule"), "row_count")
    for name in unique:
        copies = df.where(F.col(name).isNotNull()).groupBy(name).agg((F.count("*") - 1).alias("n"))
        total = F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")
        found = found.unionByName(copies.agg(total).select(F.lit(name).alias("column_name"), F.lit("UNIQUE").alias("rule"), "row_count"))
    return found


# text is five to six times smaller so, for hardly any time; a compressed file is read by one task, so none grows with the table
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def write_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """Directory of CSV files with a header, gzipped if ``packed``; text keeps its surrounding blanks."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"').options(**(PACKED if packed else {}))
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    """Directory of gzipped files of JSON lines."""
    df.write.options(**PACKED).json(path)


ARRAY_OBJECTS = 10_000  # objects in one JSON array of a file of several


def write_json_arrays(df: DataFrame, path: str, size: int = ARRAY_OBJECTS) -> None:
    """Directory of files of indented JSON arrays, several to a file, of at most ``size`` objects each; no task holds more than a batch."""
    def brackets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                objects = batch.column(0).slice(start, size)
                n = len(objects)
                before = pa.array(["[ "] + [", "] * (n - 1), objects.type)
                after = pa.array([""] * (n - 1) + ["\n]"], objects.type)
                lines = pc.binary_join_element_wise(before, objects, after, pa.scalar("", objects.type))
                yield pa.RecordBatch.from_arrays([lines], names=["value"])

    objects = df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value"))
    objects.mapInArrow(brackets, "value string").write.text(path)


def write_parquet(df: DataFrame, path: str, partition_cols: Sequence[str] = (), single_file: bool = False) -> None:
    """Overwrite ``path``. Partitioned output is shuffled by its partition columns, with rows of
    a large partition spread over several files, and ``single_file`` is for small results."""
    if single_file:
        df = df.coalesce(1)
    elif partition_cols:
        # REBALANCE lets AQE split a partition value that holds most of the rows
        df = df.hint("rebalance", *[F.col(name) for name in partition_cols])
    writer = df.write.mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def write_lines(spark: SparkSession, lines: Sequence[str], path: str) -> None:
    """A short report as one text file."""
    rows = spark.createDataFrame([(line,) for line in lines], "value string")
    rows.coalesce(1).write.mode("overwrite").text(path)


def table_digest(df: DataFrame) -> list[Column]:
    """Rows, and the sum of their hashes: the same for any order and any cut into files."""
    def hashable(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column

    values = [hashable(field) for field in df.schema.fields]
    # nulls are left out of a hash, so their places are hashed as well
    places = F.concat_ws(",", *[F.isnull(value).cast("string") for value in values])
    return [F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*values, places).cast("decimal(38,0)")), F.lit(0)).alias("digest")]


def write_verified(df: DataFrame, path: str, mode: str = "overwrite") -> dict[str, object]:
    """Write a Parquet table, take its digest on the way, and raise unless what can be read back has the same."""
    observed = Observation()
    df.observe(observed, *table_digest(df)).write.mode(mode).parquet(path)
    wanted = {name: observed.get[name] for name in ("rows", "digest")}
    check_digest(df.sparkSession.read.schema(df.schema).parquet(path), wanted, path)
    return wanted


def check_digest(df: DataFrame, wanted: Mapping[str, object], path: str) -> None:
    found = df.agg(*table_digest(df)).first().asDict()
    if any(int(found[name]) != int(wanted[name]) for name in ("rows", "digest")):
        raise ValueError(f"{path} holds {found['rows']} rows of digest {found['digest']}, {wanted['rows']} of {wanted['digest']} were written")


def verify_output(spark: SparkSession, path: str, file_format: str = "parquet") -> None:
    """Raise unless ``path`` can be read and holds at least one row."""
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True)
    if reader.load(path).isEmpty():
        raise ValueError(f"output is empty: {path}")
