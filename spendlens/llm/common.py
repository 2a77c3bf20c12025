"""Tables, stored intermediate results and connected components for the operators of this subpackage."""

import gc

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendlens.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries whose results are stored: it does so once they are garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def in_fold(key: F.Column | str, modulus: int, remainder: int) -> F.Column:
    """Whether crc32 of the key as text leaves this remainder; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node for every node of ``edges(a, b)``: (node, component).

    Alternating large and small stars: every round hangs the larger neighbours of a node, then the
    smaller ones, below the smallest neighbour, until all components are stars. Each round is a stored
    table, and the rounds are logarithmic in the longest chain.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = store(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # every neighbour above a node moves to the smallest of its neighbourhood
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store(large, "large-star")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        hung = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = store(small.select("a", F.col("m").alias("b")).unionByName(hung).distinct(), "small-star")
        # done when every node has one parent and no parent has one
        left = hung.join(hung.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        if not left and hung.count() == hung.select("a").distinct().count():
            roots = hung.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return hung.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        links = hung
