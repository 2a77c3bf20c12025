"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns what stays of the documents.

All columns of ``docs`` come back, in their order. Decisions are taken per row: rows of equal or null doc_id are
told apart by their texts, and rows equal in both share a decision.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendlens.llm import langid, pii, positional, simhash, wordtable
from spendlens.llm.common import in_fold, table


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column that stands for doc_id and text: a digest of 256 bits of both, with nulls told from empty texts."""
    mark = _unused(docs, "_mark")
    parts = [F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(c).cast("string"))) for c in ("doc_id", "text")]
    return docs.withColumn(mark, F.sha2(F.concat(parts[0], F.lit("\x00"), parts[1]), 256)), mark


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; the classifier learns from the same fold as its query."""
    learned = docs.where(~in_fold("doc_id", 4, 2))
    return langid.recognised(docs, langid.fit(learned))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    A missing doc_id comes after all others. Of rows equal in doc_id and text one stays.
    """
    marked, mark = _marked(docs)
    name = _unused(marked, "_name")
    marked = marked.withColumn(name, F.struct(
        F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(mark).alias("mark")))
    found = simhash.near_duplicates(marked, name)
    first = found.where("key <=> component").select(F.col("key.mark").alias(mark)).distinct()
    return marked.join(first, mark, "left_semi").dropDuplicates([mark]).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    marked, mark = _marked(docs)
    found = positional.contamination(marked, table(spark, sf_dir, "benchmark"), mark)
    hit = found.where(F.size("matches") > 0).select(F.col("key").alias(mark)).distinct()
    return marked.join(hit, mark, "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers give way to their kind in brackets; n_chars follows the new text. Every document stays."""
    return pii.mask(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids and n_tokens; the text is what the ids decode to, and empty where it was null.

    A column of the documents with one of these two names gives way.
    """
    others = [c for c in docs.columns if c not in ("text", "ids", "n_tokens")]
    rows = docs.select(F.struct(*others).alias("key"), "text")
    encoded = wordtable.encode(rows, "key", view=wordtable.both_view)
    columns = [F.col("text") if c == "text" else F.col(f"key.`{c}`") for c in docs.columns if c not in ("ids", "n_tokens")]
    return encoded.select(*columns, "ids", F.size("ids").cast("long").alias("n_tokens"))
