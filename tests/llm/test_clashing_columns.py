"""Columns beside the operators' own change no result, whatever their names."""

import pytest
from pyspark.sql import functions as F
from spendlens.llm import langid, positional, simhash, suffixes, suffixtree, topk, wordtable

TEXTS = ["the house and the water of the house", "das Haus und das Wasser des Hauses", "the house and the water of the house again and again", None, "",
         "la maison et l'eau de la maison", "x" * 300, "x" * 300 + "y"] * 2
NAMES = ["key", "id", "v", "dim", "q", "c", "doc", "mark", "low", "high", "bucket", "whole", "fate", "runs", "block", "names", "codes", "sizes", "train",
         "keys", "owner", "payload", "round", "words", "positions", "terms", "item", "n", "n_words", "a", "b", "node", "component", "fp", "rank", "score", "value",
         "start", "end", "ids", "pack", "label", "name", "doc_", "mark_", "count"]


def documents(spark):
    rows = [(i, t, ["en", "de", "fr"][i % 3]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def clashing(df):
    for i, name in enumerate(n for n in NAMES if n not in df.columns):
        df = df.withColumn(name, F.lit(i) if i % 2 else F.lit("x"))
    return df


def passages(spark):
    return spark.createDataFrame([("i", "the water of the house"), ("j", None)], "item_id string, text string")


OPERATORS = {
    "op1": lambda spark, change: topk.top_k(*[topk.whole_numbers(change(spark.createDataFrame(
        [(i, [float(i % 3), 1.0]) for i in range(12)], "vec_id long, embedding array<double>")), "vec_id", "embedding", 256)] * 2, 2),
    "op2": lambda spark, change: suffixtree.scores(change(documents(spark)), F.col("doc_id") % 3 < 2),
    "op3": lambda spark, change: langid.predict(change(documents(spark)), langid.fit(change(documents(spark)))),
    "op7": lambda spark, change: simhash.near_duplicates(change(documents(spark))),
    "op8": lambda spark, change: positional.hits(positional.contamination(change(documents(spark)), change(passages(spark)))),
    "op9": lambda spark, change: wordtable.encode(change(documents(spark))),
    "op10": lambda spark, change: suffixes.deduplicate(change(documents(spark))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_change_nothing(spark, name):
    plain, other = (OPERATORS[name](spark, change) for change in (lambda df: df, clashing))
    assert plain.columns == other.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, other.collect()))
