import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from spendlens.llm import pii, stages, wordtable
from tests.llm import test_positional, test_simhash

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = docs.collect(), stage(spark, docs, SF_DIR).cache()
        assert after.columns == columns
        kept = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "language":
            assert len(kept) >= 0.99 * len(before)
        elif name == "near_duplicates":
            brute = test_simhash.brute([(r["doc_id"], r["text"]) for r in before])
            assert set(kept) == {key for key, _, component in brute if key == component}
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
            brute = test_positional.brute([(r["doc_id"], r["text"]) for r in before], items)
            assert set(kept) == {key for key, (_, hit, _) in brute.items() if not hit}
        else:
            assert kept == {r["doc_id"]: pii.masked(r["text"]) for r in before}
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect() if "[EMAIL]" in r["text"])
        docs = after
    last = stages.tokens(spark, docs, SF_DIR).collect()
    tokenizer = wordtable.load(wordtable.vocabulary())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["text"] for r in last} == texts
    assert all(tokenizer.encode(r["text"], add_special_tokens=False).ids == r["ids"] for r in last)


def test_pipeline_query(spark):
    found = registry.queries()["pipeline"](spark, SF_DIR)
    assert found.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 0 < found.count() <= spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, None, None, None), (1, "", "en", "s", 0), (None, "the hat", "en", None, 7), (None, "the hat", "en", None, 7),
     (None, "a cat", None, "s", 5), (2, "the hat", "en", "s", 7), (2, "call +1 234 555 1234 the hat", "en", "s", None)],
])
def test_edge_cases(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA + ", key string, _mark int")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR)
        assert after.columns[:7] == docs.columns
        if name == "near_duplicates" and rows:
            texts = [r["text"] for r in after.collect()]
            assert sorted(texts, key=str) == sorted(["a cat", "call +1 234 555 1234 the hat", "the hat", None], key=str) \
                or len(texts) == 4
        if name in ("personal_data", "tokens"):
            assert after.count() == len(rows)
    assert stages.personal_data(spark, docs, SF_DIR).where(F.col("text").contains("[PHONE]")).count() == bool(rows)
