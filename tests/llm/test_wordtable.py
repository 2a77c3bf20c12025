import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from spendlens.llm import wordtable

ODD = [
    "", None, " ", "a", " a", "a ", "a b", "a  b", "a   b", "a \nb", "a\n b", "a\n \nb", "a\n\n b c", "\n", "\t\t x", "x \t y",
    "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>", "it's we'll ' s", "é à  ü x  y", "\x1c a \x1f\x1e b",
    "日本 語 text", "🙂 🙂🙂", "1 23 456  7", "%%% a*** b", "x" * 3000, "ab " * 3000, "a  b", "a \u0085 b", "　 a b",
]


TOKENIZER = wordtable.load(wordtable.vocabulary())


def expected(text):
    tokenizer = TOKENIZER
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("block", [1, 500, wordtable.BLOCK])
def test_matches_the_tokenizer(spark, block):
    docs = spark.createDataFrame(list(enumerate(ODD)) + [(3, "again"), (None, "no key")], "doc_id long, text string")
    encoded = wordtable.encode(docs, block=block)
    texts = {**dict(enumerate(ODD))}
    rows = [r for r in encoded.collect() if r["key"] not in (3, None)]
    assert {r["key"]: r["ids"] for r in rows} == {k: expected(t)[0] for k, t in texts.items() if k != 3}
    decoded = {r["key"]: r["text"] for r in wordtable.decode(encoded).collect()}
    assert all(decoded[k] == expected(t)[1] for k, t in texts.items() if k != 3)
    found = wordtable.encode(docs, block=block, view=wordtable.digest_view).collect()
    assert sorted(found, key=str) == sorted(wordtable.decode(encoded, view=wordtable.digest_view).collect(), key=str)
    assert len(found) == len(ODD) + 2
    for r in found:
        if r["key"] not in (3, None):
            ids, text = expected(texts[r["key"]])
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
                len(ids), digest(",".join(map(str, ids))), digest(text))


def test_empty_table(spark):
    assert wordtable.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'1. \n\t  é%"), max_size=30))
def test_words_keep_the_pieces(text):
    block = wordtable._Block()
    block.add(text)
    words = [block.words[i] for i in block.codes[0]]
    assert "".join(words) == text
    ids = [i for w in words for i in expected(w)[0]]
    assert ids == expected(text)[0]
