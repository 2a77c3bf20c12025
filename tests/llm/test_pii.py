import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from spendlens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def checked(kind, m):
        digits = re.sub("[^0-9]", "", m[0])
        if kind == "ip":
            return all(int(p) <= 255 for p in m[0].split("."))
        if kind == "card":
            doubled = [sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(kind, *m.span()) for kind, pattern in zip(pii.KINDS, (EMAIL, IP, CARD, PHONE))
            for m in pattern.finditer(text) if checked(kind, m)]


@settings(max_examples=2000, deadline=None)
@given(st.text(st.sampled_from("a@.-1 2+5(é"), max_size=40))
def test_plain_spans(text):
    assert pii.plain(text) == brute(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "1.2.3.4", "999.1.1.1", "a@b.c", "x@@y.z", "+1 (234) 555-1234", "+", "4", "-", " ", "é"])))
def test_plain_spans_of_identifiers(parts):
    text = "".join(parts)
    assert pii.plain(text) == brute(text)


@pytest.mark.parametrize(("text", "kind", "part"), [
    ("mail jane (at) site (dot) org now", "email", "jane (at) site (dot) org"),
    ("mail jane[at]site[dot]org now", "email", "jane[at]site[dot]org"),
    ("mail jane at site dot org now", "email", "jane at site dot org"),
    ("mail jane at mail dot site dot org now", "email", "jane at mail dot site dot org"),
    ("é mail jane＠site．org now", "email", "jane＠site．org"),
    ("mail jаne@site.оrg now", "email", "jаne@site.оrg"),
    ("mail ja​ne@si​te.org now", "email", "ja​ne@si​te.org"),
    ("jane@site dot org", "email", "jane@site dot org"),
    ("call plus one two three four five six seven eight nine now", "phone",
     "plus one two three four five six seven eight nine"),
    ("call ＋１ ２３４ ５５５ １２３４ now", "phone", "＋１ ２３４ ５５５ １２３４"),
    ("pay " + " ".join("four one one one one one one one one one one one one one one one".split()) + " now", "card",
     " ".join("four one one one one one one one one one one one one one one one".split())),
    ("host one two dot one dot three dot four now", "ip", "one two dot one dot three dot four"),
    ("host １２.1.３.4 now", "ip", "１２.1.３.4"),
])
def test_disguises(text, kind, part):
    base, added = pii.spans(text)
    start = text.index(part)
    assert (kind, start, start + len(part)) in added, added


@pytest.mark.parametrize("text", [
    "we looked at it and put a dot there", "one two three of them", "the cat (at home) sat", "Über die Straße, déjà vu",
    "at nine dot five", "plus one", "no one at all. Dot com", "", "a@b", "1.2.3", "four five six seven",
])
def test_clean_texts_stay_clean(text):
    assert pii.spans(text) == ([], [])
    assert pii.masked(text) == text


def test_base_spans_stay():
    text = "jane@site.org or jane (at) site (dot) org"
    assert pii.spans(text) == ([("email", 0, 13)], [("email", 17, len(text))])
    assert pii.masked(text) == "[EMAIL] or [EMAIL]"


def test_tables(spark):
    rows = [(1, None), (2, ""), (3, "a@b.c 1.2.3.4"), (3, "x"), (None, "+1 234 555 1234"), (7, "é " * 50_000 + "a@b.c"), (8, "9" * 5000)]
    docs = spark.createDataFrame([(k, t, "s", "n") for k, t in rows], "doc_id long, text string, spans string, kind string")
    found = pii.find(docs).collect()
    assert [len(r["spans"]) for r in found] == [0, 0, 2, 0, 1, 1, 0]
    assert (found[5]["spans"][0]["start"], found[5]["spans"][0]["end"]) == (100_000, 100_005)
    assert pii.find(docs.limit(0)).collect() == []
    cleaned = pii.mask(docs).collect()
    assert [r["text"] for r in cleaned[:5]] == [None, "", "[EMAIL] [IP]", "x", "[PHONE]"]
    assert cleaned[0]["kind"] == "n"


def test_query(spark, tmp_path):
    docs = spark.createDataFrame([(1, "1.2.3.4 a@b.c jane (at) site (dot) org"), (2, None)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    one, two = sorted(pii.op4(spark, str(tmp_path)).collect())
    assert one["spans"] == "email:8:13,email:14:38,ip:0:7"
    assert one["base_sha256"] == hashlib.sha256(b"email:8:13,ip:0:7").hexdigest()
    assert (one["n_email"], one["n_ip"], one["n_disguised"]) == (1, 1, 1)
    assert two["base_sha256"] == hashlib.sha256(b"").hexdigest()
