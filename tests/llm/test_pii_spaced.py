import pytest
from spendlens.llm import pii


@pytest.mark.parametrize(("text", "part"), [
    ("ask john dot doe at example dot com now", "john dot doe at example dot com"),
    ("ask j dot r dot doe at mail dot example dot com", "j dot r dot doe at mail dot example dot com"),
    ("ask john dot doe (at) example (dot) com now", "john dot doe (at) example (dot) com"),
    ("ask john dot doe (at) example dot com now", "john dot doe (at) example dot com"),
    ("ask jane at example [dot] com now", "jane at example [dot] com"),
    ("ask john.doe at example.com now", "john.doe at example.com"),
    ("ask John dot Doe At example.com now", "John dot Doe At example.com"),
    ("mail jane at example.com now", "jane at example.com"),
])
def test_whole_addresses(text, part):
    start = text.index(part)
    assert pii.spans(text) == ([], [("email", start, start + len(part))])
    assert pii.masked(text) == text.replace(part, "[EMAIL]")


@pytest.mark.parametrize("text", [
    "we met at example.com today", "version 3.5 at example.com", "put a dot there at home", "she was at home.then", "dot dot dot at it", " at ",
])
def test_prose_stays(text):
    assert pii.spans(text) == ([], [])


def test_chains_take_linear_time():
    assert pii.spans("a dot " * 30_000) == ([], [])
    assert pii.spans("a at " * 30_000) == ([], [])
