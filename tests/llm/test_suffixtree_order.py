"""Pairs of op2 are put in order by plain sorts, also where numbers would not fit."""

import numpy as np

from spendlens.llm import suffixtree


def test_places_come_in_order_of_key():
    keys = np.random.default_rng(5).integers(0, 40, 500)
    for big in (0, 1 << 61):
        assert np.array_equal(suffixtree._ordered(keys + big), np.argsort(keys, kind="stable"))
    assert len(suffixtree._ordered(np.zeros(0, np.int64))) == 0


def test_pairs_come_by_context_and_symbol():
    rng = np.random.default_rng(7)
    context = rng.integers(0, 9, 400).astype(np.uint64) * np.uint64(0x1C71C71C71C71C71)
    for top in (30, 1 << 62):
        symbol = rng.integers(0, top, 400).astype(np.uint64)
        order, wanted = suffixtree._by_context(context, symbol), np.lexsort((symbol, context))
        assert np.array_equal(context[order], context[wanted]) and np.array_equal(symbol[order], symbol[wanted])
