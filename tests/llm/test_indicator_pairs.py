"""The pairs (text, feature) of many texts."""

import numpy as np
import pytest

from tessera.llm import linear, quality

TEXTS = [None, "", "one word", *(f"word{i % 37} again word{i % 5} again" for i in range(450)), None]


@pytest.mark.parametrize("extra", [(), (quality.runs, quality.N_RUNS)])
def test_pairs_are_found_once_and_in_order_without_a_table_of_all_pairs(monkeypatch, extra):
    chosen = np.arange(0, 1 << linear.HASH_BITS, 2)
    want = []
    for i, t in enumerate(TEXTS):
        doc, feature = linear.Indicators(quality.words, chosen, *extra).of([t])
        assert not doc.any() and (np.diff(feature) > 0).all()
        want += [(i, f) for f in feature.tolist()]

    def never(*_, **__):
        raise AssertionError("np.unique puts every pair into a table of nodes")

    monkeypatch.setattr(np, "unique", never)
    doc, feature = linear.Indicators(quality.words, chosen, *extra).of(TEXTS)
    assert list(zip(doc.tolist(), feature.tolist())) == want
    doc, feature = linear.Indicators(quality.words, chosen, *extra).of([])
    assert not len(doc) and not len(feature)


def test_distinct_is_sorted_and_complete():
    rng = np.random.default_rng(1)
    for keys in (np.empty(0, np.int64), np.array([5]), rng.integers(-50, 50, 1_000), np.full(9, 2)):
        assert linear.distinct(keys).tolist() == sorted(set(keys.tolist()))
