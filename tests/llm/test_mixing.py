"""Mixing: exact shares where documents suffice, caps, dirty rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnlake.llm import mixing
from cairnlake.llm.mixing import fill, fit, mixed, shares


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 1000), st.floats(0.01, 5)), min_size=1, max_size=8), st.integers(1, 4), st.floats(0.01, 0.99))
def test_filling_meets_what_it_can(cells, cap, part):
    tokens, weights = (np.array(c, float) for c in zip(*cells))
    wanted = part * cap * tokens.sum()
    w = fill(tokens, weights, cap, wanted)
    assert (w <= cap + 1e-9).all() and abs((w * tokens).sum() - wanted) < 1e-6 * max(1, wanted)
    assert (fill(tokens, weights, cap, 2 * cap * tokens.sum()) == cap).all()


def test_raking_keeps_languages_near_their_shares():
    tokens = np.array([100.0, 300, 200, 400])
    source, lang = np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])
    got = fit(tokens, source, [lang], np.array([0.5, 0.5]), np.array([2.0, 2.0]), 0.1)
    took = tokens * got.weights
    assert abs(took[:2].sum() - took[2:].sum()) < 1e-6 * got.total and (got.weights <= 2 + 1e-9).all()
    assert abs(took[[0, 2]].sum() / took.sum() - 0.3) < 0.02


@pytest.fixture(scope="module")
def frames(spark):
    docs = [(i, " Big " if i % 3 else "small", "en" if i % 2 else None, None if i % 5 else "t", 50 + i % 17) for i in range(600)]
    docs += [(10_000, None, "en", "t", 5), (10_001, "other", "en", "t", 5), (10_002, "big", "en", "t", 0), (10_003, "tiny", "en", "t", 40), docs[0]]
    sized = spark.createDataFrame(docs, "doc_id long, source string, lang string, topic string, tokens long").withColumnRenamed("x", "weight")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.45, 2), ("gone", 0.05, 3)], "source string, target_share double, max_repeats int")
    return sized, targets


def test_mix(frames):
    sized, targets = frames
    mix = mixed(sized, targets)
    rows = mix.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(1 <= r.repeats <= 2 and r.doc_id < 600 for r in rows)
    got = {r.source: r for r in shares(mix, sized, targets).collect()}
    assert abs(got["big"].share / got["small"].share - 0.5 / 0.45) < 0.02
    assert got["gone"].tokens_taken == 0 and got["gone"].short and not got["big"].short


def test_empty(frames):
    sized, targets = frames
    assert mixed(sized.limit(0), targets).count() == 0 and mixed(sized, targets.limit(0)).count() == 0
    assert shares(mixed(sized.limit(0), targets), sized.limit(0), targets).count() == 3


def test_too_many_cells_are_refused(frames, monkeypatch):
    sized, targets = frames
    monkeypatch.setattr(mixing, "MOST_CELLS", 2)
    with pytest.raises(ValueError, match="targets"):
        mixed(sized, targets)
    monkeypatch.setattr(mixing, "MOST_CELLS", 3)
    with pytest.raises(ValueError, match="cells"):
        mixed(sized, targets)
