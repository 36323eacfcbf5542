"""Batched longest common subsequences and ROUGE-L against the full table."""

import random
import tracemalloc

import numpy as np
import pytest

from loomgraph.operators import lcs
from loomgraph.operators import rouge as rg


def table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t


def positions(a, b):
    t, out, i, j = table(a, b), [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif t[i - 1][j] >= t[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def test_against_full_table():
    rng = random.Random(2)
    pairs = [([rng.randrange(k) for _ in range(rng.randrange(40))], [rng.randrange(k) for _ in range(rng.randrange(60))])
             for k in (1, 2, 5, 30) for _ in range(40)]
    a, b = [np.array(x, np.int64) for x, _ in pairs], [np.array(y, np.int64) for _, y in pairs]
    assert lcs.lcs_lengths(a, b).tolist() == [table(x, y)[-1][-1] for x, y in pairs]
    assert [lcs.lcs_positions(x, y).tolist() for x, y in zip(a, b)] == [positions(x, y) for x, y in pairs]
    assert lcs.lcs_lengths([], []).tolist() == []


def test_batches_of_any_size(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = ([rng.integers(0, 4, rng.integers(0, 30)) for _ in range(50)] for _ in range(2))
    whole = lcs.lcs_lengths(a, b).tolist()
    monkeypatch.setattr(lcs, "CELLS", 40)
    assert lcs.lcs_lengths(a, b).tolist() == whole


def test_long_pair_in_bounded_memory():
    rng = np.random.default_rng(0)
    words = np.array([f"w{i}" for i in range(50)])
    pred, ref = (" ".join(words[rng.integers(0, 50, 20_000)]) for _ in range(2))
    tracemalloc.start()
    flat = rg.rouge_lsum_pair(pred, ref)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    assert flat == rg.rouge_l_rows([pred], [ref])[0] == rg.rouge_lsum_rows([pred], [ref])[0]


def test_summary_level_by_lines():
    # union of two lines' hits, clipped by the prediction's counts
    assert rg.rouge_lsum_pair("a b\nc d", "a c\nb d") == pytest.approx((1.0, 1.0, 1.0))
    assert rg.rouge_lsum_pair("a\na", "a a a") == pytest.approx((0.5, 1 / 3, 0.4))
    assert rg.rouge_lsum_rows(["", "x\ny", "the cat sat"], ["", "", "the cat ran home"])[2][2] == pytest.approx(0.571429, abs=1e-6)
