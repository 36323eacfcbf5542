"""Packed sparse blocks: alike rows share a block, single precision never decides a rank."""

import numpy as np
import pyarrow as pa

from loomgraph.operators import sparse_knn as sk
from loomgraph.operators import tiles


def _part(m, ids):
    at = [np.flatnonzero(r) for r in m]
    return pa.table({"id": pa.array(ids), "tids": pa.array([list(a) for a in at], pa.list_(pa.int64())),
                     "weights": pa.array([list(r[a]) for a, r in zip(at, m)], pa.list_(pa.float64()))})


def test_rows_of_one_vocabulary_share_blocks(monkeypatch):
    """Before, blocks were cut in the order of the shuffle, and every two blocks shared all terms."""
    monkeypatch.setattr(sk, "BLOCK_ROWS", 20)
    monkeypatch.setattr(sk, "CENTRES", 2)
    rng = np.random.default_rng(2)
    m = np.zeros((200, 60))
    for i in range(200):
        own = rng.choice(30, 12, replace=False) + 30 * (i % 2)
        m[i, own] = rng.random(12) + 0.1
    blocks = [b for row in sk._packs(_part(m, np.arange(200)), 1 << 19) for b in sk.Packs.load(*row).blocks]
    pure = [{int(t) // 30 for t in b.terms} for b in blocks]
    assert len(blocks) == 10 and all(len(p) == 1 for p in pure)
    assert sorted(i for b in blocks for i in b.ids) == list(range(200))


def test_close_scores_rank_as_in_double_precision(monkeypatch):
    monkeypatch.setattr(sk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(sk, "STRIP_ROWS", 5)
    monkeypatch.setattr(sk, "CENTRES", 3)
    rng = np.random.default_rng(4)
    m = np.tile(rng.random(40), (70, 1)) + rng.random((70, 40)) * 4e-6  # products differ about the sixth place
    m[60:] = 0
    m[60:, 35:] = rng.random((10, 5))
    m[rng.random(m.shape) < 0.1] = 0
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    ids = rng.permutation(500)[:70].astype(np.int64)
    for dear in (0, 10, 10 ** 6):
        monkeypatch.setattr(sk, "DEAR", dear)
        packs = [sk.Packs.load(*row) for half in (slice(0, 40), slice(40, 70)) for row in sk._packs(_part(m[half], ids[half]), 300)]
        assert len(packs) >= 2 and any(len(p.blocks) > 1 for p in packs)
        best = [tiles.Best(p.ids, 4, 0.0) for p in packs]
        for i, p in enumerate(packs):
            for j in range(i, len(packs)):
                p.meet(packs[j], best[i], best[j] if i < j else None)
        s = np.round(m @ m.T, 6)
        want = {int(i): sorted((-s[r, c], int(j)) for c, j in enumerate(ids) if j != i and s[r, c] > 0)[:4] for r, i in enumerate(ids)}
        for b in best:
            for i, score, dst in zip(b.ids, b.score, b.dst):
                assert [(-x, d) for x, d in zip(score, dst) if np.isfinite(x)] == want[int(i)]
