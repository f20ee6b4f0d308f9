"""The key that deals remainders tells vocabularies apart and does not hang on the id that ends every document."""

import numpy as np
from rowloom.llm.packing import _place


def test_end_id_and_spread():
    rng = np.random.default_rng(3)
    vocabularies = [np.unique(rng.zipf(1.3, 400) % 50_000) for _ in range(500)]
    with_end = [np.union1d(v, [0]) for v in vocabularies]
    places = [_place(v) for v in with_end]
    assert places == [_place(v[v != 0]) for v in vocabularies]
    assert all(0 <= p < 1 << 63 for p in places) and len(set(places)) > 400
    assert _place(np.array([0], dtype="<u4")) == _place(np.array([], dtype="<u4")) == 0


def test_like_vocabularies_share_minima():
    rng = np.random.default_rng(4)
    shared = unlike = 0
    for _ in range(300):
        a = rng.choice(np.arange(1, 50_000), 300, replace=False)
        b = np.concatenate([a[:270], rng.choice(np.arange(1, 50_000), 30)])
        shared += _place(a) >> 42 == _place(b) >> 42
        unlike += _place(a) >> 42 == _place(rng.choice(np.arange(1, 50_000), 300)) >> 42
    assert shared > 200 and unlike < 10
