"""Near duplicates against a comparison of all pairs of full shingle sets."""

import re
from collections import Counter, defaultdict

import numpy as np
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from rowloom.llm.components import connected_components
from rowloom.llm.minhash import _overlaps, near_duplicates


def shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=75):
    """Component of each key by comparing all pairs that share a shingle."""
    sets = defaultdict(list)
    for key, text in rows:
        sets[key].append(shingles(text))
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    flat = [(k, s) for k, several in sets.items() for s in several]
    holders = defaultdict(list)
    for n, (_, s) in enumerate(flat):
        for x in s:
            holders[x].append(n)
    for n, (k, s) in enumerate(flat):
        for m, both in Counter(m for x in s for m in holders[x] if m < n).items():
            if 100 * both >= percent * (len(s) + len(flat[m][1]) - both):
                a, b = root(k), root(flat[m][0])
                parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in sets}


def check(docs, result):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if r["doc_id"] is not None]
    expected = brute(rows)
    found = [r for r in result.collect() if r["doc_id"] is not None]
    assert sorted((r["doc_id"], r["n_shingles"]) for r in found) == sorted((k, len(shingles(t))) for k, t in rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_like_all_pairs(documents):
    check(documents, near_duplicates(documents))


def test_odd_rows(odd_docs):
    result = near_duplicates(odd_docs).cache()
    check(odd_docs, result)
    assert result.count() == odd_docs.count()
    assert [r["kept"] for r in result.collect() if r["doc_id"] is None] == [True]


def test_empty(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_group_around_a_base(spark):
    """Copies near a base but not near each other, in a group that is compared in several chunks."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 400):
        words = list(base)
        for place in rng.choice(120, rng.integers(1, 6), replace=False):
            words[place] = f"x{k}_{place}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    check(docs, near_duplicates(docs))


def test_repeated_key_with_other_text(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a)], "doc_id bigint, text string")
    assert {r["component_id"] for r in near_duplicates(docs).collect()} == {1}


def test_overlaps_in_slabs(monkeypatch):
    import rowloom.llm.minhash as M

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 80).astype(np.uint64)) for _ in range(9)]
    monkeypatch.setattr(M, "SLAB", 37)
    expected = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert _overlaps(sets[:4], sets[4:]).tolist() == expected


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(30)]
    star = [(100, 100 + i) for i in range(1, 50)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (200, 200), (1, 0), (None, 3)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(50)} | {200: 200}
    assert connected_components(edges.limit(0)).count() == 0
