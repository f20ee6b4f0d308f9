"""Ranked search against the scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from rowloom.llm import lexical as L

PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(PATTERN, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, count=10):
    counted = [(k, Counter(terms(t))) for k, t in docs if k is not None]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for k, t in set(items):
        if k is not None:
            asked.setdefault(k, Counter()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for key, c in counted:
            m = 25 + (75 * c.total() * n_docs) // max(n_terms, 1)
            score = 0
            for t, times in wanted.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, key))
        out += [(item, r + 1, key, -s) for r, (s, key) in enumerate(sorted(scored)[:count])]
    return sorted(out)


def rows_of(found, key="doc_id"):
    return sorted((r["item_id"], r["rank"], r[key], r["score"]) for r in found.collect())


def given(frame, key):
    return [(r[key], r["text"]) for r in frame.select(key, "text").collect()]


def test_documents(spark, documents):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert rows_of(L.search(documents, items)) == brute(given(documents, "doc_id"), given(items, "item_id"))


@pytest.mark.parametrize("block", [2, 128])
def test_small_shards(spark, monkeypatch, block):
    """Many shards and blocks, several blocks of items, a common term, ties and a third of the documents alike."""
    monkeypatch.setattr(L, "SHARD_ROWS", 40)
    monkeypatch.setattr(L, "BLOCK", block)
    monkeypatch.setattr(L, "ASKED_PAIRS", 20)
    rng = np.random.default_rng(3)
    names = [f"W{k}" for k in range(60)]
    chance = 1 / np.arange(1, 61)
    draw = lambda n: " ".join(rng.choice(names, n, p=chance / chance.sum())) + " the"
    docs = [(int(k), draw(rng.integers(1, 60))) for k in rng.permutation(600)]
    docs += [(k, "the w1 w2 w2 w59") for k in range(600, 900)]
    items = [(k, draw(8)) for k in range(12)] + [(50, "w59"), (51, "unknown"), (52, "THE the")]
    found = L.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows_of(found) == brute(docs, items)


def test_blocks_stay_closed(monkeypatch):
    """A rare term decides; of a common one only the blocks are opened whose maxima could still matter."""
    monkeypatch.setattr(L, "BLOCK", 8)
    lengths = np.full(4000, 50)
    lengths[100] = 1
    term = np.concatenate([np.zeros(4000, dtype=np.int64), np.ones(20, dtype=np.int64)])
    document = np.concatenate([np.arange(4000), np.arange(100, 4000, 200)[:20]])
    times = np.ones(len(term), dtype=np.int64)
    times[4000] = 30
    opens, heads, cuts, data, ends = L.compress(term, document, times, lengths)
    totals = (4000, int(lengths.sum()))
    scaled = L.lengths_scaled(lengths, *totals)
    lists = [
        (L.Postings(n, heads[cuts[k] : cuts[k + 1]].tobytes(), data[ends[k] : ends[k + 1]].tobytes(), scaled, totals), w)
        for k, (n, w) in enumerate([(4000, 5), (20, 900)])
    ]
    everything = L.search_shard(lists, 1, 4000)
    assert len(everything[0]) == 4000
    best = int(everything[1].max())
    lists = [
        (L.Postings(n, heads[cuts[k] : cuts[k + 1]].tobytes(), data[ends[k] : ends[k + 1]].tobytes(), scaled, totals), w)
        for k, (n, w) in enumerate([(4000, 5), (20, 900)])
    ]
    found, scores = L.search_shard(lists, best, 4000)
    assert found.tolist() == [100] and scores.tolist() == [best]
    assert lists[1][0].opened.all() and lists[0][0].opened.sum() == 1


def test_wide_gaps_and_counts():
    """Gaps and counts of one, two and four bytes come back as they were."""
    document = np.array([0, 3, 70_000, 70_001, 20_000_000])
    times = np.array([1, 300, 70_000, 2, 5])
    lengths = np.zeros(20_000_001, dtype=np.int64) + 9
    opens, heads, cuts, data, ends = L.compress(np.zeros(5, dtype=np.int64), document, times, lengths)
    postings = L.Postings(5, heads.tobytes(), data.tobytes(), lengths, (10, 10))
    postings.open_all()
    assert postings.documents.tolist() == document.tolist()
    assert postings.impacts.tolist() == L.impact(times, lengths[document]).tolist()


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(0, "The FOX"), (0, "The FOX"), (1, None), (2, ""), (3, "lorem apache"), (3, "café ½"), (None, "fox"), (4, "- . _")]
    asked = spark.createDataFrame([(*r, 1, 2, "x") for r in items], "item_id bigint, text string, item int, rank int, term string")
    docs = given(odd_docs, "doc_id")
    assert rows_of(L.search(odd_docs, asked)) == brute(docs, items)
    assert L.search(no_docs, asked).count() == 0
    assert L.search(odd_docs, asked.limit(0)).count() == 0
