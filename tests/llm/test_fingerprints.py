"""Digests against plain counting, equal texts, edits spliced from their parts."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from rowloom.llm import fingerprints as fp


def chain(text, ranks):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return fp.filters(fp.features(data, fp.entropy_classes(data), ranks))


def ordered(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))


def check(docs):
    rows = ordered(docs)
    ranks, size = fp.entropy_ranks(docs)
    assert size == sum(len(t.encode()) for _, t in rows)
    expected = []
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, other = (chain(t, ranks) for t in (text, edited, following))
        expected.append(
            (
                key,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                fp.as_string(own),
                fp.as_string(changed),
                round(fp.likeness(own, changed), 9),
                round(fp.likeness(own, other), 9),
            )
        )
    found = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, fp.fingerprints(docs).collect())]
    assert Counter(found) == Counter(expected)


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_many_ranges(documents, monkeypatch):
    monkeypatch.setattr(fp, "TASK_BYTES", 20_000)
    check(documents)


def test_empty_and_single(no_docs, spark):
    assert fp.fingerprints(no_docs).count() == 0
    (row,) = fp.fingerprints(spark.createDataFrame([(1, "abcd" * 40)], "doc_id bigint, text string")).collect()
    assert row["near_next"] == 1.0 and row["fingerprint"]


@pytest.mark.parametrize("lanes", [(512, 2048), (8, 3)])
def test_entropy_is_that_of_the_counts(monkeypatch, lanes):
    monkeypatch.setattr(fp, "LANE", lanes[0])
    monkeypatch.setattr(fp, "LANES", lanes[1])
    data = np.random.default_rng(1).integers(97, 105, 700).astype(np.uint8)
    data[200:330] = 97
    plain = [
        sum(int(fp._TERM[c]) for c in Counter(data[k : k + fp.WINDOW].tolist()).values()) // fp._UNIT
        for k in range(len(data) - fp.WINDOW + 1)
    ]
    assert fp.entropy_classes(data).tolist() == plain


def test_likeness_follows_shared_parts(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(4000)]
    a, b = " ".join(words[:2000]), " ".join(words[2000:])
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id bigint, text string")
    first, second = sorted(fp.fingerprints(docs).collect())
    for row in (first, second):
        assert 0.35 < row["near_edited"] < 0.65 and row["near_next"] < 0.1
