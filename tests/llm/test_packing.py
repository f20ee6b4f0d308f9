"""Every id in exactly one piece, sequences without gaps."""

import zlib
from collections import Counter, defaultdict

import numpy as np
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from rowloom.llm.packing import Shard, pack_documents
from rowloom.llm.queries import VOCABULARY
from tokenizers import Tokenizer


def check(docs, window, most_open):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        expected[r["doc_id"]].append([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    pieces = [r.asDict() for r in pack_documents(docs, VOCABULARY, window).collect()]
    by_document = defaultdict(list)
    for p in pieces:
        by_document[p["doc_id"]].append(p)
    assert set(by_document) == set(expected)
    for key, found in by_document.items():
        copies, ids = len(expected[key]), expected[key][0]
        assert all(other == ids for other in expected[key])
        covered = Counter(k for p in found for k in range(p["start"], p["start"] + p["length"]))
        assert covered == Counter({k: copies for k in range(len(ids))})
        for p in found:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], dtype="<u4")
            assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(part.tobytes())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    sizes = []
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert max(sizes) <= window and sum(s < window for s in sizes) <= most_open


def test_documents(documents):
    check(documents, 1024, 1)


def test_narrow_window(documents):
    check(documents.where("doc_id < 40"), 64, 1)


def test_odd_rows(odd_docs):
    check(odd_docs, 1024, 1)


def test_special_token_string(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "plain")], "doc_id bigint, text string")
    check(docs, 8, 1)


def test_empty(no_docs):
    assert pack_documents(no_docs, VOCABULARY).count() == 0


def test_ranking_is_bm25():
    rests = [np.array([1, 2, 3, 3]), np.array([3, 3, 4]), np.array([5, 6]), np.array([1, 2, 3, 4, 5, 6])]
    idf = np.linspace(0.1, 1.0, 7)
    shard = Shard(rests, idf)
    mean = np.mean([len(r) for r in rests])

    def score(query, row):
        total = 0.0
        for t in set(query.tolist()) & set(row.tolist()):
            n = (row == t).sum()
            total += idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(row) / mean))
        return total

    for k, query in enumerate(rests):
        scores = [score(query, row) for row in rests]
        assert shard.ranked(k).tolist() == sorted(range(len(rests)), key=lambda i: (-round(scores[i], 12), i))
