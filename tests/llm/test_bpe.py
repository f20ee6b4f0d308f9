"""Encoding like tiktoken, exact round trips."""

import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_cases import no_docs, odd_docs  # noqa: F401
from rowloom.llm import bpe
from rowloom.llm.queries import RANKS
from rowloom.llm.tokenize import decode_column, encode_column, round_trip_digests

PARTS = ["'s", "'re", "'ll", "'", " ", "  ", "\n", "\r\n", "\t", "a", "re", "s", "7", "22", "!", "?!", "é", " ", "　", "中文", "😀", "l", "v", "½", "٣", "ᲊ", "x" * 60]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(texts):
    merged = bpe.Cache(bpe.merges(RANKS))
    return [[i for piece in found for i in piece] for found, _ in bpe.encode(pa.array(texts), merged)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=30).map("".join))
def test_like_tiktoken(reference, text):
    assert ids([text]) == [reference.encode_ordinary(text)]


def test_neighbouring_texts_do_not_mix(reference):
    texts = ["don", "'t", " a ", " ", "", "b", "'", "s", "x" * 5000, "ab " * 700]
    assert ids(texts) == [reference.encode_ordinary(t) for t in texts]


def test_cache_generations(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    texts = ["one two three four one two five six seven one"] * 2
    assert ids(texts) == [reference.encode_ordinary(t) for t in texts]


def test_offsets_and_decoding(odd_docs):
    encoded = encode_column(odd_docs, RANKS).cache()
    decoded = decode_column(encoded, RANKS)
    texts = sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in odd_docs.collect())
    found = sorted((r["doc_id"] is None, r["doc_id"], bytes(r["data"]).decode()) for r in decoded.collect())
    assert found == texts
    for r in encoded.collect():
        assert r["offsets"] == sorted(set(r["offsets"])) and (not r["offsets"] or r["offsets"][0] == 0)


def test_digests(odd_docs, no_docs, reference):
    rows = {r["doc_id"]: r for r in round_trip_digests(odd_docs, RANKS).collect()}
    for r in odd_docs.collect():
        text = r["text"] or ""
        expected = reference.encode_ordinary(text)
        found = rows[r["doc_id"]]
        assert found["n_tokens"] == len(expected)
        assert found["ids_sha256"] == hashlib.sha256(" ".join(map(str, expected)).encode()).hexdigest()
        assert found["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert round_trip_digests(odd_docs, RANKS).count() == odd_docs.count()
    assert round_trip_digests(no_docs, RANKS).count() == 0
