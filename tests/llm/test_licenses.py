"""Licence scans against trying every place."""

import re

from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from rowloom.llm.licenses import TEMPLATES, scan_licenses

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in BASE.items():
        key = phrase.split()
        at = [k for k in range(len(words)) if words[k : k + len(key)] == key]
        starts += at
        labels |= {label} if at else set()
    every, score = set(labels), 0.0
    for t in TEMPLATES:
        for k in range(len(words)):
            if words[k : k + len(t.key_words)] == t.key_words:
                every.add(t.label)
                begin = k - t.key_place
                same = sum(begin + i >= 0 and words[begin + i : begin + i + 1] == [w] for i, w in enumerate(t.words))
                score = max(score, same / len(t.words))
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(labels)), ",".join(sorted(every)), round(score, 9)


def check(docs):
    expected = sorted(
        ((r["doc_id"] is None, r["doc_id"], *brute(r["text"])) for r in docs.select("doc_id", "text").collect()), key=str
    )
    found = [
        (r["doc_id"] is None, r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9))
        for r in scan_licenses(docs).collect()
    ]
    assert sorted(found, key=str) == expected


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert scan_licenses(no_docs).count() == 0


def test_phrases_and_breaks(spark):
    texts = [
        "cc by cc by-nc CC_BY ccby cc.by 4.0",
        "gnu general public gnu general public license license",
        "GNU GENERAL PUBLIC LICENSE",
        "the mİt lİcense, the MIT\x00License mit – license",
        "mit\nlicense apache\tlicense apache license",
        "Permission is hereby granted, free of charge, to any person",
        "licensed under the gnu affero general public license version 3",
        "K cc by K",
    ]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
