"""Repetition rules against plain loops over words and lines."""

import re
from collections import Counter

import numpy as np
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from rowloom.llm import rules as R


def covered(words, size):
    grams = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
    times = Counter(grams)
    return {k + n for k, g in enumerate(grams) if times[g] > 1 for n in range(size)}


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    times = Counter(lines)
    out = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(times),
        "n_repeat_words": len(covered(words, 8)),
        "dup_line_chars": sum(len(re.sub(r"[\x20\x09-\x0D]", "", line)) for line in lines if times[line] > 1),
    }
    for size in R.GRAM_LIMITS:
        out[f"dup_{size}gram_chars"] = sum(len(words[k]) for k in covered(words, size))
    out["base_failed"] = len(words) < 20 or 100 * out["n_repeat_words"] > 30 * len(words)
    shares = [out["dup_line_chars"] * 100 <= R.LINE_LIMIT * out["word_chars"]]
    shares += [100 * out[f"dup_{n}gram_chars"] <= limit * out["word_chars"] for n, limit in R.GRAM_LIMITS.items()]
    out["kept"] = not out["base_failed"] and all(shares)
    return out


def check(found, texts):
    rows = found.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((k is None, k or 0) for k, _ in texts)
    given = {}
    for k, t in texts:
        given.setdefault(k, []).append(brute(t))
    for r in rows:
        assert {n: v for n, v in r.asDict().items() if n != "doc_id"} in given[r["doc_id"]]


def test_documents(documents):
    check(R.repetition_rules(documents), [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_rows(odd_docs, no_docs):
    check(R.repetition_rules(odd_docs), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert R.repetition_rules(no_docs).count() == 0


def test_random_repeats(spark):
    """Few words, many repeats, blanks and newlines of all kinds, several blocks of text."""
    rng = np.random.default_rng(1)
    words = ["a", "bb", "é", "a#", "ab"]
    texts = []
    for k in range(200):
        parts = [words[i] for i in rng.integers(0, len(words), rng.integers(0, 90))]
        if k % 3 == 0:
            parts = parts[:20] * 3
        seps = [" ", "\n", "\t", "  ", " \n", "\n\n", "\x0b", "\x1c"]
        texts.append((k, "".join(p + seps[i] for p, i in zip(parts, rng.integers(0, len(seps), len(parts))))))
    check(R.repetition_rules(spark.createDataFrame(texts, "doc_id bigint, text string")), texts)


def test_equal_hashes_are_told_apart(monkeypatch):
    """With one hash for everything, whole windows decide."""
    monkeypatch.setattr(R, "mix", lambda x: x * np.uint64(0))
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 400)
    text = np.sort(rng.integers(0, 4, 400))
    sizes = [2, 4, 7]
    for size, starts in zip(sizes, R.repeated_grams(words, text, sizes)):
        expected = []
        for t in range(4):
            at = np.flatnonzero(text == t)
            grams = [tuple(words[k : k + size]) for k in at[: len(at) - size + 1]]
            times = Counter(grams)
            expected += [k for k, g in zip(at, grams) if times[g] > 1]
        assert sorted(starts.tolist()) == expected


def test_good_texts_stay(spark):
    """Labelled good texts that pass the base rule are kept; texts of one repeated sentence are not."""
    from conftest import DATA

    found = R.repetition_rules(spark.read.parquet(f"{DATA}/documents.parquet"))
    good = found.join(spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1"), "doc_id").where("NOT base_failed")
    assert good.where("NOT kept").count() <= 0.01 * good.count()
    line = "one two three four five six seven\n"
    other = "".join(f"w{k} " for k in range(40))
    rows = [(0, line * 30), (1, other + "\n" + (line * 6)), (2, other)]
    kept = {r["doc_id"]: r["kept"] for r in R.repetition_rules(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert kept == {0: False, 1: False, 2: True}
