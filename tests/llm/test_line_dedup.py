"""Line groups against comparing every two lines that share a block, SimHashes made apart from Spark."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F
from rowloom.llm import line_dedup as L


def norm(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip(" ")


def distance(a, b):
    """Edit distance, a row of the table at a time."""
    b = np.array([ord(c) for c in b])
    places = np.arange(len(b) + 1)
    row = places
    for i, x in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[:-1] + (b != ord(x)), row[1:] + 1)])
        row = np.minimum.accumulate(new - places) + places
    return int(row[-1])


def alike(a, b, percent=L.EDITS_PERCENT):
    most = max(len(a), len(b)) * percent // 100
    for gram in (1, 3):  # an edit changes no more grams than they have letters
        left, right = (Counter(x[k : k + gram] for k in range(len(x) - gram + 1)) for x in (a, b))
        if max((left - right).total(), (right - left).total()) > gram * most:
            return False
    return distance(a, b) <= most


def simhash(line):
    """The words of the line's SimHash, a bit at a time."""
    words = set(line.split(" "))
    found = []
    for w in range(L.WORDS):
        seed = xxhash.xxh64_intdigest(w.to_bytes(4, "little"), 42)  # each column's hash is the next one's seed
        hashes = [xxhash.xxh64_intdigest(x.encode(), seed) for x in words]
        found.append(sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(words)))
    return found


def blocks_of(words):
    pieces = [[w >> 16 * p & 0xFFFF for p in range(L.PIECES)] for w in words]
    return {(n, a, b, x[a], x[b]) for n, x in enumerate(pieces) for a, b in itertools.combinations(range(L.PIECES), 2)}


def differing(left, right):
    return sum((a ^ b).bit_count() for a, b in zip(left, right, strict=True))


def expected_texts(rows):
    hashed, holders = {}, defaultdict(set)
    for _, text in rows:
        for line in map(norm, (text or "").split("\n")):
            if line and (line.count(" ") + 1 >= L.LEAST_WORDS or len(line) >= L.LEAST_CHARS) and line not in hashed:
                hashed[line] = simhash(line)
                for k in blocks_of(hashed[line]):
                    holders[k].add(line)
    parent = {line: line for line in hashed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for held in holders.values():
        for a, b in itertools.combinations(sorted(held), 2):
            if root(a) != root(b) and differing(hashed[a], hashed[b]) <= L.MOST_BITS and alike(a, b):
                parent[root(a)] = root(b)
    seen, out = set(), []
    for key, text in sorted(set(rows), key=lambda r: r[0]):
        kept, gone = [], 0
        for line in (text or "").split("\n"):
            x = norm(line)
            if x in parent and root(x) in seen:
                gone += 1
                continue
            if x in parent:
                seen.add(root(x))
            kept.append(line)
        out.append((key, None if text is None else "\n".join(kept), gone))
    return out


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if r["doc_id"] is not None]
    found = L.dedup_lines(docs).where("doc_id IS NOT NULL").collect()
    assert {(r["doc_id"], r["text"], r["n_removed"]) for r in found} == set(expected_texts(rows))
    assert len(found) == len(rows)


def test_documents(documents):
    check(documents.where("length(text) < 3000"))


def test_odd_rows(odd_docs, no_docs):
    result = L.dedup_lines(odd_docs).cache()
    check(odd_docs)
    assert result.columns == [*odd_docs.columns, "n_lines", "n_removed"]
    null = result.where("doc_id IS NULL").first()
    assert null["text"].startswith("The quick") and null["n_removed"] == 0 and null["key"] == "k"
    assert L.dedup_lines(no_docs).count() == 0


def test_near_lines_and_chains(spark):
    base = "the board met on tuesday and agreed to raise the annual budget for public libraries by nine percent"
    near = [base.replace("nine", w) for w in ("ten", "five", "six")] + [base.upper() + "  ", base.replace("tuesday", "thursday")]
    texts = [base, *near, "short line", "short line", "other words that nobody else has written here so far\n" + base]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    check(docs)
    found = {r["doc_id"]: r for r in L.dedup_lines(docs).collect()}
    assert found[0]["n_removed"] == 0 and found[4]["n_removed"] == 1 and found[8]["text"].startswith("other")
    assert found[6]["text"] == found[7]["text"] == "short line"


def test_simhash_is_the_majority(spark):
    """Of distinct words, however many a line has; made once a line."""
    rng = np.random.default_rng(3)
    several = [" ".join(f"w{k}" for k in rng.integers(0, 5000, n)) for n in (3, 4, 126, 127, 128, 300, 2000)]
    several += ["one one two three", "longwordwithoutanyblanks" * 3, "été à la plage 日本 語"]
    rows = [(k, "\n".join(several)) for k in range(3)]
    lines = L.lines_of(spark.createDataFrame(rows, "key bigint, text string"))
    hashed = L.simhashes(lines)
    found = hashed.join(lines.select("id", "plain").distinct(), "id").select("*", L.blocks().alias("blocks")).collect()
    assert sorted(r["plain"] for r in found) == sorted(map(norm, several))
    for r in found:
        assert [r[f"h{w}"] % 2**64 for w in range(L.WORDS)] == simhash(r["plain"])
        assert len(set(r["blocks"])) == L.WORDS * L.PIECES * (L.PIECES - 1) // 2


def test_blocks_hold_the_radius(spark):
    """Any two SimHashes that differ in at most RADIUS bits share a block, wherever the bits lie."""
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(200):
        base = rng.integers(-(2**63), 2**63, L.WORDS)
        places = rng.choice(64 * L.WORDS, L.RADIUS, replace=False)
        other = base.copy()
        for p in places:
            other[p // 64] ^= np.array(1 << int(p) % 64, dtype=np.uint64).astype(np.int64)
        rows += [[int(x) for x in base], [int(x) for x in other]]
    named = ", ".join(f"h{w} bigint" for w in range(L.WORDS))
    found = [set(r[0]) for r in spark.createDataFrame(rows, named).select(L.blocks()).collect()]
    assert len(found) == 400 and all(a & b for a, b in zip(found[::2], found[1::2], strict=True))


def test_one_key_with_two_texts_and_clashing_names(spark):
    """Texts of one key are told apart; columns named like the counts are replaced."""
    unique = "foo bar baz qux quux corge"
    shared = "the same line stands in all of these documents here"
    rows = [(1, f"{shared}\n{unique}", "a", 5), (1, f"x y\n{shared}", "b", 6), (2, shared, "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_lines string, n_removed int")
    found = L.dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert sorted((r["doc_id"], r["text"], r["n_removed"]) for r in found.collect()) == sorted(
        [(1, f"{shared}\n{unique}", 0), (1, "x y", 1), (2, "", 1)]
    )


@pytest.mark.parametrize("size", [40, 1500])
def test_edit_similarity(spark, size):
    a = ("abcdefghij" * 200)[:size]
    pairs = [(a, a), (a, a[1:]), (a, "x" * (size // 20) + a[size // 20 :]), (a, a[: size // 2]), (a, a[::-1])]
    table = spark.createDataFrame(pairs, "a string, b string")
    found = [r[0] for r in table.select(L._alike(F.col("a"), F.col("b"), L.EDITS_PERCENT)).collect()]
    assert found == [alike(x, y) for x, y in pairs]
