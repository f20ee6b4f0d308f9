"""Line groups against the edit distance of all pairs, whatever keys the lines have."""

import random

import pytest
from rowloom.llm import line_dedup as L

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def distance(a, b):
    if len(a) == len(b) and 100 * sum(x != y for x, y in zip(a, b, strict=True)) <= L.EDITS_PERCENT * len(a):
        return 0  # letters were exchanged only: within the bound
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def invented(rng, n):
    return ["".join(rng.choices(LETTERS, k=rng.randint(3, 9))) for _ in range(n)]


def swap_words(rng, words, changed):
    out = list(words)
    for at in rng.sample(range(len(out)), changed):
        out[at] = "".join(rng.choices(LETTERS, k=len(out[at])))
    return " ".join(out)


def edit_chars(rng, words, share):
    out = list(" ".join(words))
    for _ in range(int(len(out) * share)):
        at = rng.randrange(len(out))
        out[at] = rng.choice(LETTERS)
    return "".join(out)


#: At least so many pairs are found. SimHash blocks promise nine in ten where one word in fifty or fewer changed, in lines of fifty words or more;
#: cases beyond that range are measured and printed only.
CASES = {
    "4 words, 1 letter": (4, lambda rng, w: edit_chars(rng, w, 1.01 / len(" ".join(w))), 0.0),
    "10 words, 1 changed": (10, lambda rng, w: swap_words(rng, w, 1), 0.0),
    "20 words, 1 changed": (20, lambda rng, w: swap_words(rng, w, 1), 0.0),
    "50 words, 1 changed": (50, lambda rng, w: swap_words(rng, w, 1), 0.9),
    "100 words, 1 changed": (100, lambda rng, w: swap_words(rng, w, 1), 0.9),
    "200 words, 2 changed": (200, lambda rng, w: swap_words(rng, w, 2), 0.9),
    "400 words, 2 changed": (400, lambda rng, w: swap_words(rng, w, 2), 0.9),
    "50 words, 5 changed": (50, lambda rng, w: swap_words(rng, w, 5), 0.0),
    "100 words, 10 changed": (100, lambda rng, w: swap_words(rng, w, 10), 0.0),
    "20 words, 5% of letters": (20, lambda rng, w: edit_chars(rng, w, 0.05), 0.0),
    "20 words, 10% of letters": (20, lambda rng, w: edit_chars(rng, w, 0.10), 0.0),
    "20 words, 15% of letters": (20, lambda rng, w: edit_chars(rng, w, 0.15), 0.0),
}


@pytest.fixture(scope="module")
def found(spark):
    """(case, whether the two lines are within the edit threshold, whether the second is removed) of all cases' pairs."""
    pairs = []
    for case, (n, change, _) in CASES.items():
        rng = random.Random(case)
        for words in [invented(rng, n) for _ in range(60)]:
            a, b = " ".join(words), change(rng, words)
            pairs.append((case, a, b, distance(a, b) <= max(len(a), len(b)) * L.EDITS_PERCENT // 100))
    lines = [line for _, a, b, _ in pairs for line in (a, b)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(3)
    gone = {r["doc_id"] for r in L.dedup_lines(docs).where("n_removed > 0").collect()}
    assert all(k % 2 for k in gone)
    return [(case, near, 2 * k + 1 in gone) for k, (case, _, _, near) in enumerate(pairs)]


@pytest.mark.parametrize("case", CASES)
def test_recall(found, case):
    """The lines are invented, so that only the two of a pair are alike: the share of those pairs that are found."""
    of_case = [(near, gone) for name, near, gone in found if name == case]
    assert all(near for near, gone in of_case if gone)
    recall = [gone for near, gone in of_case if near]
    print(f"recall of line groups, {case}: {sum(recall) / len(recall):.2f} of {len(recall)}")
    assert sum(recall) / len(recall) >= CASES[case][2]
