"""The pipeline's stages against brute-force versions, each on what its predecessor kept."""

from collections import Counter

import corpus_pipeline as P
import pytest
from conftest import DATA
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from rowloom.llm.quality import fit_quality, rate_quality
from rowloom.llm.shared import store
from rowloom.llm.toxicity import fit_toxicity, rate_toxicity
from test_line_dedup import expected_texts
from test_minhash import brute
from test_packing import check as check_packing


@pytest.fixture(scope="module")
def kept(spark, documents):
    """What goes into each stage, and the result."""
    small, out = documents.where("length(text) < 3000"), []
    for name, stage in P.STAGES:
        out.append(small)
        small = store(stage(spark, small, DATA), name)
    return [*out, small]


def as_rows(docs):
    return Counter(map(tuple, docs.collect()))


def test_columns(kept):
    assert [name for name, _ in P.STAGES] == ["quality", "toxicity", "line_dedup", "near_copies", "packing"]
    for before, after in zip(kept[:4], kept[1:5]):
        assert after.schema.simpleString() == before.schema.simpleString()


def test_classifiers_reject(spark, kept):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rated = rate_quality(kept[0], fit_quality(kept[0], labels)).collect()
    expected = {r["doc_id"] for r in rated if r["tail_probability"] >= 0.5 or not (r["text"] or "").strip(" ")}
    assert {r["doc_id"] for r in kept[1].collect()} == expected
    rated = rate_toxicity(kept[1], fit_toxicity(kept[1], labels)).collect()
    assert {r["doc_id"] for r in kept[2].collect()} == {r["doc_id"] for r in rated if r["expected_severity"] < 0.5}
    good = {r["doc_id"] for r in labels.where("quality = 1 AND toxic = 0").collect()}
    before = good & {r["doc_id"] for r in kept[0].collect()}
    assert len(before & {r["doc_id"] for r in kept[2].collect()}) >= 0.9 * len(before)


def test_lines(kept):
    rows = [(r["doc_id"], r["text"]) for r in kept[2].collect()]
    expected = {k: t for k, t, gone in expected_texts(rows) if (t or "").strip(" ") or not gone}
    assert {r["doc_id"]: r["text"] for r in kept[3].collect()} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in kept[3].where("text IS NOT NULL").collect())


def test_near_copies(kept):
    component = brute([(r["doc_id"], r["text"]) for r in kept[3].collect()])
    left = {r["doc_id"]: r["text"] for r in kept[4].collect()}
    assert set(left) == set(component.values())
    assert left == {r["doc_id"]: r["text"] for r in kept[3].collect() if r["doc_id"] in left}


def test_packing(kept):
    check_packing(kept[4], 1024, 1)


CLASHES = "keep string, expected_quality int, tail_probability int, severity string, expected_severity int, n_lines int, n_removed string, row2 int"


def test_odd_rows(spark, odd_docs, no_docs):
    """Every column of every row that is kept is what it was, under any name; an empty table stays empty."""
    names = [c.split()[0] for c in CLASHES.split(", ")]
    clashing = odd_docs.selectExpr("*", *[f"CAST(7 AS {c.split()[1]}) AS {c.split()[0]}" for c in CLASHES.split(", ")])
    given = {(r["doc_id"], r["text"]): r for r in clashing.collect()}
    docs = clashing
    for name, stage in P.STAGES[:4]:
        docs = store(stage(spark, docs, DATA), name)
        assert docs.schema.simpleString() == clashing.schema.simpleString()
        rows = docs.collect()
        assert {2, 3, 4} <= {r["doc_id"] for r in rows}
        for r in rows:
            assert [str(r[n]) for n in names] == ["7"] * len(names) and r["toxic"] == 9 and r["key"] == "k"
            if (r["doc_id"], r["text"]) in given:
                assert r == given[r["doc_id"], r["text"]]
    assert P.packing(spark, docs, DATA).count() > 0
    for name, stage in P.STAGES:
        no_docs = store(stage(spark, no_docs, DATA), name)
        assert no_docs.count() == 0


def test_repeated_rows_leave_one(spark, odd_docs):
    left = P.near_copies(spark, odd_docs, DATA)
    assert left.columns == odd_docs.columns
    counted = Counter(r["doc_id"] for r in left.collect())
    texts = [(1, "b b b b b b"), (1, "a a a a a a"), (1, None), (None, "c")]
    two = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert sorted(map(tuple, P.near_copies(spark, two, DATA).collect()), key=str) == [(1, None), (None, "c")]
    assert counted[6] == 1 and counted[None] == 1 and 1 not in counted and counted[2] == counted[3] == 1


def test_run_is_all_stages(spark):
    assert P.run(spark, DATA).columns[:4] == ["doc_id", "start", "length", "ids_crc32"]
