"""Ordinal regression: gradient, recovery of grades, held-out accuracy, odd rows."""

import numpy as np
import pytest
from conftest import DATA
from odd_cases import documents, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F
from rowloom.llm import ordinal as O
from rowloom.llm.quality import fit_quality, rate_quality
from rowloom.llm.toxicity import fit_toxicity, rate_toxicity

SF = DATA.replace("sf0.001", "sf0.01")


def test_gradient():
    rng = np.random.default_rng(5)
    rows, columns = np.repeat(np.arange(30), 4), rng.integers(0, 7, 120)
    grades = rng.integers(0, 4, 30)
    point = rng.standard_normal(7 + 3) * 0.3
    _, slope = O._loss(point, rows, columns, grades, 4)
    for k in range(len(point)):
        step = np.zeros(len(point))
        step[k] = 1e-6
        high, low = (O._loss(point + s * step, rows, columns, grades, 4)[0] for s in (1, -1))
        assert slope[k] == pytest.approx((high - low) / 2e-6, rel=1e-4, abs=1e-5)


def test_four_grades_from_words():
    """Texts with more bad words have higher grades; the shared weights order them."""
    rng = np.random.default_rng(6)
    neutral, bad = [f"plain{i}" for i in range(200)], ["awful", "vile", "nasty"]
    texts, grades = [], []
    for _ in range(1500):
        grade = int(rng.integers(0, 4))
        words = [*rng.choice(neutral, 30), *bad[:grade]]
        rng.shuffle(words)
        texts.append(" ".join(words))
        grades.append(grade)
    import pyarrow as pa

    features = list(O._batches(pa.array(texts), O.word_features))
    model = O.fit(features[:1000], np.array(grades[:1000]))
    assert (np.diff(model.thresholds) > 0).all()
    expected = np.array([model.tails(f).sum() for f in features[1000:]])
    assert np.mean(np.round(expected) == grades[1000:]) > 0.95


def test_held_out_toxicity_and_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known, held = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    rated = rate_quality(docs, fit_quality(docs, known)).join(held, "doc_id").collect()
    right = sum(r["keep"] == (r["quality"] == 1) for r in rated)
    assert right >= 0.95 * len(rated)
    toxic = rate_toxicity(docs, fit_toxicity(docs, known)).drop("toxic", "text")
    toxic = toxic.join(held, "doc_id").collect()
    clean = [r["expected_severity"] for r in toxic if r["toxic"] == 0]
    bad = [r["expected_severity"] for r in toxic if r["toxic"] == 1]
    assert np.mean([b > c for b in bad for c in clean]) > 0.9
    assert np.mean(np.array(clean) < 0.5) > 0.97


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (5, 0, 0), (None, 1, 1), (99, 1, 1), (6, None, None)], "doc_id bigint, quality int, toxic int")
    for fit, rate in ((fit_quality, rate_quality), (fit_toxicity, rate_toxicity)):
        model = fit(odd_docs, labels)
        assert rate(odd_docs, model).count() == odd_docs.count()
        assert rate(no_docs, model).count() == 0
        empty = fit(no_docs, labels)
        assert len(rate(odd_docs, empty).where(F.col("text").isNull()).collect()) == 1
    assert "key" in rate_toxicity(odd_docs, model).columns


def test_words_and_styles_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["One TWO", "", " ", "ÉCOLE école", "a|b %%", "One TWO"]
    for features in (O.word_features, O.style_features):
        together = [f.tolist() for f in O._batches(pa.array(texts), features)]
        assert together == [next(O._batches(pa.array([t]), features)).tolist() for t in texts]
        assert together[0] == together[-1]


def test_sample_bounds_documents(spark, documents):
    """One document repeated 3,000 times is one row of the fit; labels without a document do not use up the sample."""
    rows = [(1, f"text {k % 3} of many words")  for k in range(3000)] + [(k, f"other words {k}") for k in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 500)], "doc_id bigint, toxic int")
    seen = []
    fit = O.fit
    try:
        O.fit = lambda features, grades: seen.append(len(features)) or fit(features, grades)
        for bound in (10, 1000):
            O.fit_on(docs, labels, F.col("toxic"), O.word_features, sample_rows=bound)
    finally:
        O.fit = fit
    assert seen == [10, 29]


def test_features_left_out_before_the_fit_do_not_change_it(spark, documents):
    """Only features that fit() would drop anyway are left on the executors."""
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = fit_toxicity(documents, labels)
    rows = documents.join(labels, "doc_id").orderBy("doc_id").select("text", "toxic").collect()
    import pyarrow as pa

    whole = O.fit(list(O._batches(pa.array([r["text"] for r in rows]), O.word_features)), np.array([r["toxic"] for r in rows]))
    assert np.allclose(model.weights, whole.weights) and np.allclose(model.thresholds, whole.thresholds)
