"""Small tables with the cases that every operator must define."""

import pytest
from conftest import DATA
from pyspark.sql import Row

LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, a null key, repeated rows, a very long text, and columns with clashing names."""
    texts = [
        (0, "The quick brown fox jumps over the lazy dog today"),
        (1, "the QUICK brown fox jumps over the lazy dog today"),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, "word"),
        (6, LONG),
        (6, LONG),
        (7, LONG + "end"),
        (None, "The quick brown fox jumps over the lazy dog today"),
        (8, "Licensed under the Apache License, Version 2.0.\nCC BY-NC and the GNU General Public License"),
        (9, "naïve café – ½ ² don't we'll 'tis  x\n\n  "),
    ]
    rows = [
        Row(doc_id=k, text=t, key="k", id=7, rep=1, kind=2, features=[1], tails=[0.5], toxic=9, row=1, line=3, n_chars=len(t or ""))
        for k, t in texts
    ]
    schema = (
        "doc_id bigint, text string, key string, id int, rep int, kind int, features array<int>, tails array<double>, "
        "toxic int, row int, line int, n_chars bigint"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")
