"""Lines that differ in punctuation, blanks or line ends are equal, and lines without blanks take part."""

from rowloom.llm import line_dedup as L


def removed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    return {r["doc_id"] for r in L.dedup_lines(docs).where("n_removed > 0").collect()}


def test_equal_in_letters_and_digits(spark):
    forms = ["a b c d", "A, b; c -- d!", "a\tb\tc\td", "a  b   c d", "a b c d\r", "...a b c d???", "* * * *", "- - - -", "* * * *"]
    assert removed(spark, forms) == {1, 2, 3, 4, 5}


def test_lines_without_blanks(spark):
    rows = ["4711\tshoes\t12.50", "4711\tshoes\t12.50", "数据处理需要完整的结果而不是一部分结果否则没有用处", "数据处理需要完整的结果而不是一部分结果否则没有用处", "数据", "数据"]
    assert removed(spark, rows) == {1, 3}
