"""Matrices read from the given tables."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.operators.forms import as_rows, coo_to_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense 64-column matrix, one row per vector."""
    return as_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_rows(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey", "c_acctbal")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_rows(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey", "s_acctbal")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_rows(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_totalprice")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two integer-valued columns, so that Gram sums are exact in any order."""
    tens = F.floor(F.col("p_retailprice") / 10)
    return as_rows(table(spark, sf_dir, "part"), "p_partkey", "p_size", tens)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four columns scaled to comparable size. The index repeats: for results that do not use it."""
    return as_rows(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey",
        F.col("l_quantity") / 50,
        F.col("l_extendedprice") / 100000,
        "l_discount",
        "l_tax",
    )


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity and whole percent of discount: integer-valued."""
    percent = F.round(F.col("l_discount") * 100)
    return as_rows(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", percent)


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse order x part matrix of quantities, in cells; the repeated pairs add up downstream."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_quantity").alias("x")
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two 0/1 columns with gaps in the index."""
    return as_rows(table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")


def label_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that are not zero, as cells."""
    marks = F.posexplode(F.array("quality", "toxic")).alias("j", "x")
    cells = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("i"), marks).where("x != 0")
    return cells.select("i", F.col("j").cast("bigint").alias("j"), F.col("x").cast("double").alias("x"))


def document_count(spark: SparkSession, sf_dir: str) -> int:
    top = table(spark, sf_dir, "documents").agg(F.max("doc_id")).first()[0]
    return 0 if top is None else top + 1


def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x event-type counts in cells; column j is the rank of the type's name among all types."""
    events = table(spark, sf_dir, "events")
    kinds = events.select("event_type").where("event_type IS NOT NULL").distinct()
    place = F.row_number().over(Window.orderBy("event_type")) - 1
    ranks = kinds.select("event_type", place.cast("bigint").alias("j"))
    counts = events.groupBy("user_id", "event_type").agg(F.count("*").cast("double").alias("x"))
    return counts.join(ranks, "event_type").select(F.col("user_id").alias("i"), "j", "x")


# Columns of the wide matrix of events, whatever the number of events.
EVENT_COLUMNS = 4800


def event_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users x EVENT_COLUMNS counts of events, dealt to columns by their number, in cells."""
    events = table(spark, sf_dir, "events")
    counted = events.groupBy("user_id", (F.col("event_id") % EVENT_COLUMNS).alias("j")).agg(F.count("*").cast("double").alias("x"))
    return counted.select(F.col("user_id").alias("i"), "j", "x")


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation x order prices in cells: a wide matrix whose columns hold one element each, so its rows are orthogonal."""
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    priced = table(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    return priced.select(
        F.col("c_nationkey").cast("bigint").alias("i"), F.col("o_orderkey").alias("j"), F.col("o_totalprice").alias("x")
    )


def fading_nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each nation's prices a half power of ten smaller than those of the one before."""
    return nation_orders(spark, sf_dir).withColumn("x", F.col("x") * F.pow(F.lit(10.0), -F.col("i") / 2))


def brand_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part x brand attributes: a pair of columns for each of the 25 brands, so that A'A has 2 x 2 blocks."""
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint") - 1
    tens = F.floor(F.col("p_retailprice") / 10).cast("double")
    marks = F.posexplode(F.array(F.col("p_size").cast("double"), tens)).alias("c", "x")
    cells = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("i"), brand.alias("brand"), marks)
    return coo_to_rows(cells.select("i", (2 * F.col("brand") + F.col("c")).alias("j"), "x"), 50, unique=True)


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column x label means of the embeddings, in cells."""
    vectors = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("j", "x"))
    means = vectors.groupBy("j", "label").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.select(F.col("j").cast("bigint").alias("i"), F.col("label").cast("bigint").alias("j"), "x")
