"""Reproducible pseudo-random matrices, generated on the executors."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.limits import check_row_width
from rowloom.operators.selection import row_spine

# Fixed values of the generator: the two largest primes below 2^31, the multiplier of the public minimal-standard
# generator and an increment.
PRIMES = (2147483647, 2147483629)
MULTIPLIER = 48271
INCREMENT = 12345


def _mixed(x, prime: int):
    return ((x * x) % prime + (x * MULTIPLIER) % prime + INCREMENT) % prime


def _row_word(prime: int, seed: int):
    """A word that all bits of the row index go into: its remainder is mixed before its quotient is added."""
    return _mixed((_mixed(F.col("i") % prime, prime) + F.expr(f"i div {prime}") + seed) % prime, prime)


def random_rows(spine: DataFrame, num_cols: int, seed: int = 1000) -> DataFrame:
    """A row of uniform values in [0, 1) for every index ``i`` of ``spine``. Narrow.

    An element depends on its indices and the seed only, so a lost task recomputes the same matrix. It is made of two
    words with different moduli, each mixed from the row's word and the column, so rows neither repeat nor are
    shifted copies of others. The rounds are separate passes over the row, because a lambda would repeat an operand
    it uses twice.
    """
    check_row_width(num_cols)
    words = []
    for prime in PRIMES:
        start = _row_word(prime, seed)
        word = F.sequence(start, start + (num_cols - 1))
        for _ in range(2):
            word = F.transform(word, _mixer(prime))
        words.append(word)
    scale = float(PRIMES[0])
    value = F.zip_with(*words, lambda s, t: (s + t / float(PRIMES[1])) / scale)
    return spine.select("i", value.alias("v"))


def _mixer(prime: int):
    return lambda x: _mixed(x % prime, prime)


def random_matrix(spark: SparkSession, num_rows: int, num_cols: int, seed: int = 1000) -> DataFrame:
    """A ``num_rows x num_cols`` matrix of uniform values in [0, 1)."""
    return random_rows(row_spine(spark, num_rows), num_cols, seed)
