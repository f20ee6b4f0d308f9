"""Registers the vector functions in a Spark session so that SQL can call them by name."""

from pyspark.sql import SparkSession

SCALAR_FUNCTIONS = {
    "vec_norm": (
        "v ARRAY<DOUBLE>",
        "DOUBLE",
        "sqrt(aggregate(v, 0D, (acc, x) -> acc + x * x))",
    ),
    "vec_dot": (
        "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>",
        "DOUBLE",
        "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (acc, x) -> acc + x)",
    ),
    "vec_sqdist": (
        "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>",
        "DOUBLE",
        "aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (acc, x) -> acc + x)",
    ),
}

TABLE_FUNCTIONS = {
    "vec_cells": (
        "v ARRAY<DOUBLE>",
        "j BIGINT, x DOUBLE",
        "SELECT CAST(pos AS BIGINT), col FROM posexplode(v)",
    ),
}


def register_functions(spark: SparkSession, names=None) -> list[str]:
    """Create the named SQL functions (all by default) and return the names that are now callable."""
    known = {**SCALAR_FUNCTIONS, **TABLE_FUNCTIONS}
    names = list(known) if names is None else list(names)
    missing = [name for name in names if name not in known]
    if missing:
        raise KeyError(f"unknown vector functions: {missing}; available: {sorted(known)}")
    for name in names:
        args, result, body = known[name]
        result = f"TABLE({result})" if name in TABLE_FUNCTIONS else result
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}")
    return names
