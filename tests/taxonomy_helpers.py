"""Paths and helpers of the tests; a module of its own name, so that no other ``conftest`` hides it."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def one(spark, col_expr, value, schema="s string"):
    """Evaluate a Column expression on a one-row DataFrame holding ``value`` in column ``s``."""
    return spark.createDataFrame([(value,)], schema).select(col_expr.alias("o")).first()["o"]
