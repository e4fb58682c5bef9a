"""Small helpers for literal rows and row-set comparison."""

from pyspark.sql import functions as F


def values(spark, rows, expression, name="x", kind="string"):
    """Apply a column expression to literal values, in order."""
    table = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {name} {kind}")
    return [r.v for r in table.select("i", expression(F.col(name)).alias("v")).orderBy("i").collect()]


def canonical(columns, rows):
    """Column names and rows in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if v is None or isinstance(v, (bool, str)):
            return v
        return float(v) if isinstance(v, float) else int(v)

    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)
