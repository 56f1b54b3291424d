"""Comparison of tables as sets and as bags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(declared: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, problem): keys only declared (missing) or only there (unexpected)."""
    d, a = declared.select(key).distinct(), actual.select(key).distinct()
    return d.join(a, key, "left_anti").withColumn("problem", F.lit("missing")).unionByName(a.join(d, key, "left_anti").withColumn("problem", F.lit("unexpected")))


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows by which two tables of one schema differ, with how many more times the first has them; empty if equal.

    One aggregation instead of two differences; nested columns are compared by value.
    """
    names = a.columns
    both = a.select(*names, F.lit(1).alias("__s")).unionByName(b.select(*names, F.lit(-1).alias("__s")))
    return both.groupBy(*names).agg(F.sum("__s").alias("surplus")).where("surplus != 0")


def inherited(parent: DataFrame, additions: DataFrame, key: str) -> DataFrame:
    """Parent rows and the additions whose key the parent doesn't have, each key once."""
    fresh = additions.join(parent.select(key), key, "left_anti")
    return parent.unionByName(fresh, allowMissingColumns=True).dropDuplicates([key])


def covered(parts: list[DataFrame], whole: DataFrame, key: str) -> DataFrame:
    """(key, n, problem): keys of `whole` that the parts don't cover exactly once, and keys that don't belong."""
    rows = parts[0].select(key)
    for p in parts[1:]:
        rows = rows.unionAll(p.select(key))
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    joined = counted.withColumnRenamed(key, "__k").join(whole.select(key).distinct(), F.col("__k") == F.col(key), "full")
    problem = F.when(F.col(key).isNull(), "unexpected").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    return joined.select(F.coalesce(key, "__k").alias(key), F.coalesce("n", F.lit(0)).alias("n"), problem.alias("problem")).where("problem is not null")
