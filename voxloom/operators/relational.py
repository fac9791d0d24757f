"""Relational operators by name, thin over Spark's own, so that plans read alike in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grouping_sets(df: DataFrame, sets: list[list[str]], *aggs: Column) -> DataFrame:
    cols = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(*aggs)


def rollup(df: DataFrame, by: list[str], *aggs: Column) -> DataFrame:
    return df.rollup(*by).agg(*aggs)


def cube(df: DataFrame, by: list[str], *aggs: Column) -> DataFrame:
    return df.cube(*by).agg(*aggs)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each key; Spark cuts each task's rows to ``n`` a key before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` beyond those of ``b``, duplicates counted."""
    return a.exceptAll(b)
