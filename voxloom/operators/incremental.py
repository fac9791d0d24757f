"""What is left to do: ids with all inputs and no finished output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ready(*inputs: DataFrame) -> DataFrame:
    """Ids (same column in each input) that every input has."""
    return reduce(lambda a, b: a.intersect(b), inputs)


def pending(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Ids without an output."""
    return ids.join(done.select(key).distinct(), key, "left_anti")


def pending_valid(ids: DataFrame, outputs: DataFrame, key: str, doc: str = "doc") -> DataFrame:
    """Ids without an output that parses as a non-empty JSON array; broken and empty outputs are done again."""
    return pending(ids, outputs.filter(F.coalesce(F.json_array_length(doc) > 0, F.lit(False))), key)


def first_with(ids: DataFrame, having: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` ids in order that ``having`` has too."""
    return ids.join(having.select(key).distinct(), key, "left_semi").orderBy(key).limit(n)


def status(done: Column, failed: Column) -> Column:
    return F.when(failed, "FAIL").when(done, "SKIP").otherwise("DONE")


def tally(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))
