"""Functions for SQL: table and scalar functions under names, registered on a session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voxloom.operators.align import lcs_pairs
from voxloom.operators.chunk import split_text


class SplitText:
    """``split_text(text, most)``: a row a chunk, ``chunk_no`` and ``chunk``; null and empty texts give none."""

    def eval(self, text: str, most: int):
        if text and most:
            yield from enumerate(split_text(text.strip(), most))


def register(spark: SparkSession) -> None:
    """``split_text`` (table function) and ``lcs_length`` (length of the common subsequence of two arrays)."""
    spark.udtf.register("split_text", F.udtf(SplitText, returnType="chunk_no int, chunk string"))

    @F.pandas_udf("int")
    def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else len(lcs_pairs(list(x), list(y))) for x, y in zip(a, b, strict=True)], dtype="Int32")

    spark.udf.register("lcs_length", lcs_length)
