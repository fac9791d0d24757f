"""Nearest vectors of a query set against all rows, in blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.vectors import cosine_distance, is_valid


def nearest_vectors(rows: DataFrame, queries: DataFrame, ident: str = "vec_id", emb: str = "embedding", k: int = 1, blocks: int = 64) -> DataFrame:
    """``query, neighbour, distance``: the ``k`` nearest other rows of each query by cosine distance (ties: least id).

    All rows are dealt to blocks and the queries are copied to every block, so each task compares one block with all
    queries; a block's ``k`` best a query are kept before anything else moves. Invalid vectors match nothing.
    """
    good = lambda df: df.filter(is_valid(F.col(emb)))
    dealt = good(rows).select(F.col(ident).alias("neighbour"), F.col(emb).alias("_v"), F.pmod(F.xxhash64(ident), F.lit(blocks)).alias("_blk"))
    asked = good(queries).select(F.col(ident).alias("query"), F.col(emb).alias("_q"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("_blk"))
    hits = dealt.join(asked, "_blk").filter(F.col("neighbour") != F.col("query")).select("query", "_blk", F.struct(cosine_distance(F.col("_q"), F.col("_v")).alias("distance"), F.col("neighbour")).alias("h"))
    if k == 1:
        best = hits.groupBy("query").agg(F.min("h").alias("h"))
    else:
        part = hits.groupBy("query", "_blk").agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias("hs"))
        best = part.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list("hs"))), 1, k).alias("hs")).select("query", F.explode("hs").alias("h"))
    return best.select("query", "h.neighbour", "h.distance")
