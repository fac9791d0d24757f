"""Problem 3: pair records of two tables with the nearest record in time of the same entity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.scan import ms

BLOCK_MS = 1_800_000
TOLERANCE_MS = 1_500


def nearest(left: DataFrame, right: DataFrame, by: str = "lecture_id", left_id: str = "seg_id", right_id: str = "turn_id", left_time: str = "start_s",
            right_time: str = "start_s", tolerance_ms: int = TOLERANCE_MS, block_ms: int = BLOCK_MS) -> DataFrame:
    """``left_id, right_id, distance_ms``: for each left record the right one whose time is nearest, within the tolerance.

    Of equally near ones the smallest id is taken; a right record may serve many. Both tables are co-grouped by entity and
    block of time; right records within the tolerance of a block's border go to both blocks, so each left record meets all
    its candidates in one group, where one binary search over the sorted right times serves all left ones. Right records of
    one entity and millisecond are reduced to the smallest id before the shuffle, which bounds a group's right side by the
    block's length. Records without id, entity or time are in no pair; repeated ids count once; empty tables give no rows.
    """
    l = (left.select(F.col(by).alias("_by"), F.col(left_id).cast("bigint").alias("lid"), ms(F.col(left_time)).alias("at")).filter("_by is not null and lid is not null and at is not null")
         .dropDuplicates(["lid"]).withColumn("blk", F.floor(F.col("at") / block_ms)))
    r = (right.select(F.col(by).alias("_by"), F.col(right_id).cast("bigint").alias("rid"), ms(F.col(right_time)).alias("at")).filter("_by is not null and rid is not null and at is not null")
         .groupBy("_by", "at").agg(F.min("rid").alias("rid"))
         .withColumn("blk", F.explode(F.sequence(F.floor((F.col("at") - tolerance_ms) / block_ms), F.floor((F.col("at") + tolerance_ms) / block_ms)))))

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        at, ids = np.asarray(b["at"], dtype=np.int64), np.asarray(b["rid"], dtype=np.int64)
        order = np.argsort(at, kind="stable")
        at, ids = at[order], ids[order]
        want, lid = np.asarray(a["at"], dtype=np.int64), np.asarray(a["lid"], dtype=np.int64)
        if not len(at) or not len(want):
            return pa.table({"lid": pa.array([], pa.int64()), "rid": pa.array([], pa.int64()), "d": pa.array([], pa.int64())})
        i = np.searchsorted(at, want)
        lo, hi = np.clip(i - 1, 0, len(at) - 1), np.clip(i, 0, len(at) - 1)
        dl, dh = np.abs(want - at[lo]), np.abs(want - at[hi])
        low = (dl < dh) | ((dl == dh) & (ids[lo] <= ids[hi]))
        got, d = np.where(low, ids[lo], ids[hi]), np.minimum(dl, dh)
        ok = d <= tolerance_ms
        return pa.table({"lid": lid[ok], "rid": got[ok], "d": d[ok]})

    out = l.groupBy("_by", "blk").cogroup(r.groupBy("_by", "blk")).applyInArrow(pair, "lid bigint, rid bigint, d bigint")
    return out.select(F.col("lid").alias(left_id), F.col("rid").alias(right_id), F.col("d").alias("distance_ms"))
