"""Problem 1: overlapping and gapped intervals, by a distributed sweep line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.scan import block_scan, ms

#: Length of the time blocks into which a key's line is cut.
BLOCK_MS = 1_800_000


def coverage(intervals: DataFrame, keys: list[str], ident: str = "turn_id", start: str = "start_s", end: str = "end_s",
             block_ms: int = BLOCK_MS) -> DataFrame:
    """Covered periods of each key and the gaps between them.

    Returns ``kind`` ('period' or 'gap'), the keys, ``from_ms``, ``to_ms`` and ``members`` (intervals that form the
    period; 0 for a gap). Every interval is a plus event at its start and a minus event at its end. Events of one key and
    millisecond are summed before the shuffle, so repeated times and touching intervals leave one event, and a running
    sum tells how many intervals are open. A period begins where it leaves 0 and ends where it is 0 again.

    Intervals without start, end or any key, blank string keys, and intervals whose end is not after the start do not
    count. Rows that agree in ``ident``, keys and times count once. An empty table gives no rows; further columns are
    ignored. Starts, ends and keys may tie freely.
    """
    kinds = dict(intervals.dtypes)
    here: Column = F.col("_to") > F.col("_from")
    for k in keys:
        here = here & F.col(k).isNotNull()
        if kinds[k] == "string":
            here = here & (F.trim(F.col(k)) != "")
    clean = (intervals.select(*keys, F.col(ident).alias("_id"), ms(F.col(start)).alias("_from"), ms(F.col(end)).alias("_to"))
             .filter(here).dropDuplicates())
    events = (clean.select(*keys, F.explode(F.array(
        F.struct(F.col("_from").alias("at"), F.lit(1).cast("bigint").alias("d"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.col("_to").alias("at"), F.lit(-1).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("n")))).alias("e"))
        .groupBy(*keys, F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"), F.sum("e.n").alias("n"))
        .withColumn("blk", F.floor(F.col("at") / block_ms)))
    open_ = block_scan(events, keys, "blk", [F.col("at")], sums={"active": F.col("d"), "begun": F.col("n")})
    was = F.col("active") - F.col("d")
    edges = (open_.withColumns({"opens": (was == 0) & (F.col("active") > 0), "closes": (was > 0) & (F.col("active") == 0)})
             .filter("opens or closes").drop("d"))
    # Starts, ends and counts only grow along the line, so a running maximum is the last value seen.
    seen = block_scan(edges, keys, "blk", [F.col("at")], maxs={
        "p_from": F.when(F.col("opens"), F.col("at")),
        "p_base": F.when(F.col("opens"), F.col("begun") - F.col("n")),
        "p_end": F.when(F.col("closes"), F.col("at"))})
    row = F.when(F.col("closes"), F.struct(F.lit("period").alias("kind"), F.col("p_from").alias("from_ms"), F.col("at").alias("to_ms"),
                                           (F.col("begun") - F.col("p_base")).alias("members"))
                 ).otherwise(F.struct(F.lit("gap").alias("kind"), F.col("p_end").alias("from_ms"), F.col("at").alias("to_ms"),
                                      F.lit(0).cast("bigint").alias("members")))
    return (seen.select(*keys, row.alias("r")).filter("r.from_ms is not null")
            .select("r.kind", *keys, "r.from_ms", "r.to_ms", "r.members"))
