"""Ordered scans that do not put a whole key into one task.

A window over ``PARTITION BY key ORDER BY t`` sorts all rows of a key in one task, so one hot key makes one endless
task. The functions here cut every key into blocks by a coarse, monotone function of the order column (a time range,
an id range, hash bits). Each block is summarised by partial aggregation, the small block summaries are scanned per key,
and the carried value is joined back to the rows of the block, where an ordinary window over (key, block) finishes the
scan. Summaries are partial aggregates, so the rows themselves move once, to their (key, block), and not at all if they
already are there, as after another scan of the same blocks. A scan reads its input twice: inputs that are dear to compute
are written first (``session.checkpointed``).

Keys and block must not be null; callers filter or coalesce them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def block_scan(df: DataFrame, keys: list[str], block: str, order: list[Column], sums: dict[str, Column] | None = None,
               maxs: dict[str, Column] | None = None) -> DataFrame:
    """Inclusive running sums and maxima per ``keys`` in the order of (block, order).

    ``sums`` and ``maxs`` map output names to expressions. Null expressions count as 0 in sums and are passed over in
    maxima. ``order`` should be total inside a block; tied rows are scanned in any order.
    """
    sums, maxs = sums or {}, maxs or {}
    rows = df.withColumns({f"_v_{n}": e for n, e in (sums | maxs).items()})
    totals = rows.groupBy(*keys, block).agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums], *[F.max(f"_v_{n}").alias(f"_t_{n}") for n in maxs])
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, block, *[F.sum(f"_t_{n}").over(before).alias(f"_c_{n}") for n in sums],
                          *[F.max(f"_t_{n}").over(before).alias(f"_c_{n}") for n in maxs])
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    out = rows.join(carry, [*keys, block])
    return out.withColumns(
        {n: F.coalesce(F.sum(f"_v_{n}").over(inside), zero) + F.coalesce(F.col(f"_c_{n}"), zero) for n in sums}
        | {n: F.greatest(F.max(f"_v_{n}").over(inside), F.col(f"_c_{n}")) for n in maxs}
    ).drop(*[f"_{p}_{n}" for n in (sums | maxs) for p in "vc"])


def block_lag(df: DataFrame, keys: list[str], block: str, order: list[Column], cols: dict[str, Column]) -> DataFrame:
    """Values of ``cols`` in the row before, per ``keys`` in the order of (block, order); null in the first row.

    ``cols`` maps output names to expressions of the current row.
    """
    packed = F.struct(*[e.alias(n) for n, e in cols.items()])
    rows = df.withColumns({"_o": F.struct(*order), "_p": packed})
    last = rows.groupBy(*keys, block).agg(F.max_by("_p", "_o").alias("_l"))
    carry = last.select(*keys, block, F.lag("_l").over(Window.partitionBy(*keys).orderBy(block)).alias("_c"))
    inside = F.lag("_p").over(Window.partitionBy(*keys, block).orderBy("_o"))
    out = rows.join(carry, [*keys, block]).withColumn("_p", F.coalesce(inside, F.col("_c")))
    return out.withColumns({n: F.col(f"_p.{n}") for n in cols}).drop("_o", "_p", "_c")


def block_last(df: DataFrame, keys: list[str], block: str, order: list[Column], name: str, value: Column,
               inclusive: bool = True) -> DataFrame:
    """``name``: the last non-null ``value`` at or before the row (before it, if not ``inclusive``)."""
    rows = df.withColumns({"_o": F.struct(*order), "_v": value})
    last = rows.groupBy(*keys, block).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_o"))).alias("_l"))
    up = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, block, F.last("_l", ignorenulls=True).over(up).alias("_c"))
    inside = Window.partitionBy(*keys, block).orderBy("_o").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return (rows.join(carry, [*keys, block])
            .withColumn(name, F.coalesce(F.last("_v", ignorenulls=True).over(inside), F.col("_c")))
            .drop("_o", "_v", "_c"))


def block_around(df: DataFrame, keys: list[str], block: str, order: list[Column], value: Column) -> DataFrame:
    """``prev`` and ``next``: the last non-null ``value`` before the row and the first one after it, by one scan of the blocks both ways."""
    rows = df.withColumns({"_o": F.struct(*order), "_v": value})
    there = F.when(F.col("_v").isNotNull(), F.col("_o"))
    ends = rows.groupBy(*keys, block).agg(F.max_by("_v", there).alias("_l"), F.min_by("_v", there).alias("_f"))
    # What lies ahead is looked at in reverse order: a frame that grows is kept up row by row, one that shrinks is made anew for each.
    def before(by: list[str], order: Column) -> WindowSpec:
        return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    carry = ends.select(*keys, block, F.last("_l", ignorenulls=True).over(before(keys, F.asc(block))).alias("_b"), F.last("_f", ignorenulls=True).over(before(keys, F.desc(block))).alias("_n"))
    back, ahead = before([*keys, block], F.asc("_o")), before([*keys, block], F.desc("_o"))
    return (rows.join(carry, [*keys, block])
            .withColumns({"prev": F.coalesce(F.last("_v", ignorenulls=True).over(back), F.col("_b")), "next": F.coalesce(F.last("_v", ignorenulls=True).over(ahead), F.col("_n"))})
            .drop("_o", "_v", "_b", "_n"))


def near_rows(df: DataFrame, keys: list[str], position: str, cols: dict[str, Column], reach: int, block: int = 10_000) -> DataFrame:
    """Rows with ``b<n>_<name>`` and ``f<n>_<name>``: ``cols`` of the n-th row before and after, up to ``reach``; null where there is none.

    ``position`` must count the rows of a key without gaps, so a block of positions knows its borders: rows within reach of one are
    copied over it, and one window over (key, block) sees all neighbours. Rows move once, and nothing is joined.
    """
    pos = F.col(position)
    packed = df.withColumns({"_p": F.struct(*[e.alias(n) for n, e in cols.items()]), "_own": F.floor(pos / block)})
    spread = packed.withColumn("_blk", F.explode(F.array_distinct(F.array("_own", F.floor((pos - reach) / block), F.floor((pos + reach) / block)))))
    w = Window.partitionBy(*keys, "_blk").orderBy(position)
    seen = spread.withColumns({f"_{d}{n}": f("_p", n).over(w) for n in range(1, reach + 1) for d, f in (("b", F.lag), ("f", F.lead))}).filter("_blk = _own")
    return seen.withColumns({f"{d}{n}_{k}": F.col(f"_{d}{n}.{k}") for n in range(1, reach + 1) for d in "bf" for k in cols}).drop("_p", "_own", "_blk", *[f"_{d}{n}" for n in range(1, reach + 1) for d in "bf"])


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], salt: Column, salts: int = 16, how: str = "left") -> DataFrame:
    """Equi join of many rows with a smaller side whose keys are unique, when a few keys hold much of ``left``.

    Rows of ``left`` with one key are spread over ``salts`` tasks by ``salt`` (any column that varies within a key);
    ``right`` is repeated once a salt. Null keys match nothing.
    """
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def ms(seconds: Column) -> Column:
    """Seconds as a double to rounded whole milliseconds; null for null, NaN and infinite values."""
    ok = seconds.isNotNull() & ~F.isnan(seconds) & (F.abs(seconds) < 9e15)
    return F.when(ok, F.round(seconds * 1000).cast("bigint"))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
