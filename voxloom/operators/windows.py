"""Timelines: window generators, run merging, gap markers, fills and assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.scan import block_around, block_lag, block_last, block_scan


def tumbling(spans: DataFrame, length: str, size_ms: int, least_ms: int) -> DataFrame:
    """Windows of ``size_ms`` from 0 over a span of ``length`` (ms); the last is shorter, and left out below ``least_ms``."""
    n = F.ceil(F.col(length) / size_ms)
    rows = spans.filter(F.col(length) > 0).withColumn("window_no", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    s = F.col("window_no") * size_ms
    return rows.withColumns({"s": s, "e": F.least(s + size_ms, F.col(length))}).filter(F.col("e") - F.col("s") >= least_ms)


def sliding(spans: DataFrame, length: str, size_ms: int, hop_ms: int, least_ms: int, stop: bool = False) -> DataFrame:
    """Windows of ``size_ms`` every ``hop_ms`` while they begin inside the span, clipped at its end.

    Windows must be longer than ``least_ms``; with ``stop`` the first one shorter than ``least_ms`` ends the list (equal is
    long enough), otherwise short ones are only left out.
    """
    n = F.ceil(F.col(length) / hop_ms)
    rows = spans.filter(F.col(length) > 0).withColumn("window_no", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    s = F.col("window_no") * hop_ms
    out = rows.withColumns({"s": s, "e": F.least(s + size_ms, F.col(length))})
    d = F.col("e") - F.col("s")
    # Window lengths never grow along a span, so stopping at the first short one is leaving out all short ones.
    return out.filter(d >= least_ms if stop else d > least_ms)


def label_window(rms: Column, centroid: Column, zcr: Column, energy: float = 0.02, high: float = 3000.0, rough: float = 0.1) -> Column:
    """SILENCE below the energy threshold, KIRTAN for bright and rough sound, else LECTURE."""
    return F.when(rms < energy, "SILENCE").when((centroid > high) & (zcr > rough), "KIRTAN").otherwise("LECTURE")


def window_features(samples: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """``rms`` (root of the mean square) and ``n`` of sample rows grouped by ``keys``."""
    v = F.col(value).cast("double")
    return samples.groupBy(*keys).agg(F.sqrt(F.avg(v * v)).alias("rms"), F.count(v).alias("n"))


def island_numbers(df: DataFrame, keys: list[str], order: str, block: str, same: Column, name: str = "run_no") -> DataFrame:
    """Number runs of equal ``same`` values (null-safe) along ``order`` in each key, from 1; blockwise, so any key may be long."""
    lagged = block_lag(df, keys, block, [F.col(order)], {"_was": same, "_there": F.lit(True)})
    new = F.col("_there").isNull() | ~F.col("_was").eqNullSafe(same)
    return block_scan(lagged, keys, block, [F.col(order)], sums={name: new.cast("bigint")}).drop("_was", "_there")


def merge_runs(segments: DataFrame, keys: list[str], order: str, block: str, speaker: str = "speaker") -> DataFrame:
    """Neighbouring segments of one speaker as one: text joined by spaces, start of the first, **end of the last** row."""
    runs = island_numbers(segments, keys, order, block, F.col(speaker))
    o = F.col(order)
    return runs.groupBy(*keys, "run_no").agg(
        F.first(speaker).alias(speaker), F.min_by("s", o).alias("s"), F.max_by("e", o).alias("e"), F.count("*").alias("n"), F.min(block).alias(block),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(o.alias("o"), F.col("text").alias("t")))), lambda x: x["t"]), " ").alias("text"))


def with_gap_markers(runs: DataFrame, keys: list[str], gap_ms: int, text: str, speaker: str, block: str = "run_blk", block_runs: int = 10_000) -> DataFrame:
    """Runs plus a row for each silence of ``gap_ms`` or more between neighbours, owned by ``speaker``; ``part`` 0 is a marker."""
    cut = runs.withColumn(block, F.floor(F.col("run_no") / block_runs))
    before = block_lag(cut, keys, block, [F.col("run_no")], {"_end": F.col("e")})
    marker = F.struct(F.lit(0).alias("part"), F.lit(speaker).alias("speaker"), F.col("_end").alias("s"), F.col("s").alias("e"), F.lit(text).alias("text"))
    own = F.struct(F.lit(1).alias("part"), F.col("speaker"), F.col("s"), F.col("e"), F.col("text"))
    both = F.when(F.col("s") - F.col("_end") >= gap_ms, F.array(marker, own)).otherwise(F.array(own))
    return before.select(*keys, "run_no", F.explode(both).alias("x")).select(*keys, "run_no", "x.*")


def fill_headings(paragraphs: DataFrame, keys: list[str], order: str, block: str, heading: Column, text: str = "text", unknown: str = "Unknown") -> DataFrame:
    """Paragraphs with ``speaker``, the last heading before each; headings themselves are left out."""
    filled = block_last(paragraphs.withColumn("_h", heading), keys, block, [F.col(order)], "speaker", F.when(F.col("_h"), F.trim(text)))
    return filled.filter(~F.col("_h")).drop("_h").withColumn("speaker", F.coalesce("speaker", F.lit(unknown)))


def neighbours_of_type(items: DataFrame, keys: list[str], order: str, block: str, wanted: Column, value: Column) -> DataFrame:
    """``items`` with ``prev`` and ``next``: ``value`` of the nearest row before and after for which ``wanted`` holds."""
    return block_around(items, keys, block, [F.col(order)], F.when(wanted, value))


def round_robin(items: DataFrame, order: list[str], n: int, blocks: int = 64) -> DataFrame:
    """``items`` dealt to ``n`` workers in order: ``slot`` is the position modulo ``n``; counted in hash blocks of a total order.

    ``order`` must be unique. Positions come from a range of the first order column's ranks, block by block.
    """
    ranged = items.withColumn("_one", F.lit(1))
    edges = F.percentile_approx(F.col(order[0]), [i / blocks for i in range(1, blocks)], 10_000)
    cuts = items.agg(edges.alias("_cuts"))
    placed = ranged.crossJoin(F.broadcast(cuts)).withColumn("_blk", F.size(F.filter("_cuts", lambda c: c < F.col(order[0])))).drop("_cuts").withColumn("_all", F.lit(0))
    ranked = block_scan(placed, ["_all"], "_blk", [F.col(c) for c in order], sums={"_pos": F.col("_one").cast("bigint")})
    return ranked.withColumn("slot", ((F.col("_pos") - 1) % n).cast("int")).withColumn("position", F.col("_pos") - 1).drop("_one", "_blk", "_all", "_pos")


def running_offset(parts: DataFrame, keys: list[str], order: str, amount: str, name: str = "before") -> DataFrame:
    """Sum of ``amount`` over the earlier parts of each (bounded) key, 0 for the first."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(name, F.coalesce(F.sum(amount).over(w), F.lit(0)))
