"""Interval-overlap joins by time bins: existence, best match, speaker lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.scan import salted_join

BIN_MS = 30_000
#: An interval over more bins than this is long; it meets the other side in bins so many times as wide.
MOST_BINS = 120


def _met(a: DataFrame, b: DataFrame, key: str, bin_ms: int, how: str) -> DataFrame:
    """Rows of two sides whose [s, e) share time, by equi joins on (key, bin).

    Two short intervals meet in fine bins, long ones meet all in coarse bins, cut to where the other side has anything at
    all in that key, so an interval that claims to last for ever costs no more bins than the key is long. ``how`` is 'inner' (each
    pair once, in the first bin it shares) or 'left_semi' (a row once a bin, without making pairs).
    """
    wide = bin_ms * MOST_BINS

    def side(df: DataFrame, p: str) -> DataFrame:
        named = df.select(F.col(key).alias(key if p == "a" else "_key"), *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c != key])
        s, e = F.col(f"{p}_s"), F.col(f"{p}_e")
        return named.filter(F.col(named.columns[0]).isNotNull() & (e > s)).withColumn(f"_{p}_long", F.floor(e / bin_ms) - F.floor(s / bin_ms) >= MOST_BINS)

    x, y = side(a, "a"), side(b, "b")
    first, last = F.greatest("a_s", "b_s"), F.least("a_e", "b_e")

    def bins(df: DataFrame, p: str, width: int, lo: str | None = None, hi: str | None = None) -> DataFrame:
        s, e = F.col(lo or f"{p}_s"), F.col(hi or f"{p}_e")
        return df.withColumn(f"_{p}_bin", F.explode(F.sequence(F.floor(s / width), F.floor((e - 1) / width))))

    def cut(df: DataFrame, p: str, other: DataFrame, q: str) -> DataFrame:
        """Long rows in coarse bins, within what the other side covers."""
        k, j = df.columns[0], other.columns[0]
        reach = other.groupBy(F.col(j).alias(k)).agg(F.min(f"{q}_s").alias("_lo"), F.max(f"{q}_e").alias("_hi"))
        inside = df.filter(f"_{p}_long").join(reach, k).withColumns({"_lo": F.greatest("_lo", f"{p}_s"), "_hi": F.least("_hi", f"{p}_e")}).filter("_hi > _lo")
        return bins(inside, p, wide, "_lo", "_hi").drop("_lo", "_hi")

    def join(l: DataFrame, r: DataFrame, width: int) -> DataFrame:
        on = (F.col(key) == F.col("_key")) & (F.col("_a_bin") == F.col("_b_bin")) & (last > first)
        if how == "left_semi":
            return l.join(r, on, how).drop("_a_bin", "_a_long")
        return l.join(r, on & (F.col("_a_bin") == F.floor(first / width)), how).drop("_key", "_a_bin", "_b_bin", "_a_long", "_b_long")

    short = join(bins(x.filter("not _a_long"), "a", bin_ms), bins(y.filter("not _b_long"), "b", bin_ms), bin_ms)
    long_a, long_b = cut(x, "a", y, "b"), cut(y, "b", x, "a")
    short_b = bins(y.filter("not _b_long"), "b", wide)
    return (short.unionByName(join(long_a, short_b.unionByName(long_b), wide))
            .unionByName(join(bins(x.filter("not _a_long"), "a", wide), long_b, wide)))


def overlap_pairs(a: DataFrame, b: DataFrame, key: str = "lecture_id", bin_ms: int = BIN_MS) -> DataFrame:
    """Pairs of rows of one key whose [s, e) intervals (milliseconds) share time, with ``ov``, their shared length.

    Columns of ``a`` are prefixed ``a_`` and those of ``b`` ``b_``, but for the key. Both sides are cut into bins and meet
    by an equi join on (key, bin), so a hot key spreads over its bins; a pair that shares several bins is kept in the first
    one only. Null or empty intervals overlap nothing.
    """
    return _met(a, b, key, bin_ms, "inner").withColumn("ov", F.least("a_e", "b_e") - F.greatest("a_s", "b_s"))


def overlapping(a: DataFrame, b: DataFrame, ident: str, key: str = "lecture_id") -> DataFrame:
    """``ident`` of the rows of ``a`` that share time with any row of ``b`` of their key; no pairs are made."""
    return _met(a.select(key, ident, "s", "e"), b.select(key, "s", "e"), key, BIN_MS, "left_semi").select(F.col(f"a_{ident}").alias(ident)).distinct()


def best_overlap(segments: DataFrame, turns: DataFrame, ident: str, label: str = "speaker", order: str = "seq", least_ms: int = 500, key: str = "lecture_id") -> DataFrame:
    """``ident, label, ov``: for each segment the label of the one turn it shares most time with.

    Of equal ones the first by ``order`` counts. Segments whose best turn shares less than ``least_ms`` are left out.
    """
    pairs = overlap_pairs(segments.select(key, ident, "s", "e"), turns.select(key, label, order, "s", "e"), key)
    best = pairs.groupBy(F.col(f"a_{ident}").alias(ident)).agg(
        F.max("ov").alias("ov"), F.max_by(f"b_{label}", F.struct(F.col("ov"), -F.col(f"b_{order}"))).alias(label))
    return best.filter(F.col("ov") >= least_ms).select(ident, label, "ov")


def named_speakers(segments: DataFrame, mapping: DataFrame, main: str, raw: str = "raw", key: str = "lecture_id", local: str = "local_id", name: str = "speaker",
                   salt: Column | None = None) -> DataFrame:
    """``segments`` with ``speaker``: the mapped name of the raw label; the main speaker for null or unmapped labels."""
    names = mapping.select(key, F.col(local).alias(raw), F.col(name).alias("_name")).filter(f"{key} is not null and {raw} is not null").dropDuplicates([key, raw])
    return salted_join(segments, names, [key, raw], F.monotonically_increasing_id() if salt is None else salt).withColumn("speaker", F.coalesce("_name", F.lit(main))).drop("_name")
