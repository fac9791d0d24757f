"""Two transcripts of one recording as one list of items, and the repairs of that list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import words
from voxloom.operators.intervals import overlapping
from voxloom.operators.scan import block_scan, near_rows
from voxloom.operators.windows import neighbours_of_type
from voxloom.session import checkpointed

SEGMENT, GROUP, BRIDGE = "WHISPER_SEGMENT", "WHISPER_GROUP", "BRIDGE_SEGMENT"
#: Items of one recording that start within so many milliseconds are numbered in one task.
BLOCK_MS = 3_600_000


def merge_items(first: DataFrame, second: DataFrame, key: str = "lecture_id") -> DataFrame:
    """``first`` (key, id, s, e, text) and ``second`` (key, id, s, e, text, speaker) as one typed list, ordered by ``pos``.

    Rows of ``second`` that share time with any row of ``first`` are groups, others bridges. The order is by start, end,
    segments before the others, then id; ``pos`` counts from 1 in each key. Rows without key, start or end are left out.
    """
    there = F.col(key).isNotNull() & F.col("s").isNotNull() & F.col("e").isNotNull()
    a, b = first.filter(there), second.filter(there)
    hit = overlapping(b, a, "id", key).withColumn("_hit", F.lit(True))
    left = a.select(key, "id", "s", "e", F.lit(SEGMENT).alias("type"), F.trim(F.coalesce("text", F.lit(""))).alias("whisper_transcript"))
    right = b.join(hit, "id", "left").select(key, "id", "s", "e", F.when(F.col("_hit"), GROUP).otherwise(BRIDGE).alias("type"),
                                             F.trim(F.coalesce("text", F.lit(""))).alias("gemini_transcript"), F.coalesce("speaker", F.lit("")).alias("speaker"))
    both = left.unionByName(right, allowMissingColumns=True).withColumns({"rank": F.when(F.col("type") == SEGMENT, 0).otherwise(1), "blk": F.floor(F.col("s") / BLOCK_MS)})
    # Written once: the scan reads its input twice, and the overlap join is dear.
    return block_scan(checkpointed(both), [key], "blk", [F.col("s"), F.col("e"), F.col("rank"), F.col("id")], sums={"pos": F.lit(1).cast("bigint")}).drop("rank")


def by_position(items: DataFrame, block: int = 10_000) -> DataFrame:
    """Items with ``blk`` as ranges of ``pos``."""
    return items.withColumn("blk", F.floor(F.col("pos") / block))


def interpolate_bridges(items: DataFrame, key: str = "lecture_id", word_ms: int = 300) -> DataFrame:
    """Bridges take the gap between the segments around them; other items stay.

    With a segment on one side only, a bridge lasts ``word_ms`` a word from it (not before 0); with none it keeps its times.
    Neighbouring bridges get the same gap, and an end may lie before its start where segments overlap.
    """
    near = neighbours_of_type(by_position(items), [key], "pos", "blk", F.col("type") == SEGMENT, F.struct("s", "e"))
    spoken = F.size(words(F.col("gemini_transcript"))) * word_ms
    prev, nxt, bridge = F.col("prev"), F.col("next"), F.col("type") == BRIDGE
    s = F.when(prev.isNotNull(), F.col("prev.e")).when(nxt.isNotNull(), F.greatest(F.lit(0), F.col("next.s") - spoken)).otherwise(F.col("s"))
    e = F.when(nxt.isNotNull(), F.col("next.s")).when(prev.isNotNull(), F.col("prev.e") + spoken).otherwise(F.col("e"))
    return near.withColumns({"s": F.when(bridge, s).otherwise(F.col("s")), "e": F.when(bridge, e).otherwise(F.col("e"))}).drop("prev", "next")


def push_bridges(items: DataFrame, key: str = "lecture_id", perfect: float = 9.99, score: str = "alignment_score") -> DataFrame:
    """Text of a bridge between two segments, exactly one of them perfect, goes to the imperfect one; the bridge is dropped.

    A segment takes the text of a bridge before it in front and of one behind it at its end. Since neighbouring bridges
    block each other and scores don't change, one look at the neighbours decides.
    """
    cols = {"t": F.col("type"), "p": F.coalesce(F.col(score), F.lit(0.0)) >= perfect, "g": F.coalesce("gemini_transcript", F.lit(""))}
    laid = near_rows(items, [key], "pos", cols, 2)

    def yes(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    mine = F.coalesce(F.col(score), F.lit(0.0)) >= perfect
    # A bridge leaves if both neighbours are segments, one of them perfect, and it has text.
    goes = yes((F.col("type") == BRIDGE) & (F.col("b1_t") == SEGMENT) & (F.col("f1_t") == SEGMENT) & (F.col("b1_p") != F.col("f1_p")) & (cols["g"] != ""))
    front = yes((F.col("type") == SEGMENT) & ~mine & (F.col("b1_t") == BRIDGE) & (F.col("b2_t") == SEGMENT) & F.col("b2_p") & (F.col("b1_g") != ""))
    back = yes((F.col("type") == SEGMENT) & ~mine & (F.col("f1_t") == BRIDGE) & (F.col("f2_t") == SEGMENT) & F.col("f2_p") & (F.col("f1_g") != ""))
    text = F.trim(F.concat(F.when(front, F.concat(F.col("b1_g"), F.lit(" "))).otherwise(""), cols["g"], F.when(back, F.concat(F.lit(" "), F.col("f1_g"))).otherwise("")))
    return (laid.withColumn("gemini_transcript", F.when(front | back, text).otherwise(F.col("gemini_transcript"))).filter(~goes)
            .drop(*[f"{d}{n}_{k}" for d in "bf" for n in (1, 2) for k in cols]))


def final_transcript(items: DataFrame, keep_groups: bool = False) -> DataFrame:
    """Items as plain segments: text of the second transcript, else of the first; empty ones left out.

    Groups repeat text that segments already have and are left out unless ``keep_groups``.
    """
    text = F.trim(F.coalesce(F.nullif("gemini_transcript", F.lit("")), F.col("whisper_transcript"), F.lit("")))
    out = items.withColumn("text", text).filter("text <> ''")
    return out if keep_groups else out.filter(F.col("type") != GROUP)
