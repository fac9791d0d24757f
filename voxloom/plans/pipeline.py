"""The transcript pipeline: segments and turns to speaker blocks, and the two-transcript fusion before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.timeutil import hms
from voxloom.operators import align, chunk, items, windows
from voxloom.operators.intervals import best_overlap, named_speakers
from voxloom.params import Params
from voxloom.session import checkpointed

#: Segments of one recording that start within so many places are merged in one task.
BLOCK_SEQ = 10_000


def labelled_segments(segments: DataFrame, turns: DataFrame, mapping: DataFrame, p: Params = Params()) -> DataFrame:
    """Non-empty segments (lecture_id, id, seq, s, e, text) with ``speaker`` from the turn they overlap most."""
    said = segments.withColumn("text", F.trim("text")).filter("text <> ''")
    best = best_overlap(said, turns, "id", least_ms=p.overlap_min_ms).select("id", F.col("speaker").alias("raw"))
    # Written once: the scans that follow read it several times.
    return checkpointed(named_speakers(said.join(best, "id", "left"), mapping, p.main_speaker, salt=F.col("id")))


def speaker_runs(labelled: DataFrame) -> DataFrame:
    """Neighbouring segments of one speaker merged, numbered by ``run_no`` in each recording."""
    return checkpointed(windows.merge_runs(labelled.withColumn("blk", F.floor(F.col("seq") / BLOCK_SEQ)), ["lecture_id"], "seq", "blk"))


def blocks(runs: DataFrame, p: Params = Params()) -> DataFrame:
    """Final blocks: gap markers put in, long texts cut, times as clock strings; ordered by (run_no, part, chunk_no)."""
    marked = windows.with_gap_markers(runs, ["lecture_id"], p.gap_marker_ms, p.gap_text, p.main_speaker)
    cut = checkpointed(chunk.chunked(checkpointed(marked), "text", p.max_chars, p.repeat_before_long))
    timed = chunk.prorated(cut, ["lecture_id", "run_no", "part"], scale=0.001)
    return timed.select("lecture_id", "run_no", "part", "chunk_no", "speaker", F.col("chunk").alias("text"), hms(F.col("from_s")).alias("start"), hms(F.col("to_s")).alias("end"))


def transcript(segments: DataFrame, turns: DataFrame, mapping: DataFrame, p: Params = Params()) -> DataFrame:
    """Segments, turns and names to blocks."""
    return blocks(speaker_runs(labelled_segments(segments, turns, mapping, p)), p)


def aligned_items(merged: DataFrame) -> DataFrame:
    """Segments of a merged list with the group text that aligns to them and its score.

    The streams of a recording are aligned as a whole, whatever its length.
    """
    first = merged.filter(F.col("type") == items.SEGMENT).select("lecture_id", "id", "pos", F.col("whisper_transcript").alias("text"))
    second = merged.filter(F.col("type") == items.GROUP).select("lecture_id", "id", "pos", F.col("gemini_transcript").alias("text"))
    return align.scored(first, align.matched_text(first, second, "lecture_id", "pos"))


def fused_segments(whisper: DataFrame, gemini: DataFrame, p: Params = Params()) -> DataFrame:
    """Two transcripts of the same recordings as one list of segments (lecture_id, id, seq, s, e, text).

    Items are merged; texts of groups are aligned to segments by tokens; bridges take their neighbours' gap and are pushed
    into imperfect neighbours; what is left is projected to plain segments in order.
    """
    merged = checkpointed(items.merge_items(whisper, gemini))
    aligned = aligned_items(merged).select("id", F.col("gemini_transcript").alias("_g"), "alignment_score")
    # Ids of the two sides may clash; only segments take aligned text.
    full = merged.join(aligned.withColumn("type", F.lit(items.SEGMENT)), ["id", "type"], "left").withColumn("gemini_transcript", F.coalesce("_g", "gemini_transcript")).drop("_g")
    pushed = items.push_bridges(checkpointed(items.interpolate_bridges(checkpointed(full), word_ms=p.word_ms)), perfect=p.perfect_score)
    return checkpointed(items.final_transcript(pushed, p.keep_groups)).select("lecture_id", F.concat_ws(":", "lecture_id", "pos").alias("id"), F.col("pos").alias("seq"), "s", "e", "text")
