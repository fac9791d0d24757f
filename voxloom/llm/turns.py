"""Problem 4: transcript records into clean, ordered speaker turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.speech import ORDER, attributed, parse, with_text
from voxloom.operators.intervals import overlap_pairs
from voxloom.operators.scan import block_lag, block_scan, ms
from voxloom.session import checkpointed

#: A record without an end lasts so long.
UNENDED_MS = 10_000


def turn_records(parsed: DataFrame) -> DataFrame:
    """Speech records (of :func:`parse`) with ``turn_no``, from 1 in each lecture; records without words are left out and end no turn.

    Records before the first known speaker of a lecture form turns of a null speaker. Null texts are no speech.
    """
    speech = attributed(parsed).filter("speech").select("lecture_id", ORDER, "blk", "speaker", "led", "start_s", "end_s")
    before = block_lag(speech, ["lecture_id"], "blk", [F.col(ORDER)], {"_was": F.coalesce("speaker", F.lit("")), "_there": F.lit(True)})
    new = F.col("_there").isNull() | (F.col("_was") != F.coalesce("speaker", F.lit("")))
    return block_scan(before, ["lecture_id"], "blk", [F.col(ORDER)], sums={"turn_no": new.cast("bigint")}).drop("_was", "_there")


def turn_bounds(gemini: DataFrame) -> DataFrame:
    """``lecture_id, turn_no, speaker, first_gem_id, last_gem_id, n_records`` of every turn, from aggregates alone."""
    return turn_records(checkpointed(parse(gemini))).groupBy("lecture_id", "turn_no").agg(
        F.max("speaker").alias("speaker"), F.min(ORDER).alias("first_gem_id"), F.max(ORDER).alias("last_gem_id"), F.count("*").alias("n_records"))


def speaker_turns(gemini: DataFrame, whisper: DataFrame) -> DataFrame:
    """Turns in order, with clean text and times taken from the whisper segments they cover.

    ``lecture_id, turn_no, part_no, speaker, first_gem_id, last_gem_id, n_records, text, start_s, end_s, n_segments``. The text
    of a turn that runs over a block of ids comes in parts (``part_no`` from 0, in order; all but a few turns have one).
    Each whisper segment goes to the record of its lecture that overlaps it most (of equal ones the first); a turn starts
    with the earliest and ends with the latest of its segments. A turn that covers none has its records' own times.
    """
    parsed = checkpointed(parse(gemini))
    rows = checkpointed(turn_records(parsed))  # read four times below
    parts = with_text(rows, parsed).groupBy("lecture_id", "turn_no", "blk").agg(
        F.max("speaker").alias("speaker"), F.min(ORDER).alias("first_gem_id"), F.max(ORDER).alias("last_gem_id"), F.count("*").alias("n_records"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(ORDER, "text"))), lambda x: x["text"]), " ").alias("text"))
    own = rows.select("lecture_id", "turn_no", ORDER, ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("_end")).filter("s is not null")
    spans = own.withColumn("e", F.greatest(F.coalesce("_end", F.col("s") + UNENDED_MS), F.col("s") + 1)).drop("_end")
    segs = whisper.select("seg_id", "lecture_id", ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("e")).filter("seg_id is not null and s is not null and e is not null").dropDuplicates(["seg_id"])
    best = overlap_pairs(segs, spans).groupBy("lecture_id", "a_seg_id").agg(F.max_by(F.struct(F.col("b_turn_no").alias("turn_no"), F.col("a_s").alias("s"), F.col("a_e").alias("e")), F.struct("ov", -F.col(f"b_{ORDER}"))).alias("x"))
    times = best.groupBy("lecture_id", F.col("x.turn_no").alias("turn_no")).agg(F.min("x.s").alias("ws"), F.max("x.e").alias("we"), F.count("*").alias("n_segments"))
    span = spans.groupBy("lecture_id", "turn_no").agg(F.min("s").alias("gs"), F.max("e").alias("ge"))
    first = rows.groupBy("lecture_id", "turn_no").agg(F.min("blk").alias("_b0"))
    return (parts.join(first, ["lecture_id", "turn_no"]).join(times, ["lecture_id", "turn_no"], "left").join(span, ["lecture_id", "turn_no"], "left")
            .select("lecture_id", "turn_no", (F.col("blk") - F.col("_b0")).cast("int").alias("part_no"), "speaker", "first_gem_id", "last_gem_id", "n_records", "text",
                    (F.coalesce("ws", "gs") / 1000).alias("start_s"), (F.coalesce("we", "ge") / 1000).alias("end_s"), F.coalesce("n_segments", F.lit(0)).alias("n_segments")))
