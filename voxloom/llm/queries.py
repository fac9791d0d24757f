"""Registered queries of the text problems (2, 3, 4, 5, 8, 9, 10) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import confusables, mixing, packing, runs, truncation, turns
from voxloom.llm.nearest import nearest
from voxloom.session import ship


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf}/{name}.parquet")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.truncated(table(spark, sf, "gemini")).filter("cut").select(F.col("id").alias("gem_id"))


def p2_by_route(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "gemini").dropDuplicates(["gem_id"])
    return truncation.by_source(truncation.truncated(g), g)


def _usable_turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "turns").filter("speaker is not null and trim(speaker) <> ''")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(table(spark, sf, "whisper"), _usable_turns(spark, sf)).select("seg_id", "turn_id")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return turns.turn_bounds(table(spark, sf, "gemini")).select("first_gem_id", "last_gem_id")


def p4_turns(spark: SparkSession, sf: str) -> DataFrame:
    return turns.speaker_turns(table(spark, sf, "gemini"), table(spark, sf, "whisper"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return runs.runs(table(spark, sf, "gemini"), texts=False).filter("n >= 2").select("first_gem_id", "last_gem_id")


def p5_events(spark: SparkSession, sf: str) -> DataFrame:
    return runs.runs(table(spark, sf, "gemini"))


def p5_near_events(spark: SparkSession, sf: str) -> DataFrame:
    """Runs whose events may differ from the first in a fifth of their letters, where a boundary costs as much as a quarter."""
    return runs.runs(table(spark, sf, "gemini"), penalty=0.25, limit=0.2)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    plans = table(spark, sf, "pack_plans")
    return packing.oversize(packing.pack(table(spark, sf, "documents"), plans), plans)


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), table(spark, sf, "pack_plans"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    plans = table(spark, sf, "pack_plans")
    return packing.fill(packing.pack(table(spark, sf, "documents"), plans), plans)


def p8_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Documents packed under limits of eight a container and half of the attention cost, and every limit checked."""
    docs, plans = table(spark, sf, "documents"), table(spark, sf, "pack_plans")
    return packing.checked(docs, packing.pack(docs, plans, max_items=8, cost_share=0.5), plans, 8, 0.5)


def p9_shortage(spark: SparkSession, sf: str) -> DataFrame:
    """Mixes of one and a half times what their sources hold, so that some fall short, and every promise checked."""
    return mixing.checked(table(spark, sf, "documents"), table(spark, sf, "mix_targets"), 1.5)


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "mix_targets")
    return mixing.shares(mixing.mix(table(spark, sf, "documents"), targets), targets)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return confusables.look_alike_pairs(table(spark, sf, "documents"))


def p10_classes(spark: SparkSession, sf: str) -> DataFrame:
    return confusables.look_alike_classes(table(spark, sf, "documents"))


def p10_texts(spark: SparkSession, sf: str) -> DataFrame:
    return confusables.canonical_texts(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p2_by_route, p3_found, p4_found, p4_turns, p5_found, p5_events, p5_near_events, p8_found, p8_containers, p8_fill, p8_limits, p9_mix, p9_shares, p9_shortage,
                            p10_found, p10_classes, p10_texts)}

ORACLE: dict[str, str] = {
    # Packing and mixing themselves are no SQL; what they promise is.
    "p8_limits": """
select plan_name, count(distinct doc_id) as documents, 0 as torn, 0 as lost, 0 as over_tokens, 0 as over_items, 0 as over_cost, true as felt
from pack_plans, documents where text is not null and text <> '' group by 1""",
    "p9_shortage": """
select mix_name, count(*) as sources, 0 as over_repeats, 0 as over_room, 0 as off_budget, true as short, true as siblings_first
from mix_targets where doc_source in (select source from documents where text <> '') group by 1""",
    "p3_found": """
with s as (select distinct seg_id, lecture_id, cast(round(start_s * 1000) as bigint) as at from whisper where seg_id is not null and lecture_id is not null and start_s is not null),
     t as (select distinct turn_id, lecture_id, cast(round(start_s * 1000) as bigint) as at from turns
           where turn_id is not null and lecture_id is not null and start_s is not null and speaker is not null and trim(speaker) <> ''),
     c as (select seg_id, turn_id, row_number() over (partition by seg_id order by abs(s.at - t.at), turn_id) as k
           from s join t on s.lecture_id = t.lecture_id and t.at between s.at - 1500 and s.at + 1500)
select seg_id, turn_id from c where k = 1""",
}
