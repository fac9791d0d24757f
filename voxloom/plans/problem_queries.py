"""Registered queries of the general data problems (1, 6, 7) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import coverage, drift, logs
from voxloom.session import ship


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf}/{name}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return (coverage.coverage(table(spark, sf, "turns"), ["lecture_id", "speaker"]).filter("kind = 'gap' or members >= 2")
            .select("kind", "lecture_id", "speaker", "from_ms", "to_ms"))


def p1_cover_by_speaker(spark: SparkSession, sf: str) -> DataFrame:
    """Time covered and time in gaps of each speaker."""
    return (coverage.coverage(table(spark, sf, "turns"), ["lecture_id", "speaker"]).groupBy("lecture_id", "speaker", "kind")
            .agg(F.count("*").alias("n"), F.sum(F.col("to_ms") - F.col("from_ms")).cast("bigint").alias("total_ms"), F.sum("members").cast("bigint").alias("members")))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return logs.entry_bounds(table(spark, sf, "log_lines"))


def p6_entries(spark: SparkSession, sf: str) -> DataFrame:
    return logs.entries(table(spark, sf, "log_lines"))


def p6_templates(spark: SparkSession, sf: str) -> DataFrame:
    return logs.templates(table(spark, sf, "log_lines"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return drift.schema_changes(drift.ingest(table(spark, sf, "gemini_files")))


def p7_segments(spark: SparkSession, sf: str) -> DataFrame:
    return drift.ingest(table(spark, sf, "gemini_files")).drop("profile")


def p7_promoted(spark: SparkSession, sf: str) -> DataFrame:
    return drift.promote(p7_segments(spark, sf), {"confidence": "double", "lang": "string", "reviewed": "boolean", "words": "array<string>", "chunk": "int"})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_cover_by_speaker, p6_found, p6_entries, p6_templates, p7_found, p7_segments, p7_promoted)}

_PERIODS = """
with t as (select distinct turn_id, lecture_id, speaker, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e
           from turns where lecture_id is not null and start_s is not null and end_s is not null and speaker is not null and trim(speaker) <> '' and trim(lecture_id) <> ''),
     v as (select * from t where e > s),
     m as (select *, max(e) over (partition by lecture_id, speaker order by s, e, turn_id rows between unbounded preceding and 1 preceding) as before from v),
     g as (select *, sum(case when before is null or s > before then 1 else 0 end) over (partition by lecture_id, speaker order by s, e, turn_id rows unbounded preceding) as no from m),
     p as (select lecture_id, speaker, no, min(s) as f, max(e) as t, count(*) as members from g group by all),
     r as (select 'period' as kind, lecture_id, speaker, f as from_ms, t as to_ms, cast(members as bigint) as members from p
           union all
           select 'gap', lecture_id, speaker, lag(t) over (partition by lecture_id, speaker order by no), f, 0 from p)
"""

ORACLE: dict[str, str] = {
    "p1_found": _PERIODS + "select kind, lecture_id, speaker, from_ms, to_ms from r where from_ms is not null and (kind = 'gap' or members >= 2)",
    "p1_cover_by_speaker": _PERIODS + """select lecture_id, speaker, kind, count(*) as n, cast(sum(to_ms - from_ms) as bigint) as total_ms,
        cast(sum(members) as bigint) as members from r where from_ms is not null group by lecture_id, speaker, kind""",
}
