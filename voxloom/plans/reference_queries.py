"""Registered queries of the transcript operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.functions import text as tx
from voxloom.functions import vectors as vx
from voxloom.functions.timeutil import clock_seconds, hms
from voxloom.operators import chunk, cluster, incremental, intervals, items, match, relational, search, windows
from voxloom.operators.scan import block_scan, ms
from voxloom.params import Params
from voxloom.plans import pipeline
from voxloom.session import checkpointed, ship
from voxloom.sources import files, sinks
from voxloom.streaming import streams

P = Params()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, queries: dict | None = None, oracle: dict | None = None):
    """Register a query, and its SQL, in this module's tables or those given."""
    def add(f):
        (QUERIES if queries is None else queries)[f.__name__] = f
        if sql:
            (ORACLE if oracle is None else oracle)[f.__name__] = sql
        return f
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf}/{name}.parquet")


def whisper(spark: SparkSession, sf: str) -> DataFrame:
    """Segments once each: id, lecture_id, seq, s, e (milliseconds, 0 where missing), text."""
    return (table(spark, sf, "whisper").select(F.col("seg_id").alias("id"), "lecture_id", "seq", F.coalesce(ms(F.col("start_s")), F.lit(0)).alias("s"), F.coalesce(ms(F.col("end_s")), F.lit(0)).alias("e"),
                                               F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["id"]))


def timed_whisper(spark: SparkSession, sf: str) -> DataFrame:
    """As :func:`whisper`, without segments that lack a time."""
    return (table(spark, sf, "whisper").select(F.col("seg_id").alias("id"), "lecture_id", "seq", ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("e"), "text")
            .filter("s is not null and e is not null").dropDuplicates(["id"]))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "turns").select("turn_id", "lecture_id", "seq", ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("e"), "speaker")
            .filter("s is not null and e is not null and speaker is not null").dropDuplicates(["turn_id"]))


def gemini(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "gemini").select(F.col("gem_id").alias("id"), "lecture_id", ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("e"), "text", "speaker")
            .filter("s is not null and e is not null").dropDuplicates(["id"]))


W = """w as (select distinct seg_id as id, lecture_id, seq, cast(coalesce(round(start_s * 1000), 0) as bigint) as s, cast(coalesce(round(end_s * 1000), 0) as bigint) as e,
  coalesce(text, '') as text from whisper)"""
WT = """w as (select distinct seg_id as id, lecture_id, seq, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e, text
  from whisper where start_s is not null and end_s is not null)"""
T = """t as (select distinct turn_id, lecture_id, seq, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e, speaker
  from turns where start_s is not null and end_s is not null and speaker is not null)"""
G = """g as (select distinct gem_id as id, lecture_id, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e, text, speaker
  from gemini where start_s is not null and end_s is not null)"""
LABELLED = f"""{W}, {T},
 o as (select w.id, t.speaker, t.seq, least(w.e, t.e) - greatest(w.s, t.s) as ov from w join t on w.lecture_id = t.lecture_id where least(w.e, t.e) > greatest(w.s, t.s) and w.e > w.s and t.e > t.s),
 b as (select id, speaker as raw, ov from (select *, row_number() over (partition by id order by ov desc, seq) as k from o) where k = 1 and ov >= 500),
 m as (select distinct lecture_id, local_id, speaker from speaker_map),
 l as (select w.id, w.lecture_id, w.seq, w.s, w.e, trim(w.text) as text, coalesce(m.speaker, 'MAIN') as speaker from w left join b on w.id = b.id
       left join m on m.lecture_id = w.lecture_id and m.local_id = b.raw where trim(w.text) <> '')"""
RUNS = LABELLED + """,
 c as (select *, case when row_number() over (partition by lecture_id order by seq) = 1 or speaker is distinct from lag(speaker) over (partition by lecture_id order by seq) then 1 else 0 end as n from l),
 i as (select *, sum(n) over (partition by lecture_id order by seq) as run_no from c),
 r as (select lecture_id, run_no, max(speaker) as speaker, arg_min(s, seq) as s, arg_max(e, seq) as e, string_agg(text, ' ' order by seq) as text, count(*) as n from i group by 1, 2)"""


def _hms(x: str) -> str:
    return f"printf('%02d:%02d:%02d', {x} // 3600000, ({x} // 60000) % 60, ({x} // 1000) % 60)"


def labelled(spark, sf):
    return pipeline.labelled_segments(whisper(spark, sf), turns(spark, sf), table(spark, sf, "speaker_map"), P)


@query(f"""with {RUNS},
 q as (select *, lag(e) over (partition by lecture_id order by run_no) as before from r)
select lecture_id, cast(run_no as bigint) as run_no, 1 as part, speaker, text, {_hms('s')} as start, {_hms('e')} as "end" from q
union all select lecture_id, cast(run_no as bigint), 0, 'MAIN', '[KIRTAN]', {_hms('before')}, {_hms('s')} from q where s - before >= 108000""")
def flagship_blocks(spark, sf):
    """Who said what and when: best overlapping turn, speaker names, merged runs, gap markers, clock times."""
    runs = pipeline.speaker_runs(labelled(spark, sf))
    marked = windows.with_gap_markers(runs, ["lecture_id"], P.gap_marker_ms, P.gap_text, P.main_speaker)
    return marked.select("lecture_id", "run_no", "part", "speaker", "text", hms(F.col("s") / 1000).alias("start"), hms(F.col("e") / 1000).alias("end"))


@query()
def pipeline_blocks(spark, sf):
    """The whole chain: two transcripts fused, speakers assigned, runs merged, gaps marked, long texts cut."""
    fused = pipeline.fused_segments(timed_whisper(spark, sf), gemini(spark, sf), P)
    return pipeline.transcript(fused, turns(spark, sf), table(spark, sf, "speaker_map"), P)


@query()
def block_documents(spark, sf):
    """One JSON document of speaker runs a recording."""
    runs = pipeline.speaker_runs(labelled(spark, sf))
    return sinks.block_json(runs.withColumnRenamed("run_no", "block_no"))


@query(f"""with {LABELLED} select id, speaker from l""")
def speaker_of_segment(spark, sf):
    return labelled(spark, sf).select("id", "speaker")


@query(f"""with {RUNS} select lecture_id, cast(run_no as bigint) as run_no, speaker, s, e, n from r""")
def speaker_runs(spark, sf):
    return pipeline.speaker_runs(labelled(spark, sf)).select("lecture_id", "run_no", "speaker", "s", "e", "n")


@query(f"""with {WT}, {G} select g.id, case when exists (select 1 from w where w.lecture_id = g.lecture_id and least(w.e, g.e) > greatest(w.s, g.s) and w.e > w.s and g.e > g.s)
  then 'WHISPER_GROUP' else 'BRIDGE_SEGMENT' end as type from g where g.lecture_id is not null""")
def overlap_semi(spark, sf):
    g = gemini(spark, sf).filter("lecture_id is not null")
    hit = intervals.overlapping(g, timed_whisper(spark, sf), "id").withColumn("hit", F.lit(True))
    return g.join(hit, "id", "left").select("id", F.when(F.col("hit"), items.GROUP).otherwise(items.BRIDGE).alias("type"))


ITEMS = f"""{WT}, {G},
 u as (select lecture_id, id, s, e, 0 as rank, 'WHISPER_SEGMENT' as type, trim(coalesce(text, '')) as wt, null as gt from w where lecture_id is not null
       union all select lecture_id, id, s, e, 1, case when exists (select 1 from w where w.lecture_id = g.lecture_id and least(w.e, g.e) > greatest(w.s, g.s) and w.e > w.s and g.e > g.s)
       then 'WHISPER_GROUP' else 'BRIDGE_SEGMENT' end, null, trim(coalesce(text, '')) from g where lecture_id is not null),
 it as (select *, row_number() over (partition by lecture_id order by s, e, rank, id) as pos from u)"""


def merged(spark, sf):
    return items.merge_items(timed_whisper(spark, sf), gemini(spark, sf))


@query(f"with {ITEMS} select lecture_id, pos, type, id, s, e from it")
def merge_items(spark, sf):
    return merged(spark, sf).select("lecture_id", "pos", "type", "id", "s", "e")


UNICODE_SPACE = r"[\s\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{000B}]+"
_SPLIT = r"'[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), {_SPLIT}), lambda z: z <> '')"


@query(f"""with {ITEMS},
 n as (select *, last_value(case when type = 'WHISPER_SEGMENT' then e end ignore nulls) over (partition by lecture_id order by pos rows between unbounded preceding and 1 preceding) as pe,
       first_value(case when type = 'WHISPER_SEGMENT' then s end ignore nulls) over (partition by lecture_id order by pos rows between 1 following and unbounded following) as ns from it)
select lecture_id, pos, case when pe is not null then pe when ns is not null then greatest(0, ns - 300 * len({_words('gt')})) else s end as s,
 case when ns is not null then ns when pe is not null then pe + 300 * len({_words('gt')}) else e end as e from n where type = 'BRIDGE_SEGMENT'""")
def bridge_interpolate(spark, sf):
    done = items.interpolate_bridges(checkpointed(merged(spark, sf)), word_ms=P.word_ms)
    return done.filter(F.col("type") == items.BRIDGE).select("lecture_id", "pos", F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"))


@query(f"""with {ITEMS},
 z as (select *, type = 'WHISPER_SEGMENT' as sg, case when type = 'WHISPER_SEGMENT' and length(wt) % 2 = 0 then 10.0 else 5.0 end >= 9.99 as p, coalesce(gt, '') as gx from it),
 n as (select *, lag(sg) over v as s1, lag(type) over v as t1, lag(p) over v as p1, lag(gx) over v as g1, lag(sg, 2) over v as s2, lag(p, 2) over v as p2,
       lead(sg) over v as s3, lead(type) over v as t3, lead(p) over v as p3, lead(gx) over v as g3, lead(sg, 2) over v as s4, lead(p, 2) over v as p4 from z window v as (partition by lecture_id order by pos)),
 f as (select *, coalesce(type = 'BRIDGE_SEGMENT' and s1 and s3 and p1 <> p3 and gx <> '', false) as goes,
       coalesce(sg and not p and t1 = 'BRIDGE_SEGMENT' and s2 and p2 and g1 <> '', false) as front, coalesce(sg and not p and t3 = 'BRIDGE_SEGMENT' and s4 and p4 and g3 <> '', false) as back from n)
select lecture_id, pos, type, case when front or back then trim(case when front then g1 || ' ' else '' end || gx || case when back then ' ' || g3 else '' end) else gt end as gemini_transcript from f where not goes""")
def greedy_push(spark, sf):
    """Bridges pushed where a segment counts as perfect if its text has an even length."""
    scored = merged(spark, sf).withColumn("alignment_score", F.when((F.col("type") == items.SEGMENT) & (F.length("whisper_transcript") % 2 == 0), 10.0).otherwise(5.0))
    return items.push_bridges(scored).select("lecture_id", "pos", "type", "gemini_transcript")


@query()
def alignment_score(spark, sf):
    return pipeline.aligned_items(checkpointed(merged(spark, sf))).select("id", "gemini_transcript", "alignment_score")


@query()
def final_transcript(spark, sf):
    return pipeline.fused_segments(timed_whisper(spark, sf), gemini(spark, sf), P)


@query("""with h as (select line_id, log_name, line_no, raw_line, coalesce(starts_with(raw_line, '=== '), false) as hd from (select distinct line_id, log_name, line_no, raw_line from log_lines)),
 f as (select *, last_value(case when hd then trim(raw_line) end ignore nulls) over (partition by log_name order by line_no rows unbounded preceding) as speaker from h)
select line_id, coalesce(speaker, 'Unknown') as section from f where not hd""")
def heading_fill(spark, sf):
    """Each log line with the banner it stands under."""
    lines = table(spark, sf, "log_lines").select("line_id", "log_name", "line_no", F.col("raw_line").alias("text")).dropDuplicates().withColumn("blk", F.floor(F.col("line_no") / 10_000))
    return windows.fill_headings(lines, ["log_name"], "line_no", "blk", F.coalesce(F.col("text").startswith("=== "), F.lit(False))).select("line_id", F.col("speaker").alias("section"))


_SPANS = "a as (select audio_id, cast(round(duration_s * 1000) as bigint) as d from audio_files where duration_s is not null)"


def spans(spark, sf):
    return table(spark, sf, "audio_files").select("audio_id", ms(F.col("duration_s")).alias("d"))


@query(f"""with {_SPANS} select audio_id, n as window_no, n * 54000 as s, least(n * 54000 + 54000, d) as e from a, unnest(range(0, cast(ceil(d / 54000) as bigint))) as x(n)
  where d > 0 and least(n * 54000 + 54000, d) - n * 54000 >= 1000""")
def tumbling_54s(spark, sf):
    return windows.tumbling(spans(spark, sf), "d", P.chunk_ms, P.chunk_min_ms).select("audio_id", "window_no", "s", "e")


def _slide(test: str) -> str:
    return f"""with {_SPANS} select audio_id, n as window_no, n * 15000 as s, least(n * 15000 + 30000, d) as e from a, unnest(range(0, cast(ceil(d / 15000) as bigint))) as x(n)
  where d > 0 and least(n * 15000 + 30000, d) - n * 15000 {test}"""


@query(_slide("> 500"))
def sliding_30_15(spark, sf):
    return windows.sliding(spans(spark, sf), "d", P.window_ms, P.hop_ms, P.window_min_ms).select("audio_id", "window_no", "s", "e")


@query(_slide(">= 1000"))
def sliding_until_short(spark, sf):
    return windows.sliding(spans(spark, sf), "d", P.window_ms, P.hop_ms, P.chunk_min_ms, stop=True).select("audio_id", "window_no", "s", "e")


@query("""select window_id, case when rms < 0.02 then 'SILENCE' when centroid > 3000 and zcr > 0.1 then 'KIRTAN' else 'LECTURE' end as label from kirtan_windows""")
def classify_windows(spark, sf):
    return table(spark, sf, "kirtan_windows").select("window_id", windows.label_window(F.col("rms"), F.col("centroid"), F.col("zcr")).alias("label"))


@query("select window_id, lecture_id from kirtan_windows where upper(label) = 'LECTURE'")
def lecture_windows(spark, sf):
    return table(spark, sf, "kirtan_windows").filter(F.upper("label") == "LECTURE").select("window_id", "lecture_id")


@query("""select lecture_id, count(*) as windows, count(*) filter (upper(label) = 'LECTURE') as lecture, count(*) filter (upper(label) = 'KIRTAN') as kirtan,
  count(*) filter (label is null) as unlabelled from kirtan_windows group by 1""")
def label_counts(spark, sf):
    u = F.upper("label")
    return table(spark, sf, "kirtan_windows").groupBy("lecture_id").agg(F.count("*").alias("windows"), F.count_if(u == "LECTURE").alias("lecture"), F.count_if(u == "KIRTAN").alias("kirtan"), F.count_if(F.col("label").isNull()).alias("unlabelled"))


@query("select user_id, event_type, round(sqrt(avg(value * value)), 4) as rms, count(value) as n from events group by 1, 2")
def rms_features(spark, sf):
    return windows.window_features(table(spark, sf, "events"), ["user_id", "event_type"]).withColumn("rms", F.round("rms", 4))


@query(f"with {T} select turn_id, {_hms('s')} as starts, {_hms('e')} as ends from t")
def hms_times(spark, sf):
    return turns(spark, sf).select("turn_id", hms(F.col("s") / 1000).alias("starts"), hms(F.col("e") / 1000).alias("ends"))


@query(f"with {T} select turn_id, cast(s // 1000 as double) as seconds from t")
def parse_clock(spark, sf):
    """Clock strings back to seconds."""
    return turns(spark, sf).select("turn_id", clock_seconds(hms(F.col("s") / 1000)).alias("seconds"))


@query(f"""select doc_id, cast(len(list_filter(list_transform({_words('text')}, lambda z: regexp_replace(lower(z), '[^\\p{{L}}\\p{{N}}_]', '', 'g')), lambda z: z <> '')) as integer) as n from documents""")
def align_token_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(tx.align_tokens(F.col("text"))).alias("n"))


@query("""select doc_id, cast(len(list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]', ' ', 'g'), ' '), lambda z: z <> '')) as integer) as n from documents""")
def eval_token_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(tx.eval_tokens(F.col("text"))).alias("n"))


@query(r"""select doc_id, cast(len(string_split(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1))) as integer) as n from documents where text is not null""")
def sentence_counts(spark, sf):
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", F.size(tx.sentences(F.col("text"))).alias("n"))


@query(f"with {T} select turn_id, s as s_ms, e as e_ms, regexp_replace(speaker, '^speaker_', '') as label from t where regexp_matches(speaker, '^(speaker_)?[A-Za-z0-9_]+$')")
def diar_lines(spark, sf):
    """Turns written as text lines and read back."""
    lines = sinks.turn_lines(turns(spark, sf).select(F.col("turn_id").cast("string").alias("lecture_id"), (F.col("s") / 1000).alias("start"), (F.col("e") / 1000).alias("end"), "speaker"))
    f = tx.diarization_line(F.col("value"))
    return lines.select(F.col("lecture_id").cast("bigint").alias("turn_id"), ms(f["start"]).alias("s_ms"), ms(f["end"]).alias("e_ms"), f["speaker"].alias("label")).filter("label is not null")


@query(r"""with f as (select distinct file_id, regexp_replace(body, '^\s+|\s+$', '', 'g') as b from gemini_files where body is not null)
select file_id, cast(length(case when starts_with(b, '```') then regexp_replace(regexp_replace(regexp_replace(b, '^```[A-Za-z0-9_]*\n?', ''), '`+$', ''), '^\s+|\s+$', '', 'g') else trim(b) end) as integer) as n from f""")
def strip_fences(spark, sf):
    return table(spark, sf, "gemini_files").filter("body is not null").select("file_id", F.length(tx.strip_fence(F.col("body"))).alias("n")).distinct()


def _perturbed(spark, sf):
    """Evaluation tokens of each document, and the same without every seventh."""
    t = table(spark, sf, "documents").select("doc_id", tx.eval_tokens(F.col("text")).alias("a"))
    return t.withColumn("b", F.filter("a", lambda x, i: (i + 1) % 7 != 0))


_PERTURBED = """d as (select doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]', ' ', 'g'), ' '), lambda z: z <> '') as a from documents),
 e as (select doc_id, a, list_filter(a, lambda z, i: i % 7 <> 0) as b from d)"""


@query(f"""with {_PERTURBED}, k as (select doc_id, len(list_distinct(a)) as x, len(list_distinct(b)) as y, len(list_intersect(list_distinct(a), list_distinct(b))) as c from e)
select doc_id, round(case when x = 0 or y = 0 or c = 0 then 0.0 else 2.0 * (cast(c as double) / y) * (cast(c as double) / x) / (cast(c as double) / y + cast(c as double) / x) end, 6) as f1 from k""")
def set_f1(spark, sf):
    return _perturbed(spark, sf).select("doc_id", F.round(tx.set_f1(F.col("a"), F.col("b")), 6).alias("f1"))


@query(f"""with {W}, d as (select id, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]', ' ', 'g'), ' '), lambda z: z <> '') as a from w),
 h as (select id, a, flatten(list_transform(a, lambda z, i: case when i % 7 = 0 then cast([] as varchar[]) when i % 11 = 0 then [z, 'yy'] when i % 5 = 0 then ['zz'] else [z] end)) as b from d),
 v as (select id, a, b, list_distinct(list_concat(a, b)) as u from h)
select id, round(case when len(a) = 0 then 0.0 else cast(levenshtein(array_to_string(list_transform(a, lambda z: chr(cast(33 + list_position(u, z) as integer))), ''), array_to_string(list_transform(b, lambda z: chr(cast(33 + list_position(u, z) as integer))), '')) as double) / len(a) end, 6) as wer from v""")
def wer(spark, sf):
    """Word error rate of segments against themselves with words left out, put in and changed."""
    t = whisper(spark, sf).select("id", tx.eval_tokens(F.col("text")).alias("a"))
    said = F.flatten(F.transform("a", lambda x, i: F.when((i + 1) % 7 == 0, F.array().cast("array<string>")).when((i + 1) % 11 == 0, F.array(x, F.lit("yy"))).when((i + 1) % 5 == 0, F.array(F.lit("zz"))).otherwise(F.array(x))))
    return t.select("id", F.round(tx.wer(F.col("a"), said), 6).alias("wer"))


def _documents(spark, sf):
    """The segments of a whole recording as one document to be matched; written once, as every side of every match reads them."""
    w = timed_whisper(spark, sf).filter("trim(text) <> '' and lecture_id is not null")
    return checkpointed(w.select(F.col("lecture_id").alias("part"), F.col("id").alias("turn"), F.lit("MAIN").alias("speaker"), "text"))


@query()
def greedy_match(spark, sf):
    """Segments matched to copies that lack every seventh word and stand in reverse order."""
    t = _documents(spark, sf)
    p = t.select("part", (-F.col("turn")).alias("turn"), F.array_join(F.filter(tx.eval_tokens(F.col("text")), lambda x, i: (i + 1) % 7 != 0), " ").alias("text"))
    return match.greedy_match(t, p, "part")


@query()
def evaluation_report(spark, sf):
    t = _documents(spark, sf)
    drop = lambda n: t.select("part", "turn", F.array_join(F.filter(tx.eval_tokens(F.col("text")), lambda x, i: (i + 1) % n != 0), " ").alias("text"))
    return match.report(t, {"A": drop(7), "B": drop(3)}, "part")


@query()
def chunk_2800(spark, sf):
    return chunk.chunked(table(spark, sf, "documents").select("doc_id", "text"), "text", P.max_chars).select("doc_id", "chunk_no", "chunk")


@query(r"""with d as (select doc_id, list_transform(string_split(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1)), lambda z: {'n': 0, 'cur': z}) as l from documents where text is not null),
 f as (select doc_id, list_reduce(l, lambda a, z: case when length(a.cur) + length(z.cur) + 1 <= 2800 then {'n': a.n, 'cur': case when a.cur = '' then z.cur else a.cur || ' ' || z.cur end}
   else {'n': a.n + case when a.cur = '' then 0 else 1 end, 'cur': z.cur} end) as r from d)
select doc_id, cast(r.n + case when r.cur = '' then 0 else 1 end as integer) as chunks, cast(length(r.cur) as integer) as last_length from f""")
def chunk_fold(spark, sf):
    """Sentences of each document packed by a fold in the JVM: number of chunks and length of the last."""
    d = chunk.chunk_counts(table(spark, sf, "documents").filter("text is not null").select("doc_id", "text"), "text", P.max_chars)
    return d.select("doc_id", F.size("chunks").alias("chunks"), F.coalesce(F.length(F.try_element_at("chunks", F.lit(-1))), F.lit(0)).alias("last_length"))


@query(r"""with g as (select distinct gem_id, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e, trim(text) as text from gemini
   where start_s is not null and end_s is not null and end_s >= start_s and trim(text) <> ''),
 p as (select gem_id, s, e, string_split(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1)) as l from g),
 c as (select gem_id, s, e, k - 1 as chunk_no, l[k] as chunk from p, unnest(range(1, len(l) + 1)) as x(k)),
 z as (select *, sum(length(chunk)) over (partition by gem_id) as total, coalesce(sum(length(chunk)) over (partition by gem_id order by chunk_no rows between unbounded preceding and 1 preceding), 0) as before from c)
select gem_id, cast(chunk_no as integer) as chunk_no, cast(round(s + before / cast(greatest(total, 1) as double) * (e - s)) as bigint) as from_ms, chunk from z""")
def prorated_times(spark, sf):
    """Sentences of the second transcript with a share of its time."""
    g = table(spark, sf, "gemini").select("gem_id", ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("e"), F.trim("text").alias("text")).filter("e >= s and text <> ''").dropDuplicates(["gem_id"])
    c = g.select("gem_id", "s", "e", F.posexplode(tx.sentences(F.col("text"))).alias("chunk_no", "chunk"))
    return chunk.prorated(c, ["gem_id"]).select("gem_id", "chunk_no", F.round("from_s").cast("bigint").alias("from_ms"), "chunk")


@query("""select label, k - 1 as dim, round(avg(cast(embedding[k] as double)), 6) as mean, count(*) as n from embeddings, unnest(range(1, len(embedding) + 1)) as x(k) group by 1, 2""")
def centroids(spark, sf):
    c = cluster.centroids(table(spark, sf, "embeddings").select("label", F.col("embedding").alias("emb")), ["label"])
    return c.select("label", F.posexplode("centroid").alias("dim", "mean"), F.col("size").alias("n")).select("label", F.col("dim").cast("bigint").alias("dim"), F.round("mean", 6).alias("mean"), "n")


@query("""with q as (select vec_id, cast(embedding as double[]) as e from embeddings), r as (select a.vec_id as query, b.vec_id as neighbour, 1 - list_cosine_similarity(a.e, b.e) as d from q a join q b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0)
select query, neighbour, round(d, 6) as distance from (select *, row_number() over (partition by query order by d, neighbour) as k from r) where k = 1""")
def cosine_nearest(spark, sf):
    e = table(spark, sf, "embeddings")
    return search.nearest_vectors(e, e.filter("vec_id % 50 = 0")).withColumn("distance", F.round("distance", 6))


@query("""select vec_id, len(embedding) as dims, round(sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * cast(x as double)))), 4) as norm,
 round(embedding[1] / sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * cast(x as double)))), 4) as first from embeddings where len(embedding) > 0""")
def normalized_vectors(spark, sf):
    e = table(spark, sf, "embeddings").filter(vx.is_valid(F.col("embedding")))
    return e.select("vec_id", F.size("embedding").cast("bigint").alias("dims"), F.round(vx.norm(F.col("embedding")), 4).alias("norm"), F.round(F.element_at(vx.l2_normalize(F.col("embedding")), 1), 4).alias("first"))


@query()
def local_cluster(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("label").alias("lecture_id"), F.col("vec_id").alias("seg_id"), F.col("embedding").alias("emb"))
    return cluster.local_clusters(e, 0.7)


@query()
def global_cluster(spark, sf):
    """Speaker names from clusters of clusters."""
    e = table(spark, sf, "embeddings").select(F.col("label").alias("lecture_id"), F.col("vec_id").alias("seg_id"), F.col("embedding").alias("emb"))
    local = cluster.local_clusters(e, 0.7)
    c = cluster.centroids(local.join(e, ["lecture_id", "seg_id"]), ["lecture_id", "cluster"])
    return cluster.speaker_names(cluster.global_clusters(c, 0.6), P.main_speaker)


@query("""with c as (select label as lecture_id, vec_id % 7 as cluster, vec_id % 3 as g, count(*) as size from embeddings group by 1, 2, 3),
 t as (select g from (select g, sum(size) as n from c group by 1) order by n desc, g limit 1)
select lecture_id, cast(cluster as varchar) as local_id, case when c.g = t.g then 'MAIN' else 'Audience ' || cast(c.g as varchar) end as speaker from c, t""")
def cluster_mode(spark, sf):
    c = table(spark, sf, "embeddings").groupBy(F.col("label").alias("lecture_id"), (F.col("vec_id") % 7).alias("cluster"), (F.col("vec_id") % 3).alias("global")).agg(F.count("*").alias("size"))
    return cluster.speaker_names(c, P.main_speaker)


@query("select lecture_id, cast(count(distinct speaker) as bigint) as speakers, string_agg(local_id || '=' || coalesce(speaker, ''), ',' order by local_id) as entries from speaker_map group by 1")
def speaker_maps(spark, sf):
    t = table(spark, sf, "speaker_map")
    m = cluster.speaker_map(t).select("lecture_id", F.array_join(F.transform(F.map_entries("speakers"), lambda x: F.concat(x["key"], F.lit("="), F.coalesce(x["value"], F.lit("")))), ",").alias("entries"))
    return m.join(t.groupBy("lecture_id").agg(F.count_distinct("speaker").alias("speakers")), "lecture_id")


@query("select lecture_id from whisper intersect select lecture_id from turns intersect select lecture_id from gemini")
def ids_intersect(spark, sf):
    return incremental.ready(*[table(spark, sf, t).select("lecture_id") for t in ("whisper", "turns", "gemini")])


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null)")
def pending_anti(spark, sf):
    done = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return incremental.pending(table(spark, sf, "customer").select("c_custkey"), done, "c_custkey")


@query("""with ok as (select distinct lecture_id from gemini_files where json_valid(body) and json_type(case when json_valid(body) then body end) = 'ARRAY' and json_array_length(case when json_valid(body) then body end) > 0)
select distinct lecture_id from audio_files where lecture_id not in (select lecture_id from ok where lecture_id is not null)""")
def validated_anti(spark, sf):
    outputs = table(spark, sf, "gemini_files").select("lecture_id", F.col("body").alias("doc")).distinct()
    return incremental.pending_valid(table(spark, sf, "audio_files").select("lecture_id").distinct(), outputs, "lecture_id")


@query("select lecture_id from (select distinct lecture_id from audio_files) where lecture_id in (select lecture_id from whisper) order by lecture_id limit 10")
def semi_limit(spark, sf):
    """The first ten recordings that have a transcript (the limit is the feature)."""
    return incremental.first_with(table(spark, sf, "audio_files").select("lecture_id").distinct(), table(spark, sf, "whisper"), "lecture_id", 10)


@query("select audio_id, row_number() over (order by audio_id) - 1 as position, cast((row_number() over (order by audio_id) - 1) % 4 as integer) as slot from audio_files")
def round_robin(spark, sf):
    return windows.round_robin(table(spark, sf, "audio_files").select("audio_id"), ["audio_id"], 4)


@query("select case when not header_ok then 'FAIL' when duration_s is not null then 'SKIP' else 'DONE' end as status, count(*) as n from audio_files group by 1")
def status_tally(spark, sf):
    a = table(spark, sf, "audio_files")
    return incremental.tally(a.withColumn("status", incremental.status(F.col("duration_s").isNotNull(), ~F.col("header_ok"))), "status")


@query("select 'whisper' as stage, count(*) as n from whisper union all select 'gemini', count(*) from gemini union all select 'turns', count(*) from turns union all select 'files', count(*) from gemini_files")
def stage_counts(spark, sf):
    names = {"whisper": "whisper", "gemini": "gemini", "turns": "turns", "files": "gemini_files"}
    return relational.union_all(*[table(spark, sf, t).agg(F.count("*").alias("n")).select(F.lit(k).alias("stage"), "n") for k, t in names.items()])


@query(f"with {T} select turn_id, row_number() over (partition by lecture_id order by seq, turn_id) - 1 as ordinal from t")
def turn_ordinals(spark, sf):
    t = turns(spark, sf).withColumn("blk", F.floor(F.col("seq") / pipeline.BLOCK_SEQ))
    return block_scan(t, ["lecture_id"], "blk", [F.col("seq"), F.col("turn_id")], sums={"n": F.lit(1).cast("bigint")}).select("turn_id", (F.col("n") - 1).alias("ordinal"))


@query("""with w as (select seg_id, any_value(start_s) as a, any_value(end_s) as b, any_value(words) as ws from whisper where words is not null group by 1)
select seg_id, cast(k - 1 as integer) as pos, ws[k].word as word, cast(round(coalesce(ws[k].start_s, a) * 1000) as bigint) as from_ms, cast(round(coalesce(ws[k].end_s, b) * 1000) as bigint) as to_ms from w, unnest(range(1, len(ws) + 1)) as x(k)""")
def word_defaults(spark, sf):
    w = table(spark, sf, "whisper").filter("words is not null").dropDuplicates(["seg_id"])
    full = files.word_times(F.col("words"), F.col("start_s"), F.col("end_s"), ("start_s", "end_s"))
    return w.select("seg_id", F.posexplode(full).alias("pos", "w")).select("seg_id", "pos", "w.word", ms(F.col("w.start_s")).alias("from_ms"), ms(F.col("w.end_s")).alias("to_ms"))


@query("select distinct gem_id, trim(coalesce(nullif(text, ''), speaker, '')) as shown from gemini")
def first_text(spark, sf):
    return table(spark, sf, "gemini").select("gem_id", tx.first_text(F.col("text"), F.col("speaker")).alias("shown")).distinct()


@query(f"""with {WT}, c as (select lecture_id, s // 54000 as chunk_no, min(s) as first_s from w group by 1, 2)
select id, w.s // 54000 as chunk_no, w.s - c.first_s as in_chunk, least(w.e, c.first_s + 54000) as e from w join c on c.lecture_id = w.lecture_id and c.chunk_no = w.s // 54000""")
def offset_shift(spark, sf):
    """Times counted from the first segment of each chunk, and shifted back by that offset with ends cut to the chunk's length."""
    w = timed_whisper(spark, sf).withColumn("chunk_no", F.floor(F.col("s") / P.chunk_ms))
    starts = w.groupBy("lecture_id", "chunk_no").agg(F.min("s").alias("first_s"))
    local = w.join(starts, ["lecture_id", "chunk_no"]).withColumns({"in_chunk": F.col("s") - F.col("first_s"), "to": F.least(F.col("e") - F.col("first_s"), F.lit(P.chunk_ms))})
    return local.select("id", "chunk_no", "in_chunk", (F.col("first_s") + F.col("to")).alias("e"))


@query(f"with {T}, m as (select distinct lecture_id, local_id, speaker from speaker_map) select t.turn_id, coalesce(m.speaker, 'MAIN') as speaker from t left join m on m.lecture_id = t.lecture_id and m.local_id = t.speaker")
def speaker_lookup(spark, sf):
    t = turns(spark, sf).withColumnRenamed("speaker", "raw")
    return intervals.named_speakers(t, table(spark, sf, "speaker_map"), P.main_speaker, salt=F.col("turn_id")).select("turn_id", "speaker")


def _vocab(t: str) -> str:
    return f"select unnest(list_transform({_words('text')}, lambda z: regexp_replace(lower(z), '[^\\p{{L}}\\p{{N}}_]', '', 'g'))) as token from {t}"


@query(f"select distinct token from ({_vocab('whisper')} union all {_vocab('gemini')}) where token <> ''")
def vocabulary(spark, sf):
    side = lambda t: table(spark, sf, t).select(F.explode(tx.align_tokens(F.col("text"))).alias("token")).distinct()
    return side("whisper").union(side("gemini")).distinct()


@query(f"with {WT} select lecture_id, s // 60000 as minute, md5(string_agg(text, ' ' order by s, id)) as said from w where text is not null group by 1, 2")
def ordered_concat(spark, sf):
    w = timed_whisper(spark, sf).filter("text is not null").groupBy("lecture_id", F.floor(F.col("s") / 60_000).alias("minute"))
    return w.agg(F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s", "id", "text"))), lambda x: x["text"]), " ")).alias("said"))


@query("select distinct audio_id, regexp_extract(file_path, '([^/]*)\\.[^./]*$', 1) as stem, coalesce(series_name, '') as series from audio_files")
def path_stems(spark, sf):
    return table(spark, sf, "audio_files").select("audio_id", tx.stem(F.col("file_path")).alias("stem"), F.coalesce("series_name", F.lit("")).alias("series")).distinct()


@query(f"with {WT} select id, lecture_id || '_' || cast(s // 1000 as varchar) || '_' || cast(e // 1000 as varchar) as name from w")
def segment_names(spark, sf):
    return timed_whisper(spark, sf).select("id", F.concat_ws("_", "lecture_id", F.floor(F.col("s") / 1000), F.floor(F.col("e") / 1000)).alias("name"))


@query(f"with {W} select id, 300 * len({_words('text')}) as spoken_ms from w")
def word_rate(spark, sf):
    return whisper(spark, sf).select("id", (F.size(tx.words(F.col("text"))) * P.word_ms).cast("bigint").alias("spoken_ms"))


@query("select l_returnflag, l_linestatus, cast(sum(l_quantity) as bigint) as qty, count(*) as n from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup_flags(spark, sf):
    return relational.rollup(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], F.sum("l_quantity").cast("bigint").alias("qty"), F.count("*").alias("n"))


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders group by cube (o_orderstatus, o_orderpriority)")
def cube_orders(spark, sf):
    return relational.cube(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], F.count("*").alias("n"))


@query("select route, lecture_id, count(*) as n from gemini group by grouping sets ((route), (lecture_id), ())")
def grouping_sets_gemini(spark, sf):
    return relational.grouping_sets(table(spark, sf, "gemini"), [["route"], ["lecture_id"], []], F.count("*").alias("n"))


@query("""select s_suppkey, rank() over v as rk, dense_rank() over v as dr, ntile(4) over (partition by s_nationkey order by s_acctbal desc, s_suppkey) as quarter,
  round(percent_rank() over v, 6) as pr from supplier window v as (partition by s_nationkey order by s_acctbal desc)""")
def rank_suppliers(spark, sf):
    w = Window.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"))
    return table(spark, sf, "supplier").select("s_suppkey", F.rank().over(w).cast("bigint").alias("rk"), F.dense_rank().over(w).cast("bigint").alias("dr"),
                                               F.ntile(4).over(w.orderBy(F.desc("s_acctbal"), "s_suppkey")).cast("bigint").alias("quarter"), F.round(F.percent_rank().over(w), 6).alias("pr"))


@query("""select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders) where k <= 3""")
def top_orders(spark, sf):
    """Three dearest orders of each customer (top-k is the feature)."""
    return relational.top_per_key(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("select lecture_id, count(*) as n from whisper group by 1 order by n desc, lecture_id limit 10")
def longest_lectures(spark, sf):
    """Ten recordings with most segments (top-k is the feature)."""
    return table(spark, sf, "whisper").groupBy("lecture_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lecture_id").limit(10)


@query("select lecture_id from whisper except all select lecture_id from gemini")
def difference_all(spark, sf):
    return relational.difference(table(spark, sf, "whisper").select("lecture_id"), table(spark, sf, "gemini").select("lecture_id"))


@query("""select coalesce(n.n_nationkey, c.c_nationkey) as nation, count(c.c_custkey) as customers, count(n.n_nationkey) as known from nation n full outer join customer c on n.n_nationkey = c.c_nationkey group by 1""")
def outer_join(spark, sf):
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    return n.join(c, n.n_nationkey == c.c_nationkey, "full").groupBy(F.coalesce("n_nationkey", "c_nationkey").alias("nation")).agg(F.count("c_custkey").alias("customers"), F.count("n_nationkey").alias("known"))


@query("""select cast(epoch(date_trunc('hour', ts)) as bigint) as hour, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2""")
def stream_windows(spark, sf):
    """Hourly windows of the events as a stream, driven over what is there."""
    src = table(spark, sf, "events")
    stream = ship(spark).readStream.schema(src.schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "true").parquet(sf)
    out = streams.window_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "1 hour")
    got = streams.run_to_table(out, "complete")
    return got.select(F.unix_timestamp("from_ts").alias("hour"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""with e as (select user_id, epoch_us(ts) as t from events), l as (select *, case when t - lag(t) over (partition by user_id order by t) <= 21600000000 then 0 else 1 end as n from e),
 s as (select *, sum(n) over (partition by user_id order by t rows unbounded preceding) as k from l)
select user_id, cast(count(distinct k) as bigint) as sessions, count(*) as n from s group by 1""")
def session_counts(spark, sf):
    """Sessions of each user with gaps of up to six hours."""
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.sessions(e, "ts", ["user_id"], "6 hours").groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))
