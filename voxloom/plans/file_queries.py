"""Registered round trips through the file shapes, and functions of SQL that need no transcript, with their SQL.

A round trip writes whole tables in a file shape to the shared folder, reads them back with that shape's reader and returns what was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import signal, udfs
from voxloom.functions import text as tx
from voxloom.operators import cluster, incremental, items
from voxloom.operators.scan import ms
from voxloom.params import Params
from voxloom.plans.pipeline import speaker_runs
from voxloom.plans.reference_queries import ITEMS, RUNS, UNICODE_SPACE, labelled, merged, query, table
from voxloom.session import new_table
from voxloom.sources import files, sinks
from voxloom.streaming import streams

P = Params()
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None):
    return query(sql, QUERIES, ORACLE)


def _named(df: DataFrame) -> DataFrame:
    """Folders of a written key carry its name; take it off."""
    return df.withColumn("lecture_id", F.regexp_replace("lecture_id", "^lecture_id=", ""))


def _documents(rows: DataFrame, order: list[str], record: Column, wrap=None) -> DataFrame:
    """``lecture_id, doc``: a JSON list of the records of each recording, in order."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct(*order, record.alias("r")))), lambda x: x["r"])
    return rows.groupBy("lecture_id").agg(F.to_json(wrap(listed) if wrap else listed).alias("doc"))


_ONE_W = "w as (select seg_id, any_value(lecture_id) as lecture_id, any_value(start_s) as a, any_value(end_s) as b, any_value(text) as text, any_value(words) as words from whisper where lecture_id is not null group by 1)"


@register(f"""with {_ONE_W} select lecture_id, cast(row_number() over (partition by lecture_id order by seg_id) - 1 as integer) as seq, cast(round(a * 1000) as bigint) as from_ms,
  cast(round(b * 1000) as bigint) as to_ms, text, cast(len(words) as integer) as n_words from w""")
def whisper_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Segments as one JSON file a recording."""
    w = table(spark, sf, "whisper").filter("lecture_id is not null").dropDuplicates(["seg_id"])
    words = F.transform("words", lambda x: F.struct(x["word"].alias("word"), x["start_s"].alias("start"), x["end_s"].alias("end")))
    path = new_table(spark)
    sinks.write_documents(_documents(w, ["seg_id"], F.struct(F.col("start_s").alias("start"), F.col("end_s").alias("end"), "text", words.alias("words"))), path)
    return _named(files.whisper_files(spark, f"{path}/*/*.txt")).select("lecture_id", "seq", ms(F.col("start")).alias("from_ms"), ms(F.col("end")).alias("to_ms"), "text", F.when(F.col("words").isNotNull(), F.size("words")).alias("n_words"))


_ONE_G = "g as (select gem_id, any_value(lecture_id) as lecture_id, any_value(speaker) as speaker, any_value(text) as text, any_value(start_s) as a, any_value(end_s) as b from gemini where lecture_id is not null group by 1)"


@register(f"""with {_ONE_G} select shape, lecture_id, cast(row_number() over (partition by shape, lecture_id order by gem_id) - 1 as integer) as seq, case when shape = 'labelled' then coalesce(speaker, 'LECTURE') else speaker end as speaker,
  text, cast(round(a * 1000) as bigint) as from_ms, cast(round(b * 1000) as bigint) as to_ms from g, (values ('list'), ('fenced'), ('labelled')) as s(shape)""")
def gemini_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Records in all three shapes: a list, a list in a code fence, an object with labelled segments."""
    g = table(spark, sf, "gemini").filter("lecture_id is not null").dropDuplicates(["gem_id"])
    times = (F.col("start_s").alias("start"), F.col("end_s").alias("end"), F.col("text"))
    plain = _documents(g, ["gem_id"], F.struct("speaker", *times))
    shapes = {"list": plain, "fenced": plain.withColumn("doc", F.concat(F.lit("```json\n"), "doc", F.lit("\n```"))),
              "labelled": _documents(g, ["gem_id"], F.struct(F.col("speaker").alias("label"), *times), lambda x: F.struct(F.lit("f").alias("file_id"), x.alias("segments")))}
    out = None
    for shape, docs in shapes.items():
        path = new_table(spark)
        sinks.write_documents(docs, path)
        read = _named(files.gemini_files(spark, f"{path}/*/*.txt")).select(F.lit(shape).alias("shape"), "lecture_id", "seq", "speaker", "text", ms(F.col("start")).alias("from_ms"), ms(F.col("end")).alias("to_ms"))
        out = read if out is None else out.unionByName(read)
    return out


@register("""with k as (select distinct * from kirtan_windows where lecture_id is not null)
select lecture_id, cast(row_number() over (partition by lecture_id order by window_id) - 1 as integer) as seq, cast(round(start_s * 1000) as bigint) as from_ms, cast(round(end_s * 1000) as bigint) as to_ms, label from k""")
def window_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    k = table(spark, sf, "kirtan_windows").filter("lecture_id is not null").distinct()
    path = new_table(spark)
    sinks.write_documents(_documents(k, ["window_id"], F.struct(F.col("start_s").alias("start"), F.col("end_s").alias("end"), "label", "rms", "centroid", "zcr")), path)
    return _named(files.window_files(spark, f"{path}/*/*.txt", by_folder=True)).select("lecture_id", "seq", ms(F.col("start")).alias("from_ms"), ms(F.col("end")).alias("to_ms"), "label")


@register("""with t as (select distinct turn_id, lecture_id, start_s, end_s, speaker from turns where start_s is not null and end_s is not null and lecture_id is not null
  and regexp_matches(speaker, '^(speaker_)?[A-Za-z0-9_]+$') and start_s >= 0 and end_s >= 0)
select lecture_id, cast(row_number() over (partition by lecture_id order by turn_id) - 1 as integer) as seq, cast(round(start_s * 10) as bigint) as from_tenths, cast(round(end_s * 10) as bigint) as to_tenths, regexp_replace(speaker, '^speaker_', '') as speaker from t""")
def turn_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as lines of a text file a recording."""
    t = (table(spark, sf, "turns").select("turn_id", "lecture_id", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "speaker").filter("lecture_id is not null and start >= 0 and end >= 0")
         .filter(F.col("speaker").rlike("^(speaker_)?[A-Za-z0-9_]+$")).dropDuplicates(["turn_id"]))
    lines = sinks.turn_lines(t, "turn_id").groupBy("lecture_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn_id", "value"))), lambda x: x["value"]), "\n").alias("doc"))
    path = new_table(spark)
    sinks.write_documents(lines, path)
    tenths = lambda c: F.round(F.col(c) * 10).cast("bigint")
    return _named(files.turn_files(spark, f"{path}/*/*.txt", by_folder=True)).select("lecture_id", "seq", tenths("start").alias("from_tenths"), tenths("end").alias("to_tenths"), "speaker")


@register("select distinct lecture_id, local_id, speaker from speaker_map where lecture_id is not null and local_id is not null")
def map_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_table(spark)
    sinks.write_map(table(spark, sf, "speaker_map").filter("lecture_id is not null and local_id is not null").distinct(), path)
    return files.speaker_map_files(spark, f"{path}/*.txt")


@register(f"""with {RUNS} select lecture_id, cast(row_number() over (partition by lecture_id order by run_no) - 1 as integer) as turn, speaker, text from r""")
def block_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Speaker runs as one JSON document a recording, read as the ground truth of an evaluation."""
    path = new_table(spark)
    sinks.write_documents(sinks.block_json(speaker_runs(labelled(spark, sf)).withColumnRenamed("run_no", "block_no")), path)
    return _named(files.block_files(spark, f"{path}/*/*.txt", by_folder=True)).select("lecture_id", "turn", "speaker", "text")


@register("select vec_id, len(embedding) as dims, round(cast(embedding[1] as double), 5) as first, round(cast(embedding[len(embedding)] as double), 5) as last from embeddings")
def vector_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as .npy files, a file a vector."""
    path = new_table(spark)
    e = table(spark, sf, "embeddings").select(F.lit("l").alias("lecture_id"), F.col("vec_id").cast("string").alias("seg_id"), F.col("embedding").alias("emb"))
    sinks.write_npy(e, path)
    got = files.vector_files(spark, path)
    return got.select(F.col("seg_id").cast("bigint").alias("vec_id"), F.size("emb").cast("bigint").alias("dims"), F.round(F.element_at("emb", 1).cast("double"), 5).alias("first"), F.round(F.element_at("emb", -1).cast("double"), 5).alias("last"))


@register("""with d as (select distinct gem_id, lecture_id, speaker, text from gemini where lecture_id is not null and trim(coalesce(text, '')) <> '' and text !~ '.*[\\x{0000}-\\x{0008}\\x{000B}\\x{000C}\\x{000E}-\\x{001F}].*' and lecture_id <> '')
select lecture_id, count(*) as paragraphs, cast(sum(length(trim(text, ' ' || chr(9) || chr(10) || chr(13)))) as bigint) as letters from d group by 1""")
def docx_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as paragraphs of one word-processor document a recording."""
    d = table(spark, sf, "gemini").select("gem_id", "lecture_id", "text").filter("lecture_id <> '' and trim(text) <> ''").filter(~F.col("text").rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]")).dropDuplicates(["gem_id"])
    path = new_table(spark)
    sinks.write_docx(d, path, "gem_id")
    read = files.docx_files(spark, path)
    return read.groupBy("lecture_id").agg(F.count("*").alias("paragraphs"), F.sum(F.length("text")).alias("letters"))


@register("select lecture_id, count(*) as n from gemini where lecture_id is not null group by 1")
def report_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A report as CSV with a header."""
    path = new_table(spark)
    sinks.write_report(table(spark, sf, "gemini").filter("lecture_id is not null").groupBy("lecture_id").agg(F.count("*").alias("n")), path)
    return spark.read.option("header", True).schema("lecture_id string, n bigint").csv(path)


@register("select distinct lecture_id from whisper where lecture_id is not null and lecture_id not in (select lecture_id from audio_files where lecture_id is not null and series_name is not null)")
def listing_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Recordings with a transcript whose output file isn't there yet, by a listing of the output folder (series have one)."""
    path = new_table(spark)
    done = table(spark, sf, "audio_files").filter("lecture_id is not null and series_name is not null").select("lecture_id", F.lit("{}").alias("doc")).distinct()
    sinks.write_documents(done, path)
    there = files.file_listing(spark, path, "*.txt").select(F.regexp_extract("path", r"lecture_id=([^/]*)/", 1).alias("lecture_id"))
    ids = table(spark, sf, "whisper").select("lecture_id").filter("lecture_id is not null").distinct()
    return incremental.pending(ids, there, "lecture_id")


@register("select lecture_id, count(*) as n, 1 as runs from turns group by 1")
def incremental_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Turns handed on by a stream that remembers what is done: a second run hands on nothing."""
    out = new_table(spark)
    table(spark, sf, "turns").select("turn_id", "lecture_id").write.parquet(f"{out}/in")
    hand = lambda: streams.incremental(spark, f"{out}/in", "turn_id bigint, lecture_id string", lambda df, n: df.withColumn("run", F.lit(1)).write.mode("append").parquet(f"{out}/out"), f"{out}/done")
    hand()
    again = hand()
    return spark.read.parquet(f"{out}/out").groupBy("lecture_id").agg(F.count("*").alias("n"), (F.max("run") + F.lit(again)).alias("runs"))


def _cut(most: int) -> str:
    """Chunks of long texts by a fold: neighbouring sentences that fit are lane 0, the words of each longer one a lane of their own."""
    space = UNICODE_SPACE
    return rf"""d as (select doc_id, regexp_replace(regexp_replace(text, '^{space}', ''), '{space}$', '') as t from documents where length(text) > {most}),
 l as (select doc_id, list_filter(string_split(regexp_replace(t, '([.!?]){space}', '\1' || chr(1), 'g'), chr(1)), lambda z: z <> '') as s from d),
 p as (select doc_id, flatten(list_transform(s, lambda z, i: case when length(z) > {most} then list_transform(list_filter(regexp_split_to_array(z, '{space}'), lambda y: y <> ''), lambda y: {{'lane': i, 'p': y}})
   else [{{'lane': cast(0 as bigint), 'p': z}}] end)) as ps from l),
 f as (select doc_id, list_reduce(list_transform(ps, lambda x: {{'done': cast([] as varchar[]), 'cur': x.p, 'lane': x.lane}}), lambda a, x: case when x.lane = a.lane and length(a.cur) + length(x.cur) + 1 <= {most}
   then {{'done': a.done, 'cur': a.cur || ' ' || x.cur, 'lane': a.lane}} else {{'done': list_append(a.done, a.cur), 'cur': x.cur, 'lane': x.lane}} end) as r from p),
 c as (select doc_id, list_append(r.done, r.cur) as cs from f)"""


@register(f"""with {_cut(400)} select doc_id, cast(i - 1 as integer) as chunk_no, md5(cs[i]) as chunk from c, unnest(range(1, len(cs) + 1)) as x(i)""")
def split_text_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Texts over 400 characters cut by the table function in SQL."""
    udfs.register(spark)
    table(spark, sf, "documents").select("doc_id", "text").createOrReplaceTempView("voxloom_split_texts")
    return spark.sql("select doc_id, chunk_no, md5(chunk) as chunk from voxloom_split_texts, lateral split_text(text, 400) where length(text) > 400")


CHUNK_SQL = f"""with {_cut(2800)} select doc_id, cast(i - 1 as integer) as chunk_no, cs[i] as chunk from c, unnest(range(1, len(cs) + 1)) as x(i)
union all select doc_id, 0, trim(text) from documents where length(text) <= 2800 and trim(text) <> ''"""


@register(f"""with {ITEMS},
 z as (select *, type = 'WHISPER_SEGMENT' as sg, case when type = 'WHISPER_SEGMENT' and length(wt) % 2 = 0 then 10.0 else 5.0 end >= 9.99 as p, coalesce(gt, '') as gx from it),
 n as (select *, lag(sg) over v as s1, lag(type) over v as t1, lag(p) over v as p1, lag(gx) over v as g1, lag(sg, 2) over v as s2, lag(p, 2) over v as p2,
       lead(sg) over v as s3, lead(type) over v as t3, lead(p) over v as p3, lead(gx) over v as g3, lead(sg, 2) over v as s4, lead(p, 2) over v as p4 from z window v as (partition by lecture_id order by pos)),
 f as (select *, coalesce(type = 'BRIDGE_SEGMENT' and s1 and s3 and p1 <> p3 and gx <> '', false) as goes,
       coalesce(sg and not p and t1 = 'BRIDGE_SEGMENT' and s2 and p2 and g1 <> '', false) as front, coalesce(sg and not p and t3 = 'BRIDGE_SEGMENT' and s4 and p4 and g3 <> '', false) as back from n),
 x as (select lecture_id, pos, s, e, type, wt, case when front or back then trim(case when front then g1 || ' ' else '' end || gx || case when back then ' ' || g3 else '' end) else gt end as gt from f where not goes),
 y as (select lecture_id, pos, s, e, trim(coalesce(nullif(gt, ''), wt, '')) as text from x where type <> 'WHISPER_GROUP')
select * from y where text <> ''""")
def final_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Items as plain segments after pushing, where a segment counts as perfect if its text has an even length."""
    scored = merged(spark, sf).withColumn("alignment_score", F.when((F.col("type") == items.SEGMENT) & (F.length("whisper_transcript") % 2 == 0), 10.0).otherwise(5.0))
    return items.final_transcript(items.push_bridges(scored)).select("lecture_id", "pos", "s", "e", "text")


@register("""select distinct gem_id, regexp_matches(lower(trim(speaker)), '^(main|audience [0-9]+|speaker [0-9]+)$') as heading from gemini where speaker is not null""")
def heading_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "gemini").filter("speaker is not null").select("gem_id", tx.is_heading(F.col("speaker"), P.main_speaker).alias("heading")).distinct()


@register("""with a as (select distinct lecture_id, regexp_extract(file_path, '([^/]*)\\.[^./]*$', 1) as stem from audio_files), m as (select lecture_id, count(*) as labels from speaker_map group by 1)
select a.stem, coalesce(m.labels, 0) as labels from a left join m on a.lecture_id = m.lecture_id""")
def sibling_files(spark: SparkSession, sf: str) -> DataFrame:
    """Recordings with what their sibling map file of the same name holds."""
    path = new_table(spark)
    m = table(spark, sf, "speaker_map").groupBy("lecture_id").agg(F.count("*").alias("labels"))
    audio = table(spark, sf, "audio_files").select("lecture_id", tx.stem(F.col("file_path")).alias("stem")).distinct()
    sinks.write_documents(audio.join(m, "lecture_id").select(F.col("stem").alias("lecture_id"), F.col("labels").cast("string").alias("doc")), path)
    side = spark.read.text(f"{path}/*/*.txt").select(F.regexp_extract(F.col("_metadata.file_path"), r"lecture_id=([^/]*)/", 1).alias("stem"), F.col("value").cast("bigint").alias("labels"))
    return audio.select("stem").join(side, "stem", "left").select("stem", F.coalesce("labels", F.lit(0)).alias("labels"))


@register("""with e as (select vec_id, cast(embedding as double[]) as x, len(embedding) as n from embeddings where len(embedding) > 1),
 k as (select vec_id, n, f, sqrt(pow(list_sum(list_transform(x, lambda v, i: v * cos(2 * pi() * f * (i - 1) / n))), 2) + pow(list_sum(list_transform(x, lambda v, i: v * sin(2 * pi() * f * (i - 1) / n))), 2)) as m
   from e, unnest(range(0, n // 2 + 1)) as b(f)),
 c as (select vec_id, sum(m * f * 16000.0 / n) / sum(m) as centroid from k group by 1)
select e.vec_id, round(centroid, 3) as centroid, round(cast(len(list_filter(list_transform(range(2, n + 1), lambda i: (x[i] < 0) <> (x[i - 1] < 0)), lambda z: z)) as double) / n, 6) as zcr from e join c using (vec_id)""")
def signal_features(spark: SparkSession, sf: str) -> DataFrame:
    """Spectral centroid and zero-crossing rate, with vectors for frames of 16,000 samples a second."""
    e = table(spark, sf, "embeddings").filter("size(embedding) > 1").select("vec_id", F.col("embedding").alias("x"))
    return e.select("vec_id", F.round(signal.spectral_centroid(F.col("x"), 16_000), 3).alias("centroid"), F.round(signal.zero_crossing_rate(F.col("x")), 6).alias("zcr"))


@register("select event_id, round(sum(value) over (partition by user_id order by epoch_ms(ts) range between 86400000 preceding and current row), 2) as day_total from events")
def range_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Sum of each user's last day up to each event: a RANGE frame."""
    table(spark, sf, "events").select("event_id", "user_id", "value", F.unix_millis(F.col("ts").cast("timestamp")).alias("t")).createOrReplaceTempView("voxloom_events")
    return spark.sql("select event_id, round(sum(value) over (partition by user_id order by t range between 86400000 preceding and current row), 2) as day_total from voxloom_events")


@register("select event_type, true as near from events group by 1")
def approx_users(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate distinct users and median of each type of event, both within a twentieth of the exact ones."""
    e = table(spark, sf, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.01).alias("a"), F.count_distinct("user_id").alias("u"), F.percentile_approx("value", 0.5, 10_000).alias("p"), F.percentile("value", 0.5).alias("m"))
    return e.select("event_type", ((F.abs(F.col("a") - F.col("u")) <= 0.05 * F.col("u")) & (F.abs(F.col("p") - F.col("m")) <= 0.05 * F.col("m"))).alias("near"))


@register("select n_nationkey, c_custkey, cast(round(c_acctbal * 100) as bigint) as cents from (select *, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as k from customer join nation on n_nationkey = c_nationkey) where k <= 2")
def lateral_join(spark: SparkSession, sf: str) -> DataFrame:
    """The two richest customers of each nation, by a lateral join (top-k is the feature)."""
    table(spark, sf, "nation").createOrReplaceTempView("voxloom_nation")
    table(spark, sf, "customer").createOrReplaceTempView("voxloom_customer")
    return spark.sql("""select n_nationkey, c_custkey, cast(round(c_acctbal * 100) as bigint) as cents from voxloom_nation,
        lateral (select c_custkey, c_acctbal from voxloom_customer where c_nationkey = n_nationkey order by c_acctbal desc, c_custkey limit 2)""")


@register("""select label as lecture_id, sum(n) as members, cast(count(*) as bigint) as clusters from (select label, vec_id, 1 as n from embeddings) group by 1""")
def local_cluster_members(spark: SparkSession, sf: str) -> DataFrame:
    """Every valid vector is in exactly one cluster; at a distance of 0 each is its own."""
    e = table(spark, sf, "embeddings").select(F.col("label").alias("lecture_id"), F.col("vec_id").alias("seg_id"), F.col("embedding").alias("emb"))
    return cluster.local_clusters(e, 0.0).groupBy("lecture_id").agg(F.count("*").alias("members"), F.count_distinct("cluster").alias("clusters"))

