import io
import json
import zipfile

import numpy as np
from pyspark.sql import functions as F

from tests.helpers import rows
from voxloom.params import Params
from voxloom.sources import files, sinks
from voxloom.streaming import streams


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_transcripts(spark, tmp_path):
    put(tmp_path / "w/l1/transcript.json", json.dumps([{"start": 1.0, "end": 2.0, "text": "é", "words": [{"word": "a"}, {"word": "b", "start": 1.5, "end": 1.6}]}, {"start": 3, "end": 4, "text": "x"}]))
    got = files.whisper_files(spark, str(tmp_path / "w/*/transcript.json")).orderBy("seq").collect()
    assert (got[0].lecture_id, got[0].text, [tuple(w) for w in got[0].words]) == ("l1", "é", [("a", 1.0, 2.0), ("b", 1.5, 1.6)]) and got[1].words is None
    put(tmp_path / "g/a.json", json.dumps([{"speaker": "S", "text": "t", "start": 1, "end": 2}]))
    put(tmp_path / "g/b.json", json.dumps({"file_id": "b", "segments": [{"text": "u", "start": 1, "end": 2}, {"label": "K", "text": "v", "start": 2, "end": 3}]}))
    put(tmp_path / "g/c.json", "```json\n" + json.dumps([{"speaker": "F", "text": "w", "start": 0, "end": 1}]) + "\n```")
    assert rows(files.gemini_files(spark, str(tmp_path / "g/*.json"), by_folder=False), "lecture_id", "speaker", "text") == [("a", "S", "t"), ("b", "K", "v"), ("b", "LECTURE", "u"), ("c", "F", "w")]


def test_windows_turns_maps_blocks(spark, tmp_path):
    put(tmp_path / "k/a.json", json.dumps([["01:00", "02:30"], ["1:00:00", "1:00:10"]]))
    put(tmp_path / "k/b.json", json.dumps([{"start": 0.0, "end": 30.0, "label": "kirtan", "rms": 0.1}]))
    spans = spark.createDataFrame([("a", 9.0), ("c", 77.0)], "lecture_id string, duration double")
    assert rows(files.window_files(spark, str(tmp_path / "k/*.json"), spans), "lecture_id", "start", "end", "label") == [
        ("a", 3600.0, 3610.0, "LECTURE"), ("a", 60.0, 150.0, "LECTURE"), ("b", 0.0, 30.0, "kirtan"), ("c", 0.0, 77.0, "LECTURE")]
    put(tmp_path / "t/a.txt", "start=1.0s stop=2.5s speaker_X\njunk\nstart=3.0s stop=4.0s speaker_Y")
    turns = files.turn_files(spark, str(tmp_path / "t/*.txt"))
    assert rows(turns, "lecture_id", "seq", "start", "end", "speaker") == [("a", 0, 1.0, 2.5, "X"), ("a", 2, 3.0, 4.0, "Y")]
    assert rows(sinks.turn_lines(turns), "value") == [("start=1.0s stop=2.5s speaker_X",), ("start=3.0s stop=4.0s speaker_Y",)]
    names = spark.createDataFrame([("a", "0", "Ann"), ("a", "1", "Bob")], "lecture_id string, local_id string, speaker string")
    sinks.write_map(names, str(tmp_path / "m"))
    assert rows(files.speaker_map_files(spark, str(tmp_path / "m/*.txt"))) == rows(names)
    put(tmp_path / "b/x.json", json.dumps([{"speaker": "A", "text": "p"}, {"B": {"text": "q", "start": "00:00:00"}}, {"C": "r"}]))
    assert rows(files.block_files(spark, str(tmp_path / "b/*.json")), "turn", "speaker", "text") == [(0, "A", "p"), (1, "B", "q"), (2, "C", "r")]


def test_vectors_docx_listing(spark, tmp_path):
    d = tmp_path / "v/lec/embeddings"
    d.mkdir(parents=True)
    np.save(d / "0_30.npy", np.array([[1.0, 2.0]]))
    np.save(d / "30_60.npy", np.array([np.nan]))
    np.save(d / "60_90.npy", np.array([]))
    (d / "bad.npy").write_bytes(b"no")
    assert rows(files.vector_files(spark, str(tmp_path / "v"))) == [("lec", "0_30", [1.0, 2.0])]
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>Speaker 1</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>hel</w:t></w:r><w:r><w:t>lo</w:t></w:r></w:p></w:body></w:document>")
    (tmp_path / "gt.docx").write_bytes(buf.getvalue())
    assert rows(files.docx_files(spark, str(tmp_path))) == [("gt", 0, "Speaker 1"), ("gt", 1, "hello")]
    (tmp_path / "x.mp3").write_bytes(b"12")
    assert rows(files.file_listing(spark, str(tmp_path)), "stem", "length") == [("x", 2)]


def test_sinks(spark, tmp_path):
    b = spark.createDataFrame([("l", 2, "B", "zwei", 61_000, 62_000), ("l", 1, "A", "é", 0, 1_000)], "lecture_id string, block_no long, speaker string, text string, s long, e long")
    doc = sinks.block_json(b)
    assert json.loads(doc.first().doc) == [{"A": {"text": "é", "start": "00:00:00", "end": "00:00:01"}}, {"B": {"text": "zwei", "start": "00:01:01", "end": "00:01:02"}}]
    sinks.write_documents(doc, str(tmp_path / "o"))
    sinks.write_json_lines(b, str(tmp_path / "j"))
    sinks.write_report(b, str(tmp_path / "r"))
    sinks.write_vectors(b, str(tmp_path / "p"))
    assert json.loads(next((tmp_path / "o/lecture_id=l").glob("*.txt")).read_text())[0]["A"]["text"] == "é"
    assert next((tmp_path / "r").glob("*.csv")).read_text().startswith("lecture_id,block_no")
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_incremental_stream(spark, tmp_path):
    src, seen = tmp_path / "in", []
    spark.range(3).write.parquet(str(src))
    go = lambda: streams.incremental(spark, str(src), "id long", lambda df, e: seen.append(df.count()), str(tmp_path / "cp"))
    assert go() == 1 and go() == 0
    spark.range(4).write.mode("append").parquet(str(src))
    assert go() == 1 and sum(seen) == 7


def test_params():
    p = Params.from_env({"VOXLOOM_MAX_CHARS": "10", "VOXLOOM_KEEP_GROUPS": "true", "VOXLOOM_MAIN_SPEAKER": "X"})
    assert (p.max_chars, p.keep_groups, p.main_speaker, p.overlap_min_ms) == (10, True, "X", 500)
    assert F is not None
