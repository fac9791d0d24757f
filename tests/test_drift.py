import json
from datetime import datetime, timedelta

from tests.helpers import clashing, rows
from voxloom.operators import drift

SCHEMA = "file_id long, lecture_id string, exporter string, produced_at timestamp, body string, ingested_at timestamp"
T0 = datetime(2029, 1, 1)


def frame(spark, bodies, exporter="e"):
    data = [(i, "l", exporter, T0 + timedelta(days=20 * i), b, T0) for i, b in enumerate(bodies, 1)]
    return spark.createDataFrame(data + data[:2], SCHEMA)


def seg(**k):
    return json.dumps([k, k])


BASE = dict(speaker="A B", text="some words are here", start=1.5, end=2.0)


def test_changes(spark):
    moved = {**BASE, "who": "A B"}
    del moved["speaker"]
    bodies = [seg(**BASE), "```json\n" + seg(**BASE, tone="x") + "\n```", "broken [{", None, "[]", "﻿" + seg(**BASE), seg(**moved), seg(**{**moved, "start": "1.5"}),
              json.dumps({"file_id": "f", "segments": [{**moved, "start": "1.5"}]}), seg(**{k: v for k, v in moved.items() if k != "end"} | {"start": "2", "lang": "en"}), seg(**{k: None for k in moved})]
    got = rows(drift.schema_changes(drift.ingest(clashing(frame(spark, bodies)))), "file_id", "change_kind", "old_field", "new_field")
    assert got == [(10, "added", "", "lang"), (10, "removed", "end", ""), (10, "removed", "file_id", ""), (10, "removed", "segments", ""), (11, "added", "", "end"), (11, "removed", "lang", ""), (2, "added", "", "tone"),
                   (6, "removed", "tone", ""), (7, "renamed", "speaker", "who"), (8, "retyped", "start", "start"), (9, "added", "", "file_id"), (9, "added", "", "segments")]


def test_rename_needs_one_target_or_meaning(spark):
    a, b = {**BASE, "tone": "calm"}, {**BASE, "lang": "en"}
    got = rows(drift.schema_changes(drift.ingest(frame(spark, [seg(**a), seg(**b), seg(**{k: v for k, v in b.items() if k != "start"}, begin="1.5")]))), "file_id", "change_kind", "old_field", "new_field")
    assert got == [(2, "added", "", "lang"), (2, "removed", "tone", ""), (3, "renamed", "start", "begin")]


def test_ingest_and_promote(spark):
    bodies = [seg(spk={"id": 1, "name": "N"}, utterance="t", begin="00:00:29.5", stop="x", confidence=0.5, words=["a", "b"]), json.dumps({"file_id": "f", "segments": [{"label": 3, "text": 7}]}), "nonsense", None]
    out = drift.ingest(clashing(frame(spark, bodies)))
    got = rows(out.filter("seg_no = 0"), "file_id", "speaker", "text", "start_s", "end_s", "rescued")
    assert got[0][:5] == (1, "N", "t", 29.5, None) and json.loads(got[0][5]) == {"spk": {"id": 1, "name": "N"}, "stop": "x", "confidence": 0.5, "words": ["a", "b"]}
    assert got[1][:5] == (2, "3", None, None, None) and json.loads(got[1][5]) == {"file_id": "f", "text": 7}
    up = rows(drift.promote(out, {"confidence": "double", "words": "array<string>", "stop": "double"}).filter("seg_no = 0"), "file_id", "confidence", "words", "stop", "rescued")
    assert up[0][:4] == (1, 0.5, ["a", "b"], None) and json.loads(up[0][4]) == {"spk": {"id": 1, "name": "N"}, "stop": "x"} and up[1][:4] == (2, None, None, None)


def test_unwrap():
    assert drift.unwrap('Here it is: [{"a": 1}] thanks') == [{"a": 1}]
    assert drift.unwrap('[{"a": 1}, {"b') is None and drift.unwrap("") is None and drift.unwrap("NaN") is None
    assert drift.unwrap(json.dumps(json.dumps([1]))) == [1]


def test_empty(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert drift.schema_changes(drift.ingest(e)).count() == 0 and drift.ingest(e).count() == 0


def field(name, type="string", shape="string:code", target=None, values=()):
    return {"field": name, "type": type, "shape": shape, "target": target, "values": list(values)}


def test_meaning_is_told_by_target_values_and_names():
    same = drift.same_meaning
    assert same(field("start", "number", target="start"), field("t0", "string", target="start")) and not same(field("start", target="start"), field("stop", target="end"))
    assert same(field("lang"), field("language")) and same(field("schemaRev"), field("schema_rev")) and not same(field("lang"), field("slang")) and not same(field("note"), field("footnotes"))
    assert same(field("tone", values=[1, 2, 3]), field("mood", values=[2, 3, 9])) and not same(field("tone", values=[1, 2]), field("mood", values=[8, 9]))
    assert not same(field("lang"), field("language", "number", "number")) and not same(field("tone"), field("label", target="speaker"))


def leaves(x):
    if isinstance(x, dict):
        return [y for k, v in x.items() for y in leaves(v)]
    return [y for v in x for y in leaves(v)] if isinstance(x, list) else [] if x is None else [x]


def test_every_leaf_is_kept(spark):
    bodies = [json.dumps(x) for x in (
        {"speakers": ["A", "B"], "segments": [{"text": "x", "start": 1.5}, {"text": "y", "n": [7, {"z": 8}]}]}, {"meta": [{"a": 1}], "items": [{"text": "t", "a": 5}, "loose", 9]}, {"text": "hidden", "tags": ["q"], "rows": [{"text": "seen", "tags": 3}]},
        {"segments": [], "note": "none"}, [1, 2], {"segments": ["only text"]})] + ["cut {\"a\": [", "plain words"]
    got = {}
    for r in drift.ingest(frame(spark, bodies)).collect():
        got.setdefault(r.file_id, []).append(r)
    for i, b in enumerate(bodies, 1):
        kept = [str(v) for r in got[i] for v in (r.speaker, r.text, r.start_s, r.end_s, *leaves(json.loads(r.rescued or "{}"))) if v is not None]
        value = drift.unwrap(b)
        for leaf in [b] if value is None else leaves(value):
            assert str(leaf) in kept, (i, leaf, kept)
    assert [r.seg_no for r in got[2]] == [0, 1, 2] and got[2][0].text == "t" and [r.seg_no for r in got[4] + got[7]] == [None, None]
