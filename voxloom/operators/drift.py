"""Problem 7: files whose fields drift, read into one table, with every change reported.

Bodies are parsed once in Python workers (they are whole JSON texts behind assorted wrapping, which no columnar reader
takes). Known fields go into typed target columns; what is unknown or can't be cast stays in a rescue column as JSON, from
which approved fields are promoted later. The ingested table also holds each file's field profile (types, shapes and samples of
values, target columns), and changes are what differs between the profiles of neighbouring files of an exporter.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.scan import block_lag
from voxloom.session import checkpointed

#: Files of one exporter that fall into so many days are compared in one task.
BLOCK_DAYS = 30
#: Hashes of different values that a field's profile keeps.
SKETCH = 16

# Names in use for one meaning.
MEANINGS = {
    "speaker": ("speaker", "spk", "who", "label", "speaker_label", "speaker_name", "voice", "talker"),
    "text": ("text", "utterance", "transcript", "content", "sentence", "words_text", "body", "caption"),
    "start": ("start", "begin", "t0", "start_s", "start_time", "from", "onset", "ts_start"),
    "end": ("end", "stop", "t1", "end_s", "end_time", "to", "offset", "finish", "ts_end"),
}
_MEANS = {name: meaning for meaning, names in MEANINGS.items() for name in names}
TARGET = ("speaker", "text", "start", "end")
_FENCE = re.compile(r"^\s*```[^\n`]*\n?(.*?)\n?\s*`{3,}\s*$", re.S)
_HMS = re.compile(r"^\s*(?:(\d+):)?(\d+):(\d+(?:[.,]\d+)?)\s*$")


def _strict(x: str):
    raise ValueError(x)


def unwrap(body: str | None):
    """The JSON value in a body, once byte-order marks, code fences and quoting are taken off; None if there is none."""
    if body is None:
        return None
    text = body.strip("﻿​ \t\r\n")
    if m := _FENCE.match(text):
        text = m[1].strip("﻿ \t\r\n")
    for _ in range(2):
        try:
            value = json.loads(text, parse_constant=_strict)
        except (ValueError, RecursionError):
            break
        if not isinstance(value, str):
            return value
        text = value.strip()
    # A sentence before or after the JSON is wrapping too; a value that is cut is not whole and stays unparsed.
    at = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    if at <= 0 and not text[:1] in "{[" or at < 0:
        return None
    try:
        value, end = json.JSONDecoder(parse_constant=_strict).raw_decode(text, at)
    except (ValueError, RecursionError):
        return None
    rest = text[end:]
    return None if set(rest) & set("{}[]") else value


def _known(records: list) -> int:
    return sum(k.lower() in _MEANS for r in records if isinstance(r, dict) for k in r)


def segment_list(value) -> tuple[str | None, list]:
    """The key ('' for a bare list, None if there is none) and the items of the list that holds a file's segment records.

    ``segments`` if it holds an object, else the list of objects with most known field names, of equal ones the longest.
    """
    if isinstance(value, list):
        return ("", value) if any(isinstance(x, dict) for x in value) else (None, [])
    if not isinstance(value, dict):
        return None, []
    lists = [(k, x) for k, x in value.items() if isinstance(x, list) and any(isinstance(r, dict) for r in x)]
    named = [x for x in lists if x[0] == "segments"]
    return max(named or lists, key=lambda x: (_known(x[1]), len(x[1])), default=(None, []))


def kind(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return "string" if isinstance(value, str) else "array" if isinstance(value, list) else "object"


def seconds(value) -> float | None:
    """Seconds from a number, a numeric string or a clock string; None if it is none of these."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return float(value) if math.isfinite(value) else None
    if isinstance(value, str):
        if m := _HMS.match(value):
            return int(m[1] or 0) * 3600 + int(m[2]) * 60 + float(m[3].replace(",", "."))
        try:
            x = float(re.sub(r"\s*s(?:ec)?$", "", value.strip()))
            return x if math.isfinite(x) else None
        except ValueError:
            return None
    return None


def shape(values: list) -> str:
    """What the values of one field look like, for telling the meaning of a name that is not known."""
    values = [v for v in values if v is not None]
    if not values:
        return ""
    types = {kind(v) for v in values}
    if types != {"string"}:
        if types == {"number"}:
            grows = all(a <= b for a, b in zip(values, values[1:]))
            return "number:grows" if grows and len(values) > 1 and values[0] != values[-1] else "number"
        return "+".join(sorted(types))
    if all(seconds(v) is not None for v in values):
        return "string:time"
    words = sum(len(v.split()) for v in values) / len(values)
    return "string:" + ("sentence" if words >= 4 else "name" if words >= 1.5 or any(v[:1].isupper() for v in values) else "code")


def sketch(values: list) -> list[int]:
    """The least hashes of the different strings among ``values``: enough to tell whether two fields hold the same."""
    return sorted(zlib.crc32(v.strip().lower().encode("utf-8", "surrogatepass")) for v in {v for v in values if isinstance(v, str) and v.strip()})[:SKETCH]


def profile(top: dict, rows: list[dict]) -> list[dict]:
    """``field, type, shape, target, values`` of a file's fields, by name. Type '' is not known (nulls only)."""
    seen: dict[str, list] = {}
    for r in [top, *rows]:
        for k, v in r.items():
            seen.setdefault(k, []).append(v)
    return [{"field": k, "type": "+".join(sorted({t for v in vs if (t := kind(v))})), "shape": shape(vs), "target": _MEANS.get(k.lower()), "values": sketch(vs)} for k, vs in sorted(seen.items())]


def _name_parts(name: str) -> list[str]:
    return [x.lower() for x in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+", name)]


def same_meaning(old: dict, new: dict) -> bool:
    """Are two fields one under another name.

    Fields that ingestion casts to one target column are, whatever JSON type they arrive in: the column's type is the same. Other
    fields must agree in type, and hold the same strings (half of the different ones, two at least), or have a like shape of values
    and like names: the same parts, or one part that begins the other.
    """
    if old["target"] and new["target"]:
        return old["target"] == new["target"]
    if old["type"] and new["type"] and old["type"] != new["type"]:
        return False
    common = len(set(old["values"]) & set(new["values"]))
    if common >= 2 and 2 * common >= min(len(old["values"]), len(new["values"])):
        return True
    if old["target"] or new["target"] or (old["shape"] and new["shape"] and old["shape"].split(":grows")[0] != new["shape"].split(":grows")[0]):
        return False
    a, b = _name_parts(old["field"]), _name_parts(new["field"])
    if "".join(a) == "".join(b):
        return True
    short, long_ = sorted(("".join(a), "".join(b)), key=len)
    return len(short) >= 3 and (long_.startswith(short) or bool(a) and bool(b) and (set(a) <= set(b) or set(b) <= set(a)))


def changes(old: list[dict], new: list[dict]) -> list[tuple[str, str, str]]:
    """(change_kind, old_field, new_field) from one file's profile to the next one's."""
    was, now = {p["field"]: p for p in old}, {p["field"]: p for p in new}
    gone, come = [p for k, p in was.items() if k not in now], [p for k, p in now.items() if k not in was]
    out = []
    for g in gone:
        match = next((c for c in come if same_meaning(g, c)), None)
        if match:
            come.remove(match)
            out.append(("renamed", g["field"], match["field"]))
        else:
            out.append(("removed", g["field"], ""))
    out += [("added", "", c["field"]) for c in come]
    out += [("retyped", k, k) for k in was.keys() & now.keys() if was[k]["type"] and now[k]["type"] and was[k]["type"] != now[k]["type"]]
    return sorted(out)


def _files(files: DataFrame) -> DataFrame:
    return files.select("file_id", "exporter", F.col("produced_at").cast("timestamp").alias("produced_at"), "body", *(["lecture_id"] if "lecture_id" in files.columns else [F.lit(None).cast("string").alias("lecture_id")])
                        ).filter("file_id is not null").dropDuplicates(["file_id"])


SEGMENTS = "file_id bigint, exporter string, lecture_id string, produced_at timestamp, seg_no int, speaker string, text string, start_s double, end_s double, rescued string, profile string"


def cast_to(target: str | None, value):
    """A value as the target column takes it, or None: seconds for times, text as it is, a speaker's name, number or name of an object."""
    if target in ("start", "end"):
        return seconds(value)
    if isinstance(value, str):
        return value if target else None
    if target == "speaker":
        if isinstance(value, dict):
            return value["name"] if isinstance(value.get("name"), str) else None
        return str(value) if isinstance(value, int) and not isinstance(value, bool) else None
    return None


def segment_rows(body: str | None) -> list[tuple]:
    """(seg_no, speaker, text, start_s, end_s, rescued, profile) rows of one body; see :func:`ingest`."""
    value = unwrap(body)
    if value is None:
        return [] if body is None else [(None, None, None, None, None, _json({"_body": body}), None)]
    where, items = segment_list(value)
    if where is None:
        return [(None, None, None, None, None, _json(value if isinstance(value, dict) else {"_value": value}), None)]
    top = value if where else {}
    each = {k: v for k, v in top.items() if not isinstance(v, (list, dict))}
    # What is no single value stands once a file, and so does what a segment's own field of that name hides.
    records = [x for x in items if isinstance(x, dict)]
    hidden = {k: v for k, v in each.items() if v is not None and any(k in r for r in records)}
    once = {k: v for k, v in top.items() if k not in each and k != where}
    told = _json(profile(top, records))
    out = []
    for i, item in enumerate(items):
        got, left = dict.fromkeys(TARGET), {}
        if not isinstance(item, dict):
            left["_value"] = item
        for k, v in (each | item if isinstance(item, dict) else {}).items():
            target = _MEANS.get(k.lower())
            cast = cast_to(target, v) if target and got[target] is None else None
            if cast is not None:
                got[target] = cast
            if v is not None and (cast is None or isinstance(v, dict)):
                left[k] = v
        if i == 0:
            left = {k: v for k, v in once.items() if k not in left} | left
            clash = hidden | {k: v for k, v in once.items() if k in left and left[k] is not v}
            if clash:
                left["_top"] = clash
        out.append((i, *got.values(), _json(left) if left else None, told if i == 0 else None))
    return out


def _json(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def ingest(files: DataFrame) -> DataFrame:
    """One row a segment in the target schema; ``rescued`` keeps, as a JSON object, every value that no target column took.

    Single values of the top-level object are put beside those of each segment, which win where names clash; lists and objects of
    the top level (but for the list of segments) and values that a segment's field hides (under ``_top``) are kept with the first
    segment. An item of the list that is no object is a row with its value under ``_value``. A body without segments is one row without
    ``seg_no``: what could be parsed is rescued, else the raw body under ``_body``. Null bodies give no rows, files that arrive twice
    count once. ``profile``, on a file's first segment, tells its fields with type, shape of values and target column.
    """
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in SEGMENTS.split(", ")]
        for pdf in batches:
            out = [(r.file_id, r.exporter, r.lecture_id, r.produced_at, *row) for r in pdf.itertuples(index=False) for row in segment_rows(r.body)]
            frame = pd.DataFrame(out, columns=names)
            frame["seg_no"] = frame["seg_no"].astype("Int32")
            yield frame

    return _files(files).select("file_id", "exporter", "lecture_id", "produced_at", "body").mapInPandas(rows, SEGMENTS)


def schema_changes(segments: DataFrame) -> DataFrame:
    """``exporter, file_id, change_kind, old_field, new_field``: each change with the file that brings it, from ingested segments.

    Files of an exporter are taken in order of (produced_at, file_id). Files that couldn't be parsed or have no segments have no
    profile and are passed over; so are files without exporter or produced_at, which have no place in an order. An empty table gives
    no rows.
    """
    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r.exporter, r.file_id, *c) for r in pdf.itertuples(index=False) for c in changes(json.loads(r.before), json.loads(r.profile))]
            yield pd.DataFrame(rows, columns=["exporter", "file_id", "change_kind", "old_field", "new_field"])

    told = checkpointed(segments.filter("profile is not null and exporter is not null and produced_at is not null").select("exporter", "file_id", "produced_at", "profile")
                        .withColumn("blk", F.floor(F.unix_timestamp("produced_at") / (86400 * BLOCK_DAYS))))
    before = block_lag(told, ["exporter"], "blk", [F.col("produced_at"), F.col("file_id")], {"before": F.col("profile")})
    return (before.filter("before is not null and before <> profile").select("exporter", "file_id", "before", "profile")
            .mapInPandas(compared, "exporter string, file_id bigint, change_kind string, old_field string, new_field string"))


def promote(segments: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Replay rescued values of approved ``fields`` (name -> Spark type) into typed columns.

    A value that casts leaves the rescue column; one that doesn't stays there and gives null, as does a field that is not
    there. Casts run in the JVM; only rows with something rescued are rewritten.
    """
    @F.pandas_udf("string")
    def rest(rescued: pd.Series, taken: pd.Series) -> pd.Series:
        def left(text, names):
            if text is None or names is None or not len(names):
                return text
            kept = {k: v for k, v in json.loads(text).items() if k not in set(names)}
            return json.dumps(kept, ensure_ascii=False, sort_keys=True) if kept else None
        return pd.Series([left(t, n) for t, n in zip(rescued, taken, strict=True)], dtype=object)

    out = segments.withColumn("_m", F.from_json("rescued", "map<string,string>"))
    for name, to in fields.items():
        raw = F.try_element_at("_m", F.lit(name))
        out = out.withColumn(name, F.from_json(raw, to) if to.startswith(("array", "map", "struct")) else raw.try_cast(to))
    taken = F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in fields]))
    return out.withColumn("rescued", rest("rescued", taken)).drop("_m")
