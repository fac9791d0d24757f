"""Readers of the file shapes: transcripts, windows, turns, maps, blocks, vectors, documents, listings.

Every reader takes a path or glob and gives a flat table with ``lecture_id`` from the file's name or folder and an order
column where order counts. Whole-file JSON is read as text once and parsed by explicit schemas, both known shapes at once.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.functions.text import diarization_line, stem, strip_fence
from voxloom.functions.timeutil import clock_seconds


def _path() -> Column:
    return F.col("_metadata.file_path")


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)


def file_listing(spark: SparkSession, path: str, pattern: str = "*.{mp3,wav}") -> DataFrame:
    """``path, stem, length`` of files below ``path``, contents unread."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
            .select("path", stem(F.col("path")).alias("stem"), "length"))


def _json_texts(spark: SparkSession, path: str, by_folder: bool) -> DataFrame:
    return spark.read.text(path, wholetext=True).select((_folder(_path()) if by_folder else stem(_path())).alias("lecture_id"), strip_fence(F.col("value")).alias("doc"))


def whisper_files(spark: SparkSession, path: str, by_folder: bool = True) -> DataFrame:
    """``lecture_id, seq, start, end, text, words``; words without times take the segment's."""
    docs = _json_texts(spark, path, by_folder).select("lecture_id", F.from_json("doc", f"array<{schemas.WHISPER.simpleString()}>").alias("segs"))
    return docs.select("lecture_id", F.posexplode("segs").alias("seq", "s")).select("lecture_id", "seq", "s.start", "s.end", "s.text", word_times(F.col("s.words"), F.col("s.start"), F.col("s.end")).alias("words"))


def word_times(words: Column, start: Column, end: Column, names: tuple[str, str] = ("start", "end")) -> Column:
    """Words whose missing times are those of their segment."""
    a, b = names
    return F.transform(words, lambda w: F.struct(w["word"].alias("word"), F.coalesce(w[a], start).alias(a), F.coalesce(w[b], end).alias(b)))


def gemini_files(spark: SparkSession, path: str, by_folder: bool = True) -> DataFrame:
    """``lecture_id, seq, speaker, text, start, end`` from a list of records or an object with labelled segments.

    In the second shape the label is the speaker, LECTURE where it is missing. Code fences are taken off.
    """
    docs = _json_texts(spark, path, by_folder)
    legacy = F.transform(F.from_json("doc", schemas.GEMINI_LEGACY)["segments"], lambda s: F.struct(
        F.coalesce(s["label"], F.lit("LECTURE")).alias("speaker"), s["text"].alias("text"), s["start"].alias("start"), s["end"].alias("end")))
    rows = F.when(F.col("doc").startswith("["), F.from_json("doc", f"array<{schemas.GEMINI.simpleString()}>")).otherwise(legacy)
    return docs.select("lecture_id", F.posexplode(rows).alias("seq", "s")).select("lecture_id", "seq", "s.*")


def window_files(spark: SparkSession, path: str, spans: DataFrame | None = None, by_folder: bool = False) -> DataFrame:
    """``lecture_id, seq, start, end, label`` from window objects or pairs of clock strings (labelled LECTURE).

    With ``spans`` (lecture_id, duration), lectures without a file get one window over the whole recording.
    """
    docs = _json_texts(spark, path, by_folder)
    pair = F.transform(F.from_json("doc", schemas.WINDOW_PAIRS), lambda p: F.struct(clock_seconds(F.try_element_at(p, F.lit(1))).alias("start"), clock_seconds(F.try_element_at(p, F.lit(2))).alias("end"), F.lit("LECTURE").alias("label")))
    objects = F.transform(F.from_json("doc", f"array<{schemas.WINDOW.simpleString()}>"), lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["label"].alias("label")))
    rows = docs.select("lecture_id", F.posexplode(F.when(F.col("doc").rlike(r"^\[\s*\["), pair).otherwise(objects)).alias("seq", "w")).select("lecture_id", "seq", "w.*")
    if spans is None:
        return rows
    bare = spans.join(docs.select("lecture_id"), "lecture_id", "left_anti").select("lecture_id", F.lit(0).alias("seq"), F.lit(0.0).alias("start"), F.col("duration").alias("end"), F.lit("LECTURE").alias("label"))
    return rows.unionByName(bare)


def turn_files(spark: SparkSession, path: str, by_folder: bool = False) -> DataFrame:
    """``lecture_id, seq, start, end, speaker`` from text lines; other lines are left out.

    ``seq`` grows with the line's place in its file.
    """
    lines = spark.read.text(path, wholetext=True).select((_folder(_path()) if by_folder else stem(_path())).alias("lecture_id"), F.posexplode(F.split("value", "\n")).alias("seq", "line"))
    f = diarization_line(F.col("line"))
    return lines.select("lecture_id", "seq", *[c.alias(n) for n, c in f.items()]).filter("speaker is not null")


def speaker_map_files(spark: SparkSession, path: str) -> DataFrame:
    """``lecture_id, local_id, speaker`` from nested JSON maps, one a file or several on lines of their own."""
    texts = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"(?<=\})\s*\n\s*(?=\{)")).alias("value"))
    docs = texts.select(F.from_json("value", schemas.SPEAKER_MAP).alias("m"))
    outer = docs.select(F.explode("m").alias("lecture_id", "inner"))
    return outer.select("lecture_id", F.explode("inner").alias("local_id", "speaker"))


def block_files(spark: SparkSession, path: str, by_folder: bool = False) -> DataFrame:
    """``lecture_id, turn, speaker, text`` from ``{speaker, text}`` records or ``{name: {text, ...}}`` / ``{name: text}`` ones."""
    docs = _json_texts(spark, path, by_folder).select("lecture_id", F.posexplode(F.from_json("doc", "array<map<string,string>>")).alias("turn", "m"))
    plain, name, value = F.map_contains_key("m", "speaker"), F.element_at(F.map_keys("m"), 1), F.element_at(F.map_values("m"), 1)
    inner = F.when(value.startswith("{"), F.get_json_object(value, "$.text")).otherwise(value)
    return docs.select("lecture_id", "turn", F.when(plain, F.try_element_at("m", F.lit("speaker"))).otherwise(name).alias("speaker"), F.when(plain, F.try_element_at("m", F.lit("text"))).otherwise(inner).alias("text"))


def vector_files(spark: SparkSession, path: str) -> DataFrame:
    """``lecture_id, seg_id, emb`` from .npy files in ``<lecture>/[embeddings/]<seg>.npy``; unreadable, empty and NaN ones are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", True).load(path).select("path", "content")

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p, c in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    x = np.load(io.BytesIO(c), allow_pickle=False).astype(np.float32).ravel()
                except (ValueError, OSError, EOFError):
                    continue
                if x.size and not np.isnan(x).any():
                    m = re.search(r"([^/]+)/(?:embeddings/)?([^/]+)\.npy$", p)
                    out.append((m[1], m[2], x))
            yield pd.DataFrame(out, columns=["lecture_id", "seg_id", "emb"])

    return files.mapInPandas(load, "lecture_id string, seg_id string, emb array<float>")


def docx_files(spark: SparkSession, path: str) -> DataFrame:
    """``lecture_id, para_no, text``: non-empty paragraphs of word-processor documents, read with zip and XML alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p, c in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(c)) as z:
                    root = ElementTree.fromstring(z.read("word/document.xml"))
                texts = ("".join(t.text or "" for t in para.iter(f"{ns}t")).strip() for para in root.iter(f"{ns}p"))
                name = re.sub(r"\.docx$", "", p.rsplit("/", 1)[-1])
                out += [(name, i, t) for i, t in enumerate(t for t in texts if t)]
            yield pd.DataFrame(out, columns=["lecture_id", "para_no", "text"])

    return files.mapInPandas(load, "lecture_id string, para_no bigint, text string")
