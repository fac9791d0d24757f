"""Writers of the file shapes."""

from __future__ import annotations

import io
import zipfile
from itertools import groupby
from xml.sax.saxutils import escape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.timeutil import hms


def block_json(blocks: DataFrame, key: str = "lecture_id", order: tuple[str, ...] = ("block_no",)) -> DataFrame:
    """``key, doc``: one JSON array a recording, ``[{speaker: {text, start, end}}, ...]`` with clock times (s, e in ms)."""
    body = F.struct("text", hms(F.col("s") / 1000).alias("start"), hms(F.col("e") / 1000).alias("end"))
    rows = F.sort_array(F.collect_list(F.struct(*order, "speaker", body.alias("b"))))
    return blocks.groupBy(key).agg(F.to_json(F.transform(rows, lambda r: F.create_map(r["speaker"], r["b"]))).alias("doc"))


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key brought together, so that a folder gets one file and not one a task; Spark splits what is too large for one."""
    return df.hint("rebalance", F.col(key))


def write_json_lines(df: DataFrame, path: str, key: str = "lecture_id") -> None:
    """JSON lines, a folder a recording; UTF-8 as it is."""
    by_key(df, key).write.mode("overwrite").partitionBy(key).json(path)


def write_documents(docs: DataFrame, path: str, key: str = "lecture_id") -> None:
    """One text file's content a row (``doc``), a folder a recording."""
    by_key(docs.select(key, F.col("doc").alias("value")), key).write.mode("overwrite").partitionBy(key).text(path)


def turn_lines(turns: DataFrame, *keep: str) -> DataFrame:
    """``lecture_id, value`` (and columns to ``keep``): ``start=1.0s stop=2.5s speaker_X`` lines of turns (start, end in seconds)."""
    line = F.format_string("start=%.1fs stop=%.1fs speaker_%s", F.col("start").cast("double"), F.col("end").cast("double"), F.regexp_replace("speaker", "^speaker_", ""))
    return turns.filter("start is not null and end is not null and speaker is not null").select("lecture_id", *keep, line.alias("value"))


def write_map(names: DataFrame, path: str) -> None:
    """Nested speaker map, one JSON object a recording and line."""
    per = names.groupBy("lecture_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("local_id", "speaker")))).alias("m"))
    per.select(F.to_json(F.create_map("lecture_id", "m")).alias("value")).write.mode("overwrite").text(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    vectors.write.mode("overwrite").parquet(path)


def _put(path: str, name: str, content: bytes) -> None:
    """A file written from an executor into a folder that all share; a task that is done again writes it again."""
    from pyarrow import fs

    there, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    full = f"{root}/{name}"
    there.create_dir(full.rsplit("/", 1)[0], recursive=True)
    with there.open_output_stream(full) as f:
        f.write(content)


def write_npy(vectors: DataFrame, path: str) -> None:
    """One .npy file a vector, ``<lecture>/embeddings/<seg>.npy``, written by the executors."""
    def write(rows) -> None:
        for r in rows:
            buffer = io.BytesIO()
            np.save(buffer, np.asarray(r.emb, dtype=np.float32))
            _put(path, f"{r.lecture_id}/embeddings/{r.seg_id}.npy", buffer.getvalue())

    vectors.filter("emb is not null").select("lecture_id", "seg_id", "emb").foreachPartition(write)


def write_docx(paragraphs: DataFrame, path: str, order: str, key: str = "lecture_id") -> None:
    """One word-processor document a recording, its texts as paragraphs in order; a document is written by one task, paragraph by paragraph."""
    def write(rows) -> None:
        for name, mine in groupby(rows, key=lambda r: r[key]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z, z.open("word/document.xml", "w") as f:
                f.write(b'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>')
                for r in mine:
                    f.write(f'<w:p><w:r><w:t xml:space="preserve">{escape(r.text)}</w:t></w:r></w:p>'.encode())
                f.write(b"</w:body></w:document>")
            _put(path, f"{name}.docx", buffer.getvalue())

    paragraphs.select(key, order, "text").repartition(key).sortWithinPartitions(key, order).foreachPartition(write)


def write_report(df: DataFrame, path: str, files: int = 1) -> None:
    """CSV with a header, in ``files`` files; an evaluation report is small by nature."""
    df.coalesce(files).write.mode("overwrite").option("header", True).csv(path)
