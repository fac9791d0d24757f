"""Texts cut into chunks of bounded length at sentence ends, with times shared out by length."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import sentences
from voxloom.operators.windows import running_offset


_SENTENCE_GAP = re.compile(r"(?<=[.!?])\s+")


def _greedy(pieces, most: int):
    """SQL fold: pieces joined by spaces while they fit (length, space and all, at most ``most``)."""
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc, p):
        fits = F.length(acc["cur"]) + F.length(p) + 1 <= most
        joined = F.when(acc["cur"] == "", p).otherwise(F.concat(acc["cur"], F.lit(" "), p))
        closed = F.when(acc["cur"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["cur"]))
        return F.struct(F.when(fits, acc["done"]).otherwise(closed).alias("done"), F.when(fits, joined).otherwise(p).alias("cur"))

    return F.aggregate(pieces, zero, step, lambda acc: F.when(acc["cur"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["cur"])))


def packed(pieces: list[str], most: int) -> list[str]:
    """Pieces in order, joined by spaces to as few texts of at most ``most`` characters; a longer piece is a text by itself.

    The ends of all pieces are summed once, and each text's last piece is found by binary search in the sums.
    """
    ends = list(accumulate((len(p) + 1 for p in pieces), initial=0))
    out, i = [], 0
    while i < len(pieces):
        j = max(i + 1, bisect_right(ends, ends[i] + most + 1) - 1)
        out.append(" ".join(pieces[i:j]))
        i = j
    return out


def split_text(text: str, most: int, repeat: bool = False) -> list[str]:
    """Chunks of at most ``most`` characters: whole sentences while they fit, single words of longer ones.

    A text is a row of lanes, each packed by itself: neighbouring sentences that fit are one lane, each longer sentence is a lane of
    its words. A single word longer than ``most`` is a chunk of its own. With ``repeat``, the chunk before a long sentence is put out
    again behind it, in front of what follows, as older consumers expect.
    """
    sents = [x for x in _SENTENCE_GAP.split(text) if x.strip()]
    lanes = groupby(enumerate(sents), key=lambda x: x[0] if len(x[1]) > most else -1)
    out, before, carried = [], [], []
    for at, lane in lanes:
        pieces = [s for _, s in lane]
        if at < 0:
            out += packed(carried + pieces, most)
            before, carried = out[-1:], []
        else:
            out += carried + packed(pieces[0].split(), most)
            carried = before if repeat else []
    return [c for c in (x.strip() for x in out + carried) if c]


def chunked(df: DataFrame, text: str, most: int, repeat: bool = False) -> DataFrame:
    """``df`` with one row a chunk: ``chunk_no`` from 0 and ``chunk``; empty and null texts give no rows.

    Texts within the limit stay whole and never leave the JVM; only longer ones go through Python, in Arrow batches.
    """
    short = df.filter(F.length(text) <= most).withColumns({"chunk_no": F.lit(0), "chunk": F.trim(text)}).filter("chunk <> ''")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lists = [split_text(t.strip(), most, repeat) for t in pdf[text]]
            out = pdf.loc[pdf.index.repeat([len(x) for x in lists])].reset_index(drop=True)
            out["chunk_no"] = [i for x in lists for i in range(len(x))]
            out["chunk"] = [c for x in lists for c in x]
            yield out

    schema = ", ".join([*(f"`{n}` {k}" for n, k in df.dtypes), "chunk_no int, chunk string"])
    return short.unionByName(df.filter(F.length(text) > most).mapInPandas(cut, schema))


def chunk_counts(df: DataFrame, text: str, most: int) -> DataFrame:
    """``df`` with ``chunks``, an array by a fold in the JVM; for texts all of whose sentences fit."""
    return df.withColumn("chunks", _greedy(sentences(F.col(text)), most))


def prorated(chunks: DataFrame, keys: list[str], s: str = "s", e: str = "e", scale: float = 1.0) -> DataFrame:
    """Chunks with ``from_s`` and ``to_s``: the span of each text shared out by chunk length, in order."""
    total = chunks.groupBy(*keys).agg(F.sum(F.length("chunk")).alias("_total"))
    sized = chunks.join(total, keys).withColumn("_d", F.length("chunk") / F.greatest("_total", F.lit(1)) * (F.col(e) - F.col(s)))
    moved = running_offset(sized, keys, "chunk_no", "_d", "_before")
    return moved.withColumns({"from_s": (F.col(s) + F.col("_before")) * scale, "to_s": (F.col(s) + F.col("_before") + F.col("_d")) * scale}).drop("_total", "_d", "_before")
