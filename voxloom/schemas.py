"""Explicit schemas of the logical tables; nothing is inferred from data."""

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


WORD = _struct(word=_S, start=_D, end=_D)
WHISPER = _struct(start=_D, end=_D, text=_S, words=T.ArrayType(WORD))
GEMINI = _struct(speaker=_S, text=_S, start=_D, end=_D)
GEMINI_LEGACY = _struct(file_id=_S, segments=T.ArrayType(_struct(label=_S, text=_S, start=_D, end=_D)))
WINDOW = _struct(start=_D, end=_D, label=_S, rms=_D, centroid=_D, zcr=_D)
WINDOW_PAIRS = T.ArrayType(T.ArrayType(_S))
ITEM = _struct(type=_S, start=_D, end=_D, whisper_transcript=_S, words=T.ArrayType(WORD), gemini_transcript=_S, speaker=_S, alignment_score=_D)
TURN = _struct(lecture_id=_S, seq=_L, start=_D, end=_D, speaker=_S)
EMBEDDING = _struct(lecture_id=_S, seg_id=_S, emb=T.ArrayType(T.FloatType()))
SPEAKER_MAP = T.MapType(_S, T.MapType(_S, _S))
BLOCK = _struct(text=_S, start=_S, end=_S)
