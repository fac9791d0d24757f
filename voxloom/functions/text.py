"""Text functions as Column builders; all but the edit distance of words run in the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# The fence of code in replies, and how a line of a turn file names its fields.
FENCE = "```"
LINE_FIELDS = {"start": "start=", "end": "stop=", "speaker": "speaker_"}


def words(text: Column) -> Column:
    """Words between white space, empties dropped; null text gives no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda x: x != "")


def align_token(token: Column) -> Column:
    """Token as alignment compares it: lower case, letters, digits and underscores of any script only (no loose accents)."""
    return F.regexp_replace(F.lower(token), r"[^\p{L}\p{N}_]", "")


def align_tokens(text: Column) -> Column:
    """Non-empty alignment tokens of a text, in order."""
    return F.filter(F.transform(words(text), align_token), lambda x: x != "")


def eval_tokens(text: Column) -> Column:
    """Tokens as evaluation compares them: lower-case ASCII letters and digits."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]", " "), " "), lambda x: x != "")


def sentences(text: Column) -> Column:
    """Pieces after each . ! or ? that white space follows."""
    return F.split(text, r"(?<=[.!?])\s+")


def strip_fence(text: Column) -> Column:
    """Text without a leading code fence (and its language) and trailing backticks; other text is only trimmed."""
    bare = _stripped(text)
    fenced = F.substr(bare, F.lit(len(FENCE) + 1))
    language = F.length(F.regexp_extract(fenced, r"^(\w*)", 1))
    body = F.substr(fenced, language + 1)
    return F.when(bare.startswith(FENCE), _stripped(F.rtrim(body, F.lit("`")))).otherwise(bare)


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def first_text(*options: Column) -> Column:
    """The first option that is neither null nor empty, trimmed; '' if there is none."""
    return F.trim(F.coalesce(*[F.nullif(o, F.lit("")) for o in options], F.lit("")))


def set_f1(a: Column, b: Column) -> Column:
    """F1 of two token arrays as sets; 0 if either is empty."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    common = F.size(F.array_intersect(x, y)).cast("double")
    p, r = common / F.size(y), common / F.size(x)
    return F.when((F.size(x) == 0) | (F.size(y) == 0) | (common == 0), F.lit(0.0)).otherwise(2 * p * r / (p + r))


def edit_distance(a: list, b: list) -> int:
    """Least number of substitutions, insertions and deletions from ``a`` to ``b``.

    A column of the table is kept as two integers of bits, where it rises and where it falls along ``a``, and made from the one before
    by a few operations on whole integers: memory grows with ``a`` only, time with the product over the bits of a machine word.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if not a or not b:
        return max(len(a), len(b))
    where: dict = {}
    for i, t in enumerate(a):
        where[t] = where.get(t, 0) | 1 << i
    full, last, rises, falls, score = (1 << len(a)) - 1, 1 << len(a) - 1, (1 << len(a)) - 1, 0, len(a)
    for t in b:
        eq = where.get(t, 0)
        level = (((eq & rises) + rises) ^ rises) | eq
        up, down = falls | (full & ~(level | rises)), rises & level
        score += bool(up & last) - bool(down & last)
        up, down = (up << 1 | 1) & full, down << 1 & full
        side = eq | falls
        rises, falls = down | (full & ~(side | up)), up & side
    return score


def word_errors(ref: Column, hyp: Column) -> Column:
    """Least number of word substitutions, insertions and deletions from ``ref`` to ``hyp`` (token arrays without nulls or spaces)."""
    return _word_errors(F.array_join(ref, " "), F.array_join(hyp, " "))


@F.pandas_udf(IntegerType())
def _word_errors(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else edit_distance(a.split(), b.split()) for a, b in zip(ref, hyp, strict=True)], dtype="Int32")


def wer(ref: Column, hyp: Column) -> Column:
    """Word error rate of token arrays; 0 for an empty reference."""
    return F.when(F.size(ref) == 0, F.lit(0.0)).otherwise(word_errors(ref, hyp) / F.size(ref))


def diarization_line(line: Column) -> dict[str, Column]:
    """Fields of a line ``start=1.0s stop=2.5s speaker_X``, whatever else and in whatever order stands in it; all null where one is missing."""
    def first(prefix: str) -> Column:
        return F.try_element_at(F.filter(words(line), lambda w: w.startswith(prefix)), F.lit(1))

    found = {name: first(prefix) for name, prefix in LINE_FIELDS.items()}
    value = {name: F.substr(w, F.lit(len(LINE_FIELDS[name]) + 1)) for name, w in found.items()}
    times = {name: F.when(value[name].endswith("s"), F.rtrim(value[name], F.lit("s"))).try_cast("double") for name in ("start", "end")}
    who = F.regexp_extract(value["speaker"], r"(?U)^\w+", 0)
    whole = times["start"].isNotNull() & times["end"].isNotNull() & (who != "")
    return {name: F.when(whole, c) for name, c in {**times, "speaker": who}.items()}


def is_heading(line: Column, main_speaker: str) -> Column:
    """Is a paragraph a speaker heading: the main speaker, 'Audience n' or 'Speaker n', in any case."""
    name = "".join("\\" + c if not c.isalnum() and c != " " else c for c in main_speaker)
    return F.trim(line).rlike(rf"(?i)^({name}|Audience \d+|Speaker \d+)$")


def stem(path: Column) -> Column:
    """File name without folders and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
