"""Speech records: what is written time, sound note, label, hesitation or word in a transcript's text, and who speaks.

Shared by the turn builder (problem 4) and the run collapser (problem 5).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.scan import block_last, salted_join
from voxloom.session import checkpointed

#: Records of one lecture that a task orders at once, as a range of ids.
BLOCK_IDS = 4096
ORDER = "gem_id"

_CLOCK = r"(?:\d{1,3}:)?\d{1,2}:\d{2}(?:[.,]\d+)?"
TIME = re.compile(rf"[\[(<]\s*({_CLOCK})\s*[\])>]|^\s*({_CLOCK})\s*[-–—|]\s+")
NOTE = re.compile(r"\[[^\[\]]*\]|\([^()]*\)|<[^<>]*>|\{[^{}]*\}|\*{1,2}[^*]+\*{1,2}|[♪♫♬]+(?:[^♪♫♬]*[♪♫♬]+)?|[\[<{][^\[\]<>{}]{0,40}$")
_HERE = r"(?<![\w'’\-].)"
#: Each branch begins with a letter, so that the search skips to candidates; the place before it is looked at after that.
HESITATION = re.compile(rf"(?:u{_HERE}u*(?:h+[\- ]huh+|h-uh|h+|m+)|m{_HERE}m*(?:[\- ]?h+m+|m)|h{_HERE}h*m+|e{_HERE}(?:e*r+m*|e*h+)|a{_HERE}a*h+)(?![\w'’])(?:\s*(?:\.{{2,}}|…|,))?", re.I)
_MARKS = re.compile(r"[\[(<{*♪♫♬]|\d:\d")
LEAD = re.compile(r"^\s*[\"'“]?(\*{0,2}[^:\n]{1,60}?\*{0,2})\s*:(?:\s+|$)")
#: What can name a speaker though no label column does: two or three capitalised words.
_PROPER = re.compile(r"^\W*[^\W\d_a-zß-ÿ][\w'’\-]*(?: [^\W\d_a-zß-ÿ][\w'’\-]*){1,2}\W*$")
_NUMBER = re.compile(r"^(?:speaker|spkr|spk|sp|s)[\s_\-.#]*0*(\d{1,6})$")
# What stands for no speaker.
NOBODY = {"", "-", "--", "—", "?", "??", "unknown", "unknown speaker", "n/a", "na", "none", "null", "nan", "speaker", "unidentified", "unclear", "tbd", "anonymous", "no speaker"}


def plain(text: str) -> str:
    """Case-folded, without accents, compatibility forms replaced."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


@lru_cache(maxsize=200_000)
def label_key(label: str | None) -> str | None:
    """A label without its dress: '#3' for a numbered speaker, else the given name and surname; None for nobody."""
    if label is None:
        return None
    s = re.sub(r"\s+", " ", plain(label)).strip()
    s = re.sub(r"(?<=\w)\s*\([^()]*\)\s*:?$", "", s)
    s = re.sub(r"^[\[(<{*\"'“\s]+|[\])>}*\"'”:\s]+$", "", s) if len(s) > 1 else s
    if s in NOBODY or not re.search(r"\w", s):
        return None
    if m := _NUMBER.match(s):
        return f"#{int(m[1])}"
    if s.count(",") == 1:
        last, first = (x.strip() for x in s.split(","))
        s = f"{first} {last}" if first else last
    return re.sub(r"\s+", " ", re.sub(r"[._]", " ", s)).strip() or None


def written_time(text: str | None) -> float | None:
    m = TIME.search(text or "")
    if not m:
        return None
    at = 0.0
    for part in (m[1] or m[2]).replace(",", ".").split(":"):
        at = at * 60 + float(part)
    return at


def strip_marks(text: str) -> tuple[str, list[str]]:
    """Text without written times and sound notes, and the notes."""
    if not _MARKS.search(text):
        return text.strip(), []
    text = TIME.sub(" ", text)
    notes = [m[0] for m in NOTE.finditer(text)]
    text = NOTE.sub(" ", text) if notes else text
    return TIME.sub(" ", text.strip()), notes


def names_speaker(text: str) -> bool:
    """Is the label that leads a text a full name by its looks."""
    m = LEAD.search(text) if ":" in text else None
    return bool(m and _PROPER.match(m[1]))


def lead_label(text: str) -> tuple[str | None, str]:
    """The key of a label that may lead the text (marks taken off), and the text after it."""
    if ":" not in text:
        return None, text
    bare = text.strip()
    while (m := HESITATION.match(bare)) and m[0]:
        bare = bare[m.end():].lstrip()
    m = LEAD.match(bare)
    if not m:
        return None, text
    key = label_key(m[1])
    if key is None or not (key[0] == "#" or 1 <= len(key.split(" ")) <= 4 and not re.search(r"\d", key)):
        return None, text
    return key, bare[m.end():]


_BEFORE_MARK = re.compile(r" ([,.!?;:])")
_APOSTROPHE = re.compile(r"(?<=\w)['’](?=\w)")
_WORDS = re.compile(r"[^\W_]+")


def clean_words(text: str) -> str:
    """Text without hesitations, spaces made single."""
    return _BEFORE_MARK.sub(r"\1", " ".join(HESITATION.sub(" ", text).split())).strip(" ,")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(plain(_APOSTROPHE.sub("", text)))


PARSED = ("gem_id bigint, lecture_id string, start_s double, end_s double, own string, lead string, whole string, after string, whole_key string, after_key string, "
          "note string, hesitant boolean, has_text boolean, lead_named boolean")


def squeezed(text: str) -> str:
    """The words of a text without spaces, for comparing."""
    return "".join(words_of(text))


def parse(gemini: DataFrame) -> DataFrame:
    """One row a record: label keys, texts without marks (with and without a leading label), their words squeezed, notes.

    Repeated keys count once; records without gem_id or lecture_id are left out. A null text parses as no words. ``after``
    and ``after_key`` are null where no label may lead the text.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                text = r.text if isinstance(r.text, str) else None
                bare, notes = strip_marks(text or "")
                lead, after = lead_label(bare)
                whole = clean_words(bare)
                after = None if lead is None else clean_words(after)
                at = r.start_s if r.start_s == r.start_s and r.start_s is not None else written_time(text)
                out.append((r.gem_id, r.lecture_id, at, r.end_s, label_key(r.speaker if isinstance(r.speaker, str) else None), lead, whole, after, squeezed(whole),
                            None if after is None else squeezed(after), " ".join(plain(n) for n in notes) or None, bool(notes) and bool(HESITATION.search(bare)), text is not None,
                            lead is not None and names_speaker(bare)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PARSED.split(", ")])

    # The first to arrive of repeated keys; they are alike in what is read here.
    rows = (gemini.select("gem_id", "lecture_id", "speaker", "text", F.col("start_s").cast("double").alias("start_s"), F.col("end_s").cast("double").alias("end_s"))
            .filter("gem_id is not null and lecture_id is not null").dropDuplicates(["gem_id"]))
    hashes = {f"{k}_hash": F.xxhash64(f"{k}_key") for k in ("whole", "after")} | {f"{k}_len": F.length(f"{k}_key") for k in ("whole", "after")}
    return rows.mapInPandas(run, PARSED).withColumns(hashes)


class Union:
    """Union-find over hashable items."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def near(a: str, b: str) -> bool:
    """One letter apart: wrong, missing, added, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:] or (a[i:i + 2] == b[i:i + 2][::-1] and a[i + 2:] == b[i + 2:])


def cluster_labels(keys: list[str], counts: list[int], sure: list[bool] | None = None) -> dict[str, str]:
    """Label key -> canonical key, within one lecture.

    Numbers stand for themselves. Full names (two words or more) are joined when equal but for one letter in one long
    word. An initial with a surname joins the one full name it fits, a single word the one name that has it as given name
    or surname, by likeness where no name has it exactly. A form that fits two different speakers stays by itself.
    Keys that are not ``sure`` (seen only in front of a text, without the looks of a full name) may join a speaker but make
    none, unless numbered.
    """
    sure = sure or [True] * len(keys)
    weight = dict(zip(keys, counts, strict=True))
    trusted = {k for k, s in zip(keys, sure, strict=True) if s}
    union, named = Union(), sorted(k for k in keys if k[0] != "#")
    parts = {k: k.split(" ") for k in named}
    initial = {k: len(p) >= 2 and len(p[0]) == 1 for k, p in parts.items()}
    full = [k for k in named if len(parts[k]) >= 2 and not initial[k]]
    for k in keys:
        union.find(k)
    by_word: dict[str, list[str]] = {}
    for k in full:
        for w in {parts[k][0], parts[k][-1]}:
            by_word.setdefault(w, []).append(k)
    # Full names that share one word and are one letter apart in the other: two such words have a form with one letter less in common,
    # so every pair of near names meets under one of these keys, however many names share the word.
    met: dict[tuple, list[str]] = {}
    for k in full:
        given, surname = parts[k][0], parts[k][-1]
        for side, kept, other, least in ((0, given, surname, 5), (1, surname, given, 4)):
            if len(other) >= least:
                for form in {other, *(other[:i] + other[i + 1:] for i in range(len(other)))}:
                    met.setdefault((side, kept, form), []).append(k)
    for (side, _, _), group in met.items():
        word = -1 if side == 0 else 0
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                if union.find(a) != union.find(b) and near(parts[a][word], parts[b][word]):
                    union.join(a, b)

    def fit(options: list[str], k: str) -> None:
        roots = {union.find(o) for o in options}
        if len(roots) == 1:
            union.join(k, roots.pop())

    for k in named:
        if initial[k]:
            fit([f for f in by_word.get(parts[k][-1], []) if parts[f][-1] == parts[k][-1] and f[0] == k[0]], k)
    forms = {}
    for k in named:
        if initial[k]:
            forms.setdefault(parts[k][-1], []).append(k)
    for k in named:
        if len(parts[k]) == 1:
            exact = by_word.get(k, []) or forms.get(k, [])
            fit(exact or [f for w, fs in by_word.items() if len(k) >= 5 and near(w, k) for f in fs], k)
    members: dict[str, list[str]] = {}
    for k in keys:
        members.setdefault(union.find(k), []).append(k)
    out = {}
    for group in members.values():
        best = max(group, key=lambda k: (k in trusted, not initial.get(k, False) and len(k.split(" ")) >= 2, weight[k], k))
        for k in group:
            if best in trusted or best[0] == "#":
                out[k] = best
    return out


def speakers(parsed: DataFrame) -> DataFrame:
    """``lecture_id, label, speaker``: canonical speaker of every label key of a lecture.

    Labels are counted before they are gathered, so a lecture's group holds its distinct labels only.
    """
    seen = (parsed.select("lecture_id", F.explode(F.array(F.struct(F.col("own").alias("label"), F.lit(1).alias("sure")), F.struct(F.col("lead").alias("label"), F.col("lead_named").cast("int").alias("sure")))).alias("x"))
            .filter("x.label is not null").groupBy("lecture_id", F.col("x.label").alias("label")).agg(F.count("*").alias("n"), F.max("x.sure").alias("sure")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Lectures come whole and in order within a task; one may go over the end of a batch."""
        lecture, held = None, []

        def close() -> list[tuple]:
            names = cluster_labels([r.label for r in held], [r.n for r in held], [bool(r.sure) for r in held]) if held else {}
            return [(lecture, k, v) for k, v in names.items()]

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if r.lecture_id != lecture:
                    out += close()
                    lecture, held = r.lecture_id, []
                held.append(r)
            yield pd.DataFrame(out, columns=["lecture_id", "label", "speaker"])
        yield pd.DataFrame(close(), columns=["lecture_id", "label", "speaker"])

    # The number of tasks is given: labels are few bytes and much work, so they must not be put together by size.
    tasks = parsed.sparkSession.sparkContext.defaultParallelism
    return seen.repartition(tasks, "lecture_id").sortWithinPartitions("lecture_id", "label").mapInPandas(run, "lecture_id string, label string, speaker string")


def attributed(parsed: DataFrame) -> DataFrame:
    """Parsed records with ``speaker`` (canonical, null if none is known), ``led`` (a label leads the text), ``speech``, ``blk``.

    The record's own label counts, else the label that leads its text if it names a speaker of the lecture, else the
    speaker of the speech record before. Texts stay behind: what is ordered and joined here are ids, labels, lengths and
    hashes; :func:`with_text` fetches the text of the rows that need it.
    """
    names = speakers(parsed)
    rows = parsed.select("gem_id", "lecture_id", "own", "lead", "start_s", "end_s", "hesitant", "has_text", F.xxhash64("note").alias("note_hash"), F.col("note").isNotNull().alias("noted"),
                         "whole_hash", "after_hash", "whole_len", "after_len")
    own = salted_join(rows, names.select("lecture_id", F.col("label").alias("own"), F.col("speaker").alias("_own")), ["lecture_id", "own"], F.col("gem_id"))
    both = salted_join(own, names.select("lecture_id", F.col("label").alias("lead"), F.col("speaker").alias("_lead")), ["lecture_id", "lead"], F.col("gem_id"))
    led = F.col("_lead").isNotNull()
    size = F.when(led, F.col("after_len")).otherwise(F.col("whole_len"))
    told = both.select("gem_id", "lecture_id", "start_s", "end_s", led.alias("led"), F.coalesce("_own", "_lead").alias("named"), (size > 0).alias("speech"), size.alias("size"),
                       F.when(led, F.col("after_hash")).otherwise(F.col("whole_hash")).alias("hash"), "noted", "note_hash", "hesitant", "has_text", F.floor(F.col(ORDER) / BLOCK_IDS).alias("blk"))
    filled = block_last(checkpointed(told), ["lecture_id"], "blk", [F.col(ORDER)], "carried", F.when(F.col("speech"), F.col("named")), inclusive=False)
    return checkpointed(filled.withColumn("speaker", F.coalesce("named", "carried")).drop("named", "carried"))


def with_text(rows: DataFrame, parsed: DataFrame, ident: str = "gem_id", keys: bool = False) -> DataFrame:
    """``rows`` (with ``ident`` and ``led``) with ``text``, the clean text of that record, or its squeezed words (``keys``)."""
    a, b = ("after_key", "whole_key") if keys else ("after", "whole")
    told = parsed.select(F.col("gem_id").alias(ident), F.col(a).alias("_a"), F.col(b).alias("_b"))
    return rows.join(told, ident).withColumn("text", F.when(F.col("led"), F.col("_a")).otherwise(F.col("_b"))).drop("_a", "_b")
