"""Problem 10: one consistent form for texts that look the same.

A transducer is compiled once from rules (Unicode decompositions for widths and joined letters, categories for spaces, the list of
characters that don't show) and a short table of look-alike letters, and checked for conflicts: a table of single characters, and a
trie that puts a base and its marks together, the longest way first. It runs over the grapheme clusters of a text in one pass:
single characters by the table, clusters with marks by the trie.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.scan import salted_join
from voxloom.session import checkpointed

# Letters of other scripts that are drawn like Latin ones, and the Latin letters.
LOOK_ALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
    # Armenian and others
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "Ս": "U", "Տ": "S", "Օ": "O", "ı": "i", "ɡ": "g", "ɑ": "a",
    # Marks
    "‐": "-", "‑": "-", "﹣": "-", "՝": "'", "ꞌ": "'", "∶": ":", "꞉": ":", "∕": "/", "⁄": "/", "ʼ": "’",
}
#: Canonically equal characters of other blocks that Unicode itself maps, and line ends.
LINES = {"\r\n": "\n", "\r": "\n", "\u0085": "\n", "\u2028": "\n", "\u2029": "\n"}
_TAGS = ("<wide>", "<narrow>", "<noBreak>", "<font>")


# Code points that Unicode tells programs not to show (default ignorable), as ranges.
HIDDEN = ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164),
          (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF))
#: Scripts whose letters change their shape at a joiner: Arabic to Thaana and N'Ko, the Indic ones, Mongolian.
JOINING = "\u0600-\u07ff\u0840-\u08ff\u0900-\u0dff\u1000-\u109f\u1780-\u17ff\u1800-\u18af\ufb50-\ufdff\ufe70-\ufefc"
JOINERS = "\u200c\u200d"


def _invisible(c: str) -> bool:
    o = ord(c)
    return any(a <= o <= b for a, b in HIDDEN)


def _expand(c: str) -> str:
    """Width, font and joined forms to plain characters, once and for all (no rule applies to the result)."""
    d = unicodedata.decomposition(c)
    if not d or d[0] != "<":
        return c
    tag, *codes = d.split()
    plain = "".join(chr(int(x, 16)) for x in codes)
    letters = all(x.isalpha() for x in plain) and len(plain) > 1
    if tag in _TAGS or tag == "<compat>" and (letters or plain in ("...", "..", "μ") or unicodedata.category(c) == "Zs"):
        return "".join(map(_expand, plain))
    return c


@lru_cache(maxsize=1)
def singles() -> dict[str, str]:
    """Every single character that changes, with its plain form. Raises where rules disagree or a result would change again."""
    out: dict[str, str] = {}

    def add(c: str, to: str, rule: str) -> None:
        if c != to and out.setdefault(c, to) != to:
            raise ValueError(f"{rule}: {c!r} is mapped to {out[c]!r} and {to!r}")

    for a, b in HIDDEN:
        for o in range(a, b + 1):
            add(chr(o), "", "invisible")
    for o in range(128, sys.maxunicode + 1):
        c = chr(o)
        if c in LINES or out.get(c) == "":
            continue
        if unicodedata.category(c) == "Zs":
            add(c, " ", "space")
        elif c in LOOK_ALIKES or unicodedata.decomposition(c):
            add(c, unicodedata.normalize("NFC", "".join(LOOK_ALIKES.get(x, x) for x in unicodedata.normalize("NFD", _expand(c)))), "form")
    add("\t", " ", "space")
    for c, to in LINES.items():
        add(c, to, "line")
    for c, to in LOOK_ALIKES.items():
        add(c, to, "look-alike")
    for c, to in out.items():
        for x in to:
            if out.get(x, x) != x:
                raise ValueError(f"the form {to!r} of {c!r} holds {x!r}, which changes again")
    return out


@lru_cache(maxsize=1)
def transducer() -> tuple[dict[int, str], dict, frozenset[str], re.Pattern, re.Pattern]:
    """What is compiled once: the table of single characters, the trie of compositions, the marks, and what finds marks and joiners.

    The trie leads from a base and marks in canonical order to the one character that stands for them; the longest way through it is
    taken. Joiners are not in the table: they go unless they stand between emoji, or letters of a script that they shape.
    """
    table = {ord(c): to for c, to in singles().items() if c not in JOINERS and len(c) == 1}
    trie: dict = {}
    marks, second = [], {0x1161 + i for i in range(21)} | {0x11A8 + i for i in range(27)}
    for o in range(sys.maxunicode + 1):
        if 0xD800 <= o <= 0xDFFF or 0xAC00 <= o <= 0xD7A3:
            continue
        c = chr(o)
        parts = unicodedata.decomposition(c).split()
        if not parts or parts[0][0] == "<":
            continue
        full = unicodedata.normalize("NFD", c)
        if unicodedata.normalize("NFC", full) == c:
            node = trie
            for x in full:
                node = node.setdefault(x, {})
            node[""] = c
        if len(parts) == 2:
            second.add(int(parts[1], 16))
    for o in range(0x80, sys.maxunicode + 1):
        if not 0xD800 <= o <= 0xDFFF and (o in second or unicodedata.category(chr(o)) in ("Mn", "Me")) and not _invisible(chr(o)):
            if marks and marks[-1][1] == o - 1:
                marks[-1][1] = o
            else:
                marks.append([o, o])
    follow = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in marks)
    emoji = "\u2190-\u2bff\u3030\u303d\u3297\u3299\U0001f000-\U0001faff"
    shown = rf"(?<=[{JOINING}])[{JOINERS}](?=[{JOINING}])|(?<=[{emoji}])\u200d(?=[{emoji}])"
    return table, trie, frozenset(chr(o) for a, b in marks for o in range(a, b + 1)), re.compile(f"[{follow}]+"), re.compile(rf"({shown})|[{JOINERS}]")


@lru_cache(maxsize=200_000)
def _cluster(cluster: str) -> str:
    """A base with its marks in canonical order, put together by the longest way through the trie."""
    table, trie = transducer()[:2]
    seq = list("".join(LOOK_ALIKES.get(c, c) for c in unicodedata.normalize("NFD", cluster)))
    if any("\u1100" <= c <= "\u11ff" for c in seq):  # syllables are put together by a rule of arithmetic
        return unicodedata.normalize("NFC", "".join(seq))
    out, i = [], 0
    while i < len(seq):
        node, best, j = trie, (i + 1, seq[i]), i
        while j < len(seq) and seq[j] in node:
            node = node[seq[j]]
            j += 1
            if "" in node:
                best = (j, node[""])
        i = best[0]
        out.append(best[1])
    return "".join(out).translate(table)


def canonical(text: str | None) -> str | None:
    """The one form of a text for comparing: null stays null, ASCII texts without tabs and carriage returns stay as they are.

    Case, accents, digits, marks and line breaks are kept; applying it again changes nothing. Look-alike letters become Latin ones
    wherever they stand, so the form is a key, not a text to read (see :func:`cleaned`).
    """
    if text is None or text.isascii() and "\t" not in text and "\r" not in text:
        return text
    table, _, marks, runs, joiners = transducer()
    out = (text.replace("\r\n", "\n") if "\r" in text else text).translate(table)
    if "\u200c" in out or "\u200d" in out:
        out = joiners.sub(lambda m: m[1] or "", out)
    if marks.isdisjoint(out):
        return out
    done, at = [], 0
    for m in runs.finditer(out):
        base = max(at, m.start() - 1)  # marks at the start of a text have none
        done += (out[at:base], _cluster(out[base:m.end()]))
        at = m.end()
    return "".join(done) + out[at:]


@lru_cache(maxsize=1)
def _scripts() -> tuple[dict[int, str], dict[str, dict[int, str]], dict[str, str], re.Pattern]:
    """The table without look-alike letters, for each other script the way back from Latin letters, scripts of letters, and words."""
    one = singles()
    letters = {c: to for c, to in LOOK_ALIKES.items() if c.isalpha() and unicodedata.category(c) != "Lm"}
    kept = {}
    for c, to in one.items():
        if c in JOINERS or c in letters or len(c) > 1:
            continue
        own = unicodedata.normalize("NFC", _expand(c))
        kept[ord(c)] = own if any(x in letters for x in unicodedata.normalize("NFD", own)) else to
    back: dict[str, dict[int, str]] = {}
    for c, to in letters.items():
        if _script(c) != "LATIN":
            back.setdefault(_script(c), {}).setdefault(ord(to), c)
    return kept, back, letters, re.compile(r"[^\W\d_]+(?:[\u0300-\u036f]+[^\W\d_]*)*")


@lru_cache(maxsize=50_000)
def _script(c: str) -> str:
    name = unicodedata.name(c, "").split(" ")[0]
    return name if name in ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN") else ""


@lru_cache(maxsize=200_000)
def _one_script(word: str) -> str:
    """A word of mixed scripts in the one that its letters without a double belong to, else in Latin; other words as they are."""
    _, back, letters, _ = _scripts()
    plain = unicodedata.normalize("NFD", word)
    used = {s for c in plain if (s := _script(c))}
    if len(used) < 2:
        return word
    sure = {s for c in plain if (s := _script(c)) and c not in letters and not any(ord(c) in back.get(o, ()) for o in used - {"LATIN"})}
    to = next((s for s in ("CYRILLIC", "GREEK", "ARMENIAN") if s in sure), None) if "LATIN" not in sure else "LATIN"
    mapped = plain.translate(back[to]) if to in back else "".join(letters.get(c, c) for c in plain)
    return unicodedata.normalize("NFC", mapped)


def cleaned(text: str | None) -> str | None:
    """A text to read: as :func:`canonical`, but look-alike letters change only in words that mix scripts."""
    if text is None or text.isascii() and "\t" not in text and "\r" not in text:
        return text
    table, _, _, words = _scripts()
    joiners = transducer()[4]
    out = (text.replace("\r\n", "\n") if "\r" in text else text).translate(table)
    if "\u200c" in out or "\u200d" in out:
        out = joiners.sub(lambda m: m[1] or "", out)
    return words.sub(lambda m: m[0] if m[0].isascii() else _one_script(m[0]), unicodedata.normalize("NFC", out))


def _hash(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def canonical_texts(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident, text`` (cleaned, to be read), ``form`` (equal for texts that look the same) and ``changed`` (is the text); whole texts,
    one row a row with an id."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            old = [t if isinstance(t, str) else None for t in pdf["_t"]]
            new = [cleaned(t) for t in old]
            yield pd.DataFrame({ident: pdf[ident], "text": new, "form": [canonical(t) for t in old], "changed": [a != b for a, b in zip(old, new, strict=True)]})

    return docs.select(F.col(ident).cast("bigint").alias(ident), F.col(text).alias("_t")).filter(F.col(ident).isNotNull()).mapInPandas(run, f"{ident} bigint, text string, form string, changed boolean")


def fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident, raw, form``: 128-bit hashes of each text and of its canonical form. Null texts have none and are left out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = [_hash(t) for t in pdf["_t"]]
            form = [_hash(c) if (c := canonical(t)) is not t else r for t, r in zip(pdf["_t"], raw, strict=True)]
            yield pd.DataFrame({ident: pdf[ident], "raw": raw, "form": form})

    return checkpointed(docs.select(F.col(ident).cast("bigint").alias(ident), F.col(text).alias("_t")).filter("_t is not null").filter(F.col(ident).isNotNull())
                        .mapInPandas(run, f"{ident} bigint, raw string, form string").dropDuplicates([ident]))


def look_alike_pairs(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id_a < doc_id_b``: all pairs whose texts differ in characters and have one canonical form.

    Documents are classes of equal texts first; forms with two or more different texts give pairs of classes, and only
    these meet their members. Copies of one text, however many, are never paired with each other, and a class of many
    copies is spread over salted tasks where it meets the classes it belongs with.
    """
    prints = fingerprints(docs, ident, text)
    # One pass tells the forms of several texts; few documents have one.
    mixed = prints.groupBy("form").agg(F.min("raw").alias("_a"), F.max("raw").alias("_b")).filter("_a <> _b").select("form")
    members = checkpointed(salted_join(prints, mixed, ["form"], F.col(ident), how="left_semi").select("form", "raw", ident))
    classes = members.select("form", "raw").distinct()
    pairs = salted_side(classes.withColumnRenamed("raw", "ra"), classes.withColumnRenamed("raw", "rb"), "form", "rb").filter("ra < rb")
    one = salted_side(pairs, members.select(F.col("raw").alias("ra"), F.col(ident).alias("a")), "ra", "a")
    both = salted_side(one, members.select(F.col("raw").alias("rb"), F.col(ident).alias("b")), "rb", "b")
    return both.select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b"))


def salted_side(pairs: DataFrame, members: DataFrame, key: str, ident: str, salts: int = 8) -> DataFrame:
    """Inner join of class pairs with class members, members of a large class spread over ``salts`` tasks."""
    spread = members.withColumn("_salt", F.pmod(F.xxhash64(ident), F.lit(salts)).cast("int"))
    copies = pairs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return copies.join(spread, [key, "_salt"]).drop("_salt")


def look_alike_classes(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id, texts``: the smallest id with the same form, and how many different texts share it."""
    prints = fingerprints(docs, ident, text)
    by = prints.groupBy("form", "raw").agg(F.min(ident).alias("least"))
    per = by.groupBy("form").agg(F.min("least").alias("class_id"), F.count("*").alias("texts"))
    return salted_join(prints, per, ["form"], F.col(ident), how="inner").select(ident, "class_id", "texts")
