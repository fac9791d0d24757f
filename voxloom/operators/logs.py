"""Problem 6: raw log lines into entries with time, level, component and message.

Lines are cut into typed tokens (times, levels, components, numbers, paths, words, marks). Distinct token sequences are clustered
by their longest common subsequence into templates of constant and variable slots, each group of them as a whole. Slots are
classified by type, and the templates decide: what joined templates have in front of their first free slot is a layout, each line
is assigned its template, and a line whose template begins with a layout, or has the slots of a warning or job mark, opens an
entry. Time, level and component are the values at the layout's typed slots.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import batched, groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.align import lcs_pairs
from voxloom.operators.scan import block_scan, salted_join
from voxloom.session import checkpointed

#: Lines of one log that a task scans at once.
BLOCK_LINES = 20_000
#: Two token sequences are one template if their common subsequence has this share of the longer one.
SIMILAR = 0.7
#: Distinct token sequences that a task takes up at once: it counts their tokens before it clusters them. No row depends on it.
PART_SEQUENCES = 20_000
#: Parts the tokens of a sequence; no token has it.
SEP = "\x1f"
#: Slots that make a head.
TYPED = ("<T>", "<L>", "<l>", "<G>", "<C>", "<P>")

# Names of log levels and the letters that stand for them.
LEVELS = {"TRACE": "TRACE", "DEBUG": "DEBUG", "INFO": "INFO", "NOTICE": "INFO", "WARN": "WARNING", "WARNING": "WARNING",
          "ERROR": "ERROR", "ERR": "ERROR", "SEVERE": "ERROR", "CRITICAL": "CRITICAL", "FATAL": "CRITICAL"}
LETTERS = {"T": "TRACE", "V": "DEBUG", "D": "DEBUG", "I": "INFO", "N": "INFO", "W": "WARNING", "E": "ERROR", "F": "CRITICAL", "C": "CRITICAL"}

_MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?"
_NAMES = "|".join(sorted(LEVELS, key=len, reverse=True))
_TOKEN = re.compile(
    rf"(?P<G>^[{''.join(LETTERS)}](?=\d{{4}} \d\d:))"                               # a letter before month and day: level
    rf"|(?P<T>\d{{4}}[-/.]\d\d?[-/.]\d\d?(?:[T ]+{_CLOCK}(?:Z|[+-]\d\d:?\d\d)?)?"
    rf"|{_MONTH} +\d{{1,2}} {_CLOCK}|(?<=^.)\d{{4}} {_CLOCK}|\b\d\d[-/]\d\d[-/]\d{{2,4}} {_CLOCK}"
    rf"|(?<![\w:.]){_CLOCK}(?![\w:])|(?<![\w.])\d{{10}}(?:\d{{3}}|\.\d+)?(?![\w.]))"
    rf"|(?P<L>(?<![\w.\-/])(?:(?i:{_NAMES}))(?![\w.\-/]))"
    r"|(?P<C>(?<![\w./])[A-Za-z_][\w\-]*(?:\.[A-Za-z_][\w\-]*)+(?::\d+)?(?![\w/])|[A-Za-z_][\w\-./]*\[\d+\])"
    r"|(?P<P>(?<![\w\])])(?:[A-Za-z]:)?[/\\][^\s:'\"]+(?:\:\d+)?|[\w.\-]+\.(?:py|cc|cpp|go|rs|java|js|c|h):\d+)"
    r"|(?P<N>[+-]?\d[\w.]*)|(?P<W>[^\W\d_][\w'\-]*)|(?P<M>\S)")
#: Marks that may close a level that stands alone.
_CLOSERS = (":", "]", "-", "|", ")", ">")


def tokens(line: str) -> list[tuple[str, int, int]]:
    """(type, start, end): T time, L level in capitals, l other level, G level letter, C component, P path, N number, I name
    with digits, K kind of warning, U status in brackets, W word, M mark; S in front of an indented line.
    """
    found = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(line)]
    out = [("S", 0, 0)] if line[:1].isspace() else []
    for i, (k, a, b) in enumerate(found):
        if k == "W":
            before = line[found[i - 1][1]] if i and found[i - 1][0] == "M" else ""
            after = line[found[i + 1][1]] if i + 1 < len(found) else ""
            if b - a == 1 and line[a] in LETTERS and before and before in "|[(<" and after and after in "|])>":
                k = "G"
            elif line.endswith("Warning", a, b):
                k = "K"
            elif not line[a:b].isalpha() and any(c.isdigit() for c in line[a:b]):
                k = "I"
            elif b - a > 1 and line[a:b].isupper() and (before == "[" or out and out[-1][0] == "U"):
                k = "U"
        elif k == "L" and not line[a:b].isupper():
            k = "l"
        out.append((k, a, b))
    return out


def masked(line: str) -> list[str]:
    """The token sequence that templates are made of: words and marks as they are, other tokens as <type>."""
    return [line[a:b] if k in "WM" else f"<{k}>" for k, a, b in tokens(line)]


def lcs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of one longest common subsequence."""
    start, n, m = 0, len(a), len(b)
    while start < min(n, m) and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < min(n, m) - start and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    x, y = a[start:n - tail], b[start:m - tail]
    if len(x) * len(y) > 10_000:
        # Reversed, as lcs_pairs traces from the end: of several longest subsequences it finds the one that the table below gives.
        back = lcs_pairs(x[::-1], y[::-1])[::-1]
        middle = [(n - tail - 1 - i, m - tail - 1 - j) for i, j in back]
        return [(k, k) for k in range(start)] + middle + [(n - tail + k, m - tail + k) for k in range(tail)]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(y) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
    pairs, i, j = [(k, k) for k in range(start)], 0, 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            pairs.append((start + i, start + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs + [(n - tail + k, m - tail + k) for k in range(tail)]


def join_templates(a: list[str], b: list[str], similar: float = SIMILAR) -> list[str] | None:
    """One template for both, with <*> for what differs, or None if they have too little in common.

    A template's constant words must carry it: slots alone make no likeness beyond the same slot types.
    """
    if a == b:
        return a
    if min(len(a), len(b)) < similar * max(len(a), len(b)):
        return None
    pairs = lcs(a, b)
    if len(pairs) < similar * max(len(a), len(b)):
        return None
    out, i, j = [], 0, 0
    for p, q in [*pairs, (len(a), len(b))]:
        if (p > i or q > j) and out[-1:] != ["<*>"]:
            out.append("<*>")
        if p < len(a):
            if not (a[p] == "<*>" and out[-1:] == ["<*>"]):
                out.append(a[p])
        i, j = p + 1, q + 1
    return out


_DIGITS = str.maketrans("123456789", "000000000")


class Shapes:
    """Results by a line's shape, the line with every digit as 0: no token's type depends on more than that."""

    def __init__(self, make, limit: int = 50_000):
        self.make, self.limit, self.known = make, limit, {}

    def of(self, line: str):
        shape = line.translate(_DIGITS)
        got = self.known.get(shape)
        if got is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            got = self.known[shape] = self.make(shape)
        return got


class Clusters:
    """Templates of token sequences, joined as the sequences come.

    A common subsequence of the asked length leaves out so many tokens of either side at most. So with all tokens in one order, a
    template and a sequence that it takes agree in one of their first tokens, one more than may be left out. An index of the
    templates' first tokens finds all candidates; tokens in common are counted before subsequences are made. The order is by
    rarity among the sequences told to :meth:`expect`, so that few templates share a first token: time depends on it, results don't.
    """

    def __init__(self, similar: float = SIMILAR):
        self.similar, self.rows, self.having = similar, [], {}
        self.seen, self.n_seen, self.rank, self.n_ranked = Counter(), 0, {}, 0

    def expect(self, seqs: list[list[str]]) -> None:
        """Count the tokens of sequences to be added; whenever their number has doubled, the order and the index are made anew."""
        for seq in seqs:
            self.seen.update(seq)
        self.n_seen += len(seqs)
        if self.n_seen >= 2 * self.n_ranked:
            self.rank, self.n_ranked, self.having = {**self.seen, "<*>": -1}, self.n_seen, {}
            for i, have in enumerate(self.rows):
                for t in self._first(have):
                    self.having.setdefault(t, []).append(i)

    def _first(self, seq: list[str]) -> set[str]:
        spare = len(seq) - math.ceil(self.similar * len(seq) - 1e-9)
        return set(sorted(seq, key=lambda t: (self.rank.get(t, 0), t))[:spare + 1])

    def add(self, seq: list[str]) -> int:
        """The number of the template that takes ``seq``, the first made of those that can."""
        bag, first = Counter(seq), self._first(seq)
        for i in sorted(set().union(*[self.having.get(t, ()) for t in first])):
            have = self.rows[i]
            need = self.similar * max(len(have), len(seq)) - 1e-9
            if min(len(have), len(seq)) >= need and _common(bag, have) >= need and (both := join_templates(have, seq, self.similar)) is not None:
                if both != have:
                    self.rows[i] = both
                    for t in self._first(both) - self._first(have):
                        self.having.setdefault(t, []).append(i)
                return i
        i = len(self.rows)
        self.rows.append(seq)
        for t in first:
            self.having.setdefault(t, []).append(i)
        return i


def _common(bag: Counter, seq: list[str]) -> int:
    """How many tokens both have, repeated ones as often as in both."""
    left, n = dict(bag), 0
    for t in seq:
        if left.get(t, 0):
            left[t] -= 1
            n += 1
    return n


def _clustered(batches: Iterator[pd.DataFrame], similar: float, piece: int) -> Iterator[pd.DataFrame]:
    """``kind, no, mask, n_lines`` of sequences that come kind by kind in the order they are clustered in, and after those of a kind
    its templates as ``kind, no, template``. Sequences are taken up ``piece`` at most at once; of a kind only the templates are held.
    """
    def told() -> Iterator[tuple]:
        for kind, rows in groupby((x for pdf in batches for x in zip(pdf["kind"], pdf["mask"], pdf["n_lines"], strict=True)), key=itemgetter(0)):
            book = Clusters(similar)
            for part in batched(rows, piece):
                seqs = [[sys.intern(t) for t in mask.split(SEP)] for _, mask, _ in part]
                book.expect(seqs)
                yield from ((kind, book.add(seq), mask, n, None) for seq, (_, mask, n) in zip(seqs, part, strict=True))
            yield from ((kind, no, None, 0, SEP.join(template)) for no, template in enumerate(book.rows))

    for rows in batched(told(), piece):
        yield pd.DataFrame(rows, columns=["kind", "no", "mask", "n_lines", "template"])


def zone(template: list[str]) -> int:
    """How many tokens of a template are its head: up to the last time, level or component in front of its first free slot.

    Free are variable slots and words that name no field. 0 if there is no head: nothing typed, an indented line, or more than marks and
    field names in front of the first time or level. A level without a time needs a mark behind it.
    """
    end, first, timed, upper = 0, None, False, False
    for i, t in enumerate(template):
        after = template[i + 1] if i + 1 < len(template) else ""
        if t in ("<S>", "<*>", "<K>", "<U>"):
            break
        if t in ("<T>", "<L>", "<l>", "<G>"):
            first = i if first is None else first
            timed, upper = timed or t == "<T>", upper or t in ("<L>", "<G>")
            end = i + 1
        elif t[0] == "<" and t[-1] == ">" and len(t) > 2:
            if first is None:
                return 0
            end = i + 1 if t == "<C>" or t == "<P>" else end
        elif t[0].isalpha() and not (after == "=" or after == '"' and template[i + 2:i + 3] == [":"] or after == ":" and i == 0):
            break
    if first is None:
        return 0
    if not timed:
        closed = template[first + 1:first + 2]
        if not (closed and (closed[0] in _CLOSERS or closed[0] == "<C>") and (upper or first)):
            return 0
    return end


def mark_kind(template: list[str]) -> str | None:
    """The kind of head that a template without time is by its marks: 'warning' (code location and kind of warning), 'banner',
    'tag' (a status or level in brackets), 'step' or 'progress' (a count of a total); None if it is none.
    """
    n, t = len(template), [*template, "", "", "", ""]
    if t[0] == "<P>" and "<K>" in t[1:4]:
        return "warning"
    run = next((i for i, x in enumerate(template) if x != template[0]), n)
    if run >= 3 and t[0] in ("=", "#", "*", "-", "~") and n > run and all(x == t[0] for x in template[-3:]):
        return "banner"
    if t[0] == "[" and t[1] in ("<U>", "<L>"):
        close = next((i for i in range(2, n) if template[i] != "<U>"), n)
        return "tag" if t[close] == "]" else None
    total = ["<N>", "/", "<N>"]
    if t[:5] == ["[", *total, "]"] and n > 5:
        return "step"
    lead = next((i for i, x in enumerate(template) if x not in (">", "=", "-", ":")), n)
    if lead >= 2 and (t[lead - 1] == ">" or template[:2] == [":", ":"]):
        at = lead + (t[lead] == "[")
        return "progress" if t[at:at + 3] == total or t[at:at + 3] == ["<N>", "of", "<N>"] else None
    return None


def _clean(lines: DataFrame) -> DataFrame:
    return (lines.select("line_id", "log_name", F.col("line_no").cast("bigint").alias("line_no"), F.coalesce("raw_line", F.lit("")).alias("raw_line"))
            .filter("log_name is not null and line_no is not null").dropDuplicates(["log_name", "line_no"]))


def tokenised(lines: DataFrame) -> DataFrame:
    """Lines with ``mask``, their token sequence ('' for blank lines), written once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = Shapes(lambda x: SEP.join(masked(x)) if x.strip() else "")
        for pdf in batches:
            yield pdf.assign(mask=[shapes.of(x) for x in pdf["raw_line"]])

    return checkpointed(_clean(lines).mapInPandas(run, "line_id bigint, log_name string, line_no bigint, raw_line string, mask string"))


def mined(masks: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``mask, n_lines, template``: the template that every distinct token sequence belongs to.

    Sequences are counted before they meet. Those whose first three tokens other than words agree, a kind, are compared, the most
    used first, all with all templates of the kind however many they are: a task reads a kind in this order and holds its templates.
    What a template is depends on the sequences and their counts alone, not on how the table is cut into tasks.
    """
    piece = PART_SEQUENCES
    seqs = masks.filter("mask <> ''").groupBy("mask").agg(F.count("*").alias("n_lines"))
    typed = F.filter(F.split("mask", SEP), lambda t: ~t.rlike(r"^[\p{L}]"))
    ordered = seqs.withColumn("kind", F.concat_ws(SEP, F.slice(typed, 1, 3))).repartition("kind").sortWithinPartitions("kind", F.desc("n_lines"), "mask")
    told = checkpointed(ordered.mapInPandas(lambda batches: _clustered(batches, similar, piece), "kind string, no bigint, mask string, n_lines bigint, template string"))
    made = told.filter("mask is null").select("kind", "no", "template")
    return told.filter("mask is not null").drop("template").join(made, ["kind", "no"]).select("mask", "n_lines", "template")


def layouts(members: DataFrame) -> DataFrame:
    """``template, n_lines, n_sequences, kind, head``: what each template of :func:`mined` is, and its head's tokens.

    A layout is what templates of several sequences have in front of their first free slot, if that holds a time or level
    (:func:`zone`): only where messages differ behind it is it known that a time belongs to the layout and not to the text. A template
    that begins like a layout is a 'record', the longest such layout its head. Marks of job scripts and warnings are told by the
    places and types of a template's slots (:func:`mark_kind`). Others have a null kind: their lines open no entry.
    """
    per = members.groupBy("template").agg(F.sum("n_lines").alias("n_lines"), F.count("*").alias("n_sequences"))

    def typed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            split = [x.split(SEP) for x in pdf["template"]]
            ends = [zone(t) for t in split]
            yield pdf.assign(mark=[mark_kind(t) for t in split], heads=[[SEP.join(t[:k]) for k in range(1, e + 1) if t[k - 1] in TYPED] for t, e in zip(split, ends, strict=True)],
                             free=["<*>" in t for t in split])

    told = checkpointed(per.mapInPandas(typed, "template string, n_lines bigint, n_sequences bigint, mark string, heads array<string>, free boolean"))
    known = told.filter("free and mark is null and size(heads) > 0").select(F.element_at("heads", -1).alias("head")).distinct()
    hit = (told.filter("mark is null").select("template", F.explode("heads").alias("head")).join(known, "head")
           .groupBy("template").agg(F.max_by("head", F.length("head")).alias("head")))
    return (told.join(hit, "template", "left").select("template", "n_lines", "n_sequences", F.coalesce("mark", F.when(F.col("head").isNotNull(), "record")).alias("kind"), "head"))


def templates(lines: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``template, n_lines, n_sequences, kind, head`` of all lines: constant tokens, typed slots <T>, <L>, ... and variable slots <*>."""
    spaced = lambda c: F.replace(F.col(c), F.lit(SEP), F.lit(" ")).alias(c)
    return layouts(mined(tokenised(lines), similar)).select(spaced("template"), "n_lines", "n_sequences", "kind", spaced("head"))


def fields(line: str, kind: str | None, head: str | None) -> tuple[str | None, str | None, str | None, str]:
    """Time, level, component and message of a line that opens an entry: the values at its layout's typed slots, and the rest."""
    found = tokens(line)
    text = lambda i: line[found[i][1]:found[i][2]]
    if kind == "warning":
        at = next(i for i, x in enumerate(found) if x[0] == "K")
        return None, "WARNING", text(0), line[found[at][2]:].lstrip(": ") or text(at)
    if kind != "record":
        level = next((LEVELS[text(i).upper()] for i in range(min(2, len(found))) if found[i][0] in "Ll"), None) if kind == "tag" else None
        return None, level, None, line.strip(" =#*~").strip()
    time, level, comp, end = None, None, None, 0
    for i, t in enumerate(head.split(SEP)):
        if t == "<T>" and time is None:
            time = text(i)
        elif t in ("<L>", "<l>") and level is None:
            level = LEVELS[text(i).upper()]
        elif t == "<G>" and level is None:
            level = LETTERS[text(i)]
        elif t in ("<C>", "<P>") and comp is None:
            comp = text(i)
        end = found[i][2]
    rest = line[end:]
    if m := re.search(r"\b(?:msg|message)\"?\s*[=:]\s*\"?(.*?)\"?\s*\}?\s*$", rest):
        return time, level, comp, m[1]
    return time, level, re.sub(r"(?:\[\d+\]|:\d+)$", "", comp) if comp else None, re.sub(r"^[\s\-|:\]\)>]+", "", rest)


def _assigned(lines: DataFrame, similar: float) -> DataFrame:
    """Lines with the number of their entry in the log (from 1; lines before the first head are left out), and each head's kind and layout."""
    told = tokenised(lines)
    members = mined(told, similar)
    heads = (members.join(layouts(members).filter("kind is not null").select("template", "kind", "head"), "template")
             .select(*_same_mask(), "kind", F.col("head").alias("layout")))
    # Only sequences of heads are joined back, by hashes; one sequence may be that of a third of all lines.
    marked = (salted_join(told.select("line_id", "log_name", "line_no", "raw_line", (F.col("mask") != "").alias("solid"), *_same_mask()), heads, ["_h", "_g"], F.col("line_id")).drop("_h", "_g")
              .withColumns({"head": F.col("kind").isNotNull(), "blk": F.floor(F.col("line_no") / BLOCK_LINES)}))
    return block_scan(marked, ["log_name"], "blk", [F.col("line_no")], sums={"entry": F.col("head").cast("bigint")}).filter("entry > 0")


def _same_mask() -> list[Column]:
    """96 bits that stand for a token sequence."""
    return [F.xxhash64("mask").alias("_h"), F.hash("mask").alias("_g")]


_BOUNDS = ("first_line_id", "last_line_id")


def entry_bounds(lines: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``first_line_id, last_line_id`` of every entry as :func:`entries` has them, from aggregates alone: no text is gathered."""
    return (_assigned(lines, similar).groupBy("log_name", "entry")
            .agg(F.min_by("line_id", "line_no").alias(_BOUNDS[0]), F.max_by("line_id", F.when(F.col("solid"), F.col("line_no"))).alias(_BOUNDS[1]))
            .select(*_BOUNDS))


def entries(lines: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Entries with ``log_name, first_line_id, last_line_id, n_lines, part_no, kind, time, level, component, message``.

    An entry is one row (``part_no`` 0). Only where its lines lie in several blocks of ``BLOCK_LINES`` line numbers does the
    message go on in further rows, ``part_no`` 1, 2, ..., so that no row and no task holds an endless entry.

    Lines before a log's first head belong to no entry. Blank lines at an entry's end are left out; blank lines inside
    stay in its message. Null lines count as blank. Lines without log_name or line_no are left out, and of lines that agree
    in both, one counts. Empty tables give no rows.
    """
    ordered, solid = _assigned(lines, similar), F.col("solid")
    bounds = ordered.groupBy("log_name", "entry").agg(
        F.min_by("line_id", "line_no").alias("first_line_id"), F.max_by("line_id", F.when(solid, F.col("line_no"))).alias("last_line_id"),
        F.max(F.when(solid, F.col("line_no"))).alias("last_no"), F.min("line_no").alias("first_no"), F.max("kind").alias("kind"), F.max("layout").alias("layout"))
    parts = ordered.groupBy("log_name", "entry", "blk").agg(F.sort_array(F.collect_list(F.struct("line_no", "raw_line"))).alias("lines"))
    text = F.transform(F.filter("lines", lambda x: x["line_no"] <= F.col("last_no")), lambda x: x["raw_line"])
    flat = (parts.join(bounds, ["log_name", "entry"]).withColumns({"text": text, "part_no": (F.col("blk") - F.floor(F.col("first_no") / BLOCK_LINES)).cast("int")}).filter(F.size("text") > 0)
            .select("log_name", "first_line_id", "last_line_id", (F.col("last_no") - F.col("first_no") + 1).alias("n_lines"), "part_no", "kind", "layout",
                    F.when(F.col("part_no") == 0, F.element_at("text", 1)).alias("head_line"),
                    F.when(F.col("part_no") == 0, F.array_join(F.slice("text", 2, F.greatest(F.size("text") - 1, F.lit(0))), "\n")).otherwise(F.array_join("text", "\n")).alias("more")))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(None, None, None, None) if x is None else fields(x, k, h) for x, k, h in zip(pdf["head_line"], pdf["kind"], pdf["layout"], strict=True)]
            yield pdf.assign(time=[g[0] for g in got], level=[g[1] for g in got], component=[g[2] for g in got],
                             message=[m if g[3] is None else g[3] + ("\n" + m if m else "") for g, m in zip(got, pdf["more"], strict=True)]).drop(columns=["head_line", "more", "layout"])

    return flat.mapInPandas(parse, "log_name string, first_line_id bigint, last_line_id bigint, n_lines bigint, part_no int, kind string, time string, level string, component string, message string")
