"""Problem 2: texts cut off by a field's limit or a broken transfer, and how often each source cuts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.speech import HESITATION, lead_label, plain, strip_marks
from voxloom.operators.scan import salted_join
from voxloom.session import checkpointed

#: A length is a spike if so many open texts have it, so many times what the lengths around it have.
LEAST_OPEN, TIMES_AROUND, AROUND, GUARD = 4, 6.0, 16, 3
#: Of the texts of a spike's length so many are open, and so many of the open ones differ from each other.
OPEN_SHARE, DISTINCT_SHARE = 0.3, 0.7
#: Other sources must have seen the last words so often to tell whether a text can end with them.
LEAST_SEEN = 5
#: Share of times that the last words end a sentence: below the first a text is cut, from the second on it is whole; the pace decides between.
NEVER_ENDS, OFTEN_ENDS = 0.004, 0.3
#: A text spoken slower than this share of its corpus' slow pace (first percentile of whole texts) has lost words.
SLOW, VERY_SLOW = 0.95, 0.75
LEAST_CHARS = 40
#: Other sources have seen a word so often that its neighbours are known.
WELL_KNOWN = 200
#: A source of whose texts so large a share is broken off for sure.
BREAKING = 0.002
#: A shorter remark that nobody else has made is taken to be whole.
LEAST_WORDS = 6

_CLOSED = r"""[.!?؟。！？]["'”’»)\]]*\s*$|[\])>}*♪]\s*$"""
_ELLIPSIS = r"(?:\.{3}|…)\s*$"
_BROKEN = re.compile(r"(?:�|\\(?:u[0-9a-fA-F]{0,4}|x[0-9a-fA-F]{0,2})?|&[a-z#0-9]{0,6})\s*$")
_WORD = re.compile(r"([^\W_]+(?:['’\-][^\W_]+)*)([^\w]*)")


def histograms(records: DataFrame) -> DataFrame:
    """``source, unit, len, n, open, distinct_open``: lengths in characters and bytes of each source's texts."""
    return (records.withColumn("x", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("len_c").alias("len")), F.struct(F.lit("bytes").alias("unit"), F.col("len_b").alias("len")))))
            .groupBy("source", "x.unit", "x.len").agg(F.count("*").alias("n"), F.sum(F.col("is_open").cast("bigint")).alias("open"),
                                                       F.approx_count_distinct(F.when(F.col("is_open"), F.xxhash64("text"))).alias("distinct_open")))


def spikes(hist: DataFrame) -> DataFrame:
    """``source, unit, len, n, open`` of lengths at which texts pile up without an end: the limits of a source.

    A source may have several limits, as when a setting changed, and the bytes or the characters may be limited.
    """
    w = Window.partitionBy("source", "unit").orderBy("len")
    near, core = w.rangeBetween(-AROUND, AROUND), w.rangeBetween(-GUARD, GUARD)
    around = (F.sum("open").over(near) - F.sum("open").over(core)) / (2.0 * (AROUND - GUARD))
    return (hist.withColumn("around", around).filter(
        (F.col("open") >= LEAST_OPEN) & (F.col("open") >= TIMES_AROUND * (F.col("around") + 0.25)) & (F.col("open") >= OPEN_SHARE * F.col("n"))
        & (F.col("distinct_open") >= DISTINCT_SHARE * F.col("open"))).select("source", "unit", "len", "n", "open"))


def _measured(df: DataFrame, ident: str, source: str, text: str, start: str | None, end: str | None) -> DataFrame:
    pace = F.lit(None).cast("double")
    if start and end:
        span = F.col(end).cast("double") - F.col(start).cast("double")
        pace = F.when((span > 0) & (F.length(text) >= LEAST_CHARS), F.length(text) / span)
    closed = F.col(text).rlike(_CLOSED) & ~F.col(text).rlike(_ELLIPSIS)
    return (df.select(F.col(ident).alias("id"), F.coalesce(F.col(source), F.lit("?")).alias("source"), F.col(text).alias("text"), pace.alias("pace"))
            .filter("id is not null").dropDuplicates(["id"])
            .withColumns({"len_c": F.length("text"), "len_b": F.octet_length("text"), "is_open": F.coalesce(~F.rtrim("text").rlike(_CLOSED) | F.col("text").rlike(_ELLIPSIS), F.lit(False)),
                          "closed": F.coalesce(closed, F.lit(False))}))


@lru_cache(maxsize=200_000)
def _norm(word: str) -> str:
    w = plain(word)
    return "0" if w.isdigit() else w


@lru_cache(maxsize=20_000)
def _ends(gap: str) -> bool:
    """Do the marks after a word end a sentence (an ellipsis doesn't)."""
    return bool(re.search(r"[.!?؟。！？]", gap)) and not re.search(r"\.{2,}|…", gap)


def ending(text: str) -> tuple[str, list[tuple[str, bool]]]:
    """How a text ends - 'end', 'trail', 'broken', 'comma', 'open' or 'none' (no words) - and its (word, ends a sentence) list.

    Written times, sound notes, a leading label and hesitations are taken off first; numbers count as one word.
    """
    if _BROKEN.search(text):
        how = "broken"
    else:
        how = ""
    bare = HESITATION.sub(" ", lead_label(strip_marks(text)[0])[1]).rstrip()
    words = [(_norm(w), gap != " " and _ends(gap)) for w, gap in _WORD.findall(bare)]
    if not words:
        return how or "none", words
    if how:
        return how, words
    tail = re.search(r"[^\w]*$", bare)[0]
    if re.search(r"\.{3}|…|[-–—]\s*$", tail):
        return "trail", words
    if words[-1][1]:
        return "end", words
    return ("comma" if re.search(r"[,;:(]\s*$", bare) else "open"), words


def grams(words: list[tuple[str, bool]], at: int) -> list[str]:
    """The last one to three words up to a place."""
    return [" ".join(w for w, _ in words[at - n + 1:at + 1]) for n in (1, 2, 3) if at - n + 1 >= 0]


def _read(records: DataFrame) -> DataFrame:
    """Texts read once: how each ends, its last words, and all its words with the places where sentences end."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            how, last, said, marks = [], [], [], []
            for t in pdf["text"]:
                h, words = ending(t)
                how.append(h)
                last.append(grams(words, len(words) - 1) if h in ("open", "broken", "comma") and words else [])
                said.append(" ".join(w for w, _ in words))
                marks.append("".join("01"[e] for _, e in words))
            yield pdf.drop(columns="text").assign(how=how, n_words=[len(m) for m in marks], last=last, said=said, marks=marks)

    return records.select("id", "source", "text", "pace", "len_c", "len_b", "spike", "closed").mapInPandas(
        run, "id bigint, source string, pace double, len_c int, len_b int, spike boolean, closed boolean, how string, n_words int, last array<string>, said string, marks string")


def _endings(read: DataFrame, asked: DataFrame) -> DataFrame:
    """``gram, source, n, ends``: how often the asked words stand in a source and how often they end a sentence or a whole text.

    The end of an open text counts as an end for the sake of remarks that are never closed; texts of spike lengths and
    broken ones don't. Counted in each task first, and what nobody asks for is left out there where Spark finds the asked words small
    enough to send round, so the shuffle carries distinct asked word groups.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = defaultdict(Counter)
        ended: dict[str, Counter] = defaultdict(Counter)

        def out():
            for source, book in seen.items():
                e = ended[source]
                yield pd.DataFrame({"gram": list(book), "source": source, "n": list(book.values()), "ends": [e[g] for g in book]})
            seen.clear()
            ended.clear()

        for pdf in batches:
            for source, spike, how, said, marks in zip(pdf["source"], pdf["spike"], pdf["how"], pdf["said"], pdf["marks"], strict=True):
                words, ends = said.split(" ") if said else [], [m == "1" for m in marks]
                if words and not ends[-1]:
                    if spike or how in ("broken", "trail", "comma"):
                        del words[-1], ends[-1]
                    else:
                        ends[-1] = True
                pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
                triples = [f"{a} {b}" for a, b in zip(pairs, words[2:])]
                for n, groups in enumerate((words, pairs, triples)):
                    seen[source].update(groups)
                    ended[source].update([g for g, e in zip(groups, ends[n:]) if e])
            if sum(map(len, seen.values())) > 300_000:
                yield from out()
        yield from out()

    counted = read.select("source", "spike", "how", "said", "marks").mapInPandas(run, "gram string, source string, n bigint, ends bigint")
    return counted.join(asked, "gram", "left_semi").groupBy("gram", "source").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


def truncated(df: DataFrame, ident: str = "gem_id", source: str = "route", text: str = "text", start: str | None = "start_s", end: str | None = "end_s") -> DataFrame:
    """``id, source, cut, reason, len_c, len_b`` of every record with a text.

    1. Length histograms per source, in characters and bytes, show the limits as spikes of open texts (see :func:`spikes`).
       A text of a spike's length that isn't closed is cut ('limit'), whether or not the source put an ellipsis there.
    2. Other texts that end in half a character or escape, in a comma, or in words after which texts of *other* sources
       hardly ever end, are cut ('broken', 'comma', 'words'); words nobody else has seen there are half words. Where the
       words leave it open, and the source is known to break texts off, the text's pace decides ('pace'): what was spoken
       for long but says little has lost its end.

    Ellipses and dashes away from the limits are speakers who trail off. Texts without words are never cut. Null and empty
    texts are whole, null sources count as one source '?', repeated ids count once, and empty tables give no rows.
    """
    base = checkpointed(_measured(df, ident, source, text, start, end))  # each record once; read four times below
    peaks = spikes(histograms(base.filter("text is not null and text <> ''")))
    limits = peaks.groupBy("source").agg(F.collect_set(F.when(F.col("unit") == "chars", F.col("len"))).alias("at_c"), F.collect_set(F.when(F.col("unit") == "bytes", F.col("len"))).alias("at_b"))
    at = F.coalesce(F.array_contains("at_c", F.col("len_c")) | F.exists("at_b", lambda b: (F.col("len_b") >= b - 2) & (F.col("len_b") <= b + 2)), F.lit(False))
    # One row a source with its few limits.
    recs = base.join(limits, "source", "left").withColumn("spike", at & F.col("is_open")).drop("at_c", "at_b")
    texts = recs.filter("text is not null and text <> ''")
    judged = checkpointed(_read(texts))
    slow = judged.filter("closed and pace is not null").agg(F.percentile_approx("pace", 0.01, 1000).alias("slow"))
    asked = judged.filter("how = 'open' and not spike").select("id", "source", F.posexplode("last").alias("k", "gram"))
    told = _endings(judged, checkpointed(asked.select("gram").distinct()))
    w = Window.partitionBy("gram")
    others = told.select("gram", "source", (F.sum("n").over(w) - F.col("n")).alias("n"), (F.sum("ends").over(w) - F.col("ends")).alias("ends")).filter(F.col("n") >= LEAST_SEEN)
    # A common last word may end a third of all texts.
    known = (salted_join(asked, others, ["gram", "source"], F.col("id"), how="inner").groupBy("id")
             .agg(F.max_by(F.struct(F.col("k"), (F.col("ends") / F.col("n")).alias("p")), "k").alias("best"), F.max(F.when(F.col("k") == 0, F.col("n"))).alias("n_last")))
    full = judged.drop("said", "marks").join(known, "id", "left").crossJoin(F.broadcast(slow))
    # How many of its last words (up to three) others know: fewer than the text has means that they never met together.
    p, depth = F.col("best.p"), F.coalesce(F.col("best.k") + 1, F.lit(0))
    whole = F.size("last") == depth
    sure = (F.when(F.col("how") == "none", F.lit(None)).when(F.col("spike"), "limit").when(F.col("how").isin("broken", "comma"), F.col("how"))
              .when(F.col("how") != "open", F.lit(None))
              .when(depth == 0, F.when(F.col("n_words") >= LEAST_WORDS, "words"))
              .when(p < NEVER_ENDS, "words")
              .when(~whole & (p < OFTEN_ENDS) & (F.col("n_words") >= LEAST_WORDS), "words")
              # A well-known last word that never followed the one before it anywhere else is the first half of another.
              .when((depth == 1) & ~whole & (F.col("n_last") >= WELL_KNOWN), "words"))
    first = full.withColumns({"sure": sure, "doubt": F.coalesce((F.col("how") == "open") & ((p < OFTEN_ENDS) & (F.col("pace") < SLOW * F.col("slow")) | (p >= OFTEN_ENDS) & (F.col("pace") < VERY_SLOW * F.col("slow"))), F.lit(False))})
    # The pace speaks only against sources that are known to break texts off.
    breaking = first.groupBy("source").agg((F.count_if(F.col("sure").isin("broken", "comma", "words")) / F.count("*")).alias("breaks"))
    reason = F.when(F.col("sure").isNotNull(), F.col("sure")).when(F.col("doubt") & (F.col("breaks") >= BREAKING), "pace")
    return first.join(breaking, "source").withColumn("reason", reason).select("id", "source", F.col("reason").isNotNull().alias("cut"), "reason", "len_c", "len_b")


def by_source(judged: DataFrame, totals: DataFrame, source: str = "route") -> DataFrame:
    """``route, records, cut, share`` and the cuts by reason, of every source with records."""
    all_ = totals.groupBy(F.coalesce(F.col(source), F.lit("?")).alias("source")).agg(F.count("*").alias("records"))
    cut = judged.filter("cut").groupBy("source").agg(F.count("*").alias("cut"), *[F.count(F.when(F.col("reason") == r, 1)).alias(f"by_{r}") for r in ("limit", "broken", "comma", "words", "pace")])
    return all_.join(cut, "source", "left").select(F.col("source").alias("route"), "records", F.coalesce("cut", F.lit(0)).alias("cut"),
                                                   F.round(F.coalesce("cut", F.lit(0)) / F.col("records"), 6).alias("share"),
                                                   *[F.coalesce(f"by_{r}", F.lit(0)).alias(f"by_{r}") for r in ("limit", "broken", "comma", "words", "pace")])
