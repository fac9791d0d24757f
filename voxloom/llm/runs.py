"""Problem 5: runs of identical or near-identical consecutive events into one event with count and duration."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.speech import ORDER, attributed, near, parse, with_text
from voxloom.operators.scan import block_lag, block_scan
from voxloom.session import checkpointed

#: Cost of a boundary between runs, in shares of letters that differ.
PENALTY = 1.0


def same(a: str, b: str) -> bool:
    """Two texts' letters are one event: equal, or one slip of typing apart, no digit differing."""
    return a == b or near(a, b) and [c for c in a if c.isdigit()] == [c for c in b if c.isdigit()]


def letters_apart(a: str, b: str, most: int) -> int:
    """Letters wrong, missing, added, or swapped with their neighbour; more than ``most`` counts as ``most`` + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = [most + 1] * (len(b) + 1)
        new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == b[j - 1]:
                new[j] = min(new[j], before[j - 2] + 1)
        if min(new[lo - 1:hi + 1]) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def dissimilarity(first: str, other: str, limit: float = 0.0) -> float:
    """Share of letters in which an event differs from its run's first one; infinite where it can't be in that run.

    One slip is always allowed, more up to ``limit`` as a share of the longer text's letters. Another number is another event.
    """
    if first == other:
        return 0.0
    size = max(len(first), len(other))
    if same(first, other):
        return 1.0 / (size + 1)
    most = int(limit * size)
    if most < 2 or [c for c in first if c.isdigit()] != [c for c in other if c.isdigit()]:
        return float("inf")
    apart = letters_apart(first, other, most)
    return apart / size if apart <= most else float("inf")


class Segmentation:
    """Optimal segmentation of a sequence as it comes: least sum of within-run dissimilarity and boundary penalties.

    The dissimilarity of a run is the sum over its events of what they differ from its first. ``cost[j]`` is the least cost of the
    events up to j. Starts of the run that j may belong to stay open while none of their events is infinitely unlike them; of two
    starts with one text the dearer is pruned, as all that follows costs both the same. Where no run can go over a place, what lies
    before is settled and leaves, so a sequence of any length holds no more than the events that runs may still bind. Of equal costs
    the later start is taken, which makes the earlier runs longer.
    """

    def __init__(self, penalty: float = PENALTY, limit: float = 0.0):
        self.penalty, self.limit, self.at = penalty, limit, 0
        self.open: dict[str, tuple[float, int]] = {}
        self.base, self.cost, self.start = 0, [0.0], []

    def add(self, text: str) -> list[tuple[int, int]]:
        """Take the next event; return the runs (first, last place) that it settles."""
        done = []
        kept = {}
        for t, (c, i) in self.open.items():
            if (d := dissimilarity(t, text, self.limit)) != float("inf"):
                kept[t] = (c + d, i)
        if not kept:
            done, self.base, self.cost, self.start = self.close(), self.at, [0.0], []
        fresh = self.cost[-1] + self.penalty
        if text not in kept or kept[text][0] > fresh + 1e-9:
            kept[text] = (fresh, self.at)
        self.open = kept
        least = min(c for c, _ in kept.values())
        self.cost.append(least)
        self.start.append(max(i for c, i in kept.values() if c <= least + 1e-9))
        self.at += 1
        return done

    def close(self) -> list[tuple[int, int]]:
        """The runs that are not settled yet."""
        out, j = [], self.at - 1
        while j >= self.base and self.start:
            i = self.start[j - self.base]
            out.append((i, j))
            j = i - 1
        return out[::-1]


def segment(texts: list[str], penalty: float = PENALTY, limit: float = 0.0) -> list[tuple[int, int]]:
    """The runs of a whole sequence as (first, last) places."""
    s = Segmentation(penalty, limit)
    return [r for t in texts for r in s.add(t)] + s.close()


def runs(gemini: DataFrame, texts: bool = True, penalty: float = PENALTY, limit: float = 0.0) -> DataFrame:
    """``lecture_id, speaker, first_gem_id, last_gem_id, n, start_s, end_s, duration_s, text`` of every run, single events too.

    Events are the same if their words are equal apart from case, accents, punctuation, spaces, written times, hesitations
    and sound notes, or one slip of typing apart. Events of sound notes alone are the same if the notes are; events of
    hesitations or nothing are the same. An event with a null text is a run of its own (``n`` 1) and parts its neighbours.
    Events without a known speaker count as one unknown speaker's. Equal neighbours are merged first, in the JVM and across
    blocks, so a long run reaches the segmentation as one event; only chains of neighbours that might be in one run are segmented.
    ``limit`` lets events into a run that differ in a share of letters (see :func:`dissimilarity`), where that costs less than
    a ``penalty`` a boundary; with 0 only slips are let in, and a penalty of 1 exceeds what any slip costs. ``text`` is the first event's (left out without ``texts``).
    """
    parsed = checkpointed(parse(gemini))
    form = (F.when(~F.col("has_text"), "x").when(F.col("speech"), "w").when(F.col("noted") & ~F.col("hesitant"), "n").otherwise("e"))
    events = attributed(parsed).withColumn("form", form).select(
        "lecture_id", ORDER, "blk", "speaker", "led", "start_s", "end_s", "form", "size", F.coalesce("speaker", F.lit("")).alias("who"),
        F.when(F.col("form") == "w", F.col("hash")).when(F.col("form") == "n", F.col("note_hash")).when(F.col("form") == "x", F.col(ORDER)).otherwise(F.lit(0)).alias("hash"))
    lagged = block_lag(events, ["lecture_id"], "blk", [F.col(ORDER)], {"_f": F.col("form"), "_h": F.col("hash"), "_s": F.col("size"), "_w": F.col("who")})
    alike = F.col("_w").eqNullSafe(F.col("who")) & F.col("_f").eqNullSafe(F.col("form"))
    differs = ~(alike & F.col("_h").eqNullSafe(F.col("hash")))
    # Two spoken events of one run are each a slip, or the limit's share of letters, from its first: so much their lengths may differ.
    apart = F.greatest(F.lit(2.0), F.lit(2.0 * limit) / (1 - min(limit, 0.9)) * F.greatest("size", "_s"))
    linked = alike & (F.col("form") == "w") & (F.abs(F.col("size") - F.col("_s")) <= apart)
    marked = block_scan(lagged, ["lecture_id"], "blk", [F.col(ORDER)], sums={
        "node": differs.cast("bigint"), "chain": (differs & ~linked).cast("bigint")})
    nodes = checkpointed(marked.groupBy("lecture_id", "chain", "node").agg(
        F.max("speaker").alias("speaker"), F.max("form").alias("form"), F.max("hash").alias("hash"), F.min_by("led", ORDER).alias("led"), F.min(ORDER).alias("first_gem_id"),
        F.max(ORDER).alias("last_gem_id"), F.count("*").alias("n"), F.min("start_s").alias("start_s"), F.max(F.coalesce("end_s", "start_s")).alias("end_s")))
    # Nodes of a chain are counted by aggregation, so that no window gathers a lecture's chains.
    sized = nodes.join(nodes.groupBy("lecture_id", "chain").agg(F.count("*").alias("m")), ["lecture_id", "chain"])
    cols = ["lecture_id", "speaker", "first_gem_id", "last_gem_id", "n", "start_s", "end_s", "led"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Chains come whole and in order within a task; one may go over the end of a batch."""
        held, book = deque(), Segmentation(penalty, limit)

        def told(settled: list[tuple[int, int]]) -> list:
            out = []
            for a, b in settled:
                part = [held.popleft() for _ in range(b - a + 1)]
                r = part[0]
                starts, ends = [x.start_s for x in part if x.start_s == x.start_s], [x.end_s for x in part if x.end_s == x.end_s]
                out.append((r.lecture_id, r.speaker, r.first_gem_id, part[-1].last_gem_id, sum(x.n for x in part), min(starts, default=None), max(ends, default=None), r.led))
            return out

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if held and (held[-1].chain, held[-1].lecture_id) != (r.chain, r.lecture_id):
                    out += told(book.close())
                    book = Segmentation(penalty, limit)
                out += told(book.add(r.text))
                held.append(r)
            yield pd.DataFrame(out, columns=cols)
        yield pd.DataFrame(told(book.close()), columns=cols)

    schema = "lecture_id string, speaker string, first_gem_id bigint, last_gem_id bigint, n bigint, start_s double, end_s double, led boolean"
    # Only spoken events form chains of several nodes; their words are fetched by their first records.
    many = (with_text(sized.filter("m > 1"), parsed, "first_gem_id", keys=True).select(*cols, "chain", "node", "text")
            .repartition("lecture_id", "chain").sortWithinPartitions("lecture_id", "chain", "node").mapInPandas(cut, schema))
    out = (sized.filter("m = 1").select(*cols).unionByName(many)
           .withColumn("duration_s", F.round(F.greatest(F.col("end_s") - F.col("start_s"), F.lit(0.0)), 3)))
    return with_text(out, parsed, "first_gem_id").drop("led") if texts else out.drop("led")
