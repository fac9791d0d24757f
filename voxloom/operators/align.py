"""Alignment of two token streams of one recording by longest common subsequence."""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import align_token, align_tokens, words


def _grams(x: np.ndarray, r: int) -> np.ndarray:
    """Hashes of the runs of ``r`` tokens that begin at each place; equal runs have equal ones."""
    size = max(0, len(x) - r + 1)
    h = np.zeros(size, dtype=np.uint64)
    for k in range(r):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x[k:k + size].astype(np.uint64) + np.uint64(1)
    return h


def _some_path(a: list, b: list, x: np.ndarray, y: np.ndarray, gram: int, cells: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Matched pairs of a good path, not always a best one: long runs that ``b`` has once, in order, and best paths between them; None where these are far apart."""
    h = _grams(y, gram)
    order = np.argsort(h)
    h = h[order]
    once = np.ones(len(h), dtype=bool)
    once[1:] &= h[1:] != h[:-1]
    once[:-1] &= h[1:] != h[:-1]
    h, order = h[once], order[once]
    asked = _grams(x, gram)[::max(1, gram // 3)]
    at = np.searchsorted(h, asked)
    hit = np.flatnonzero((at < len(h)) & (h[np.minimum(at, max(0, len(h) - 1))] == asked)) if len(h) else np.empty(0, dtype=np.int64)
    i, j = hit * max(1, gram // 3), order[at[hit]]
    tops: list = []
    ends: list = []
    before = np.full(len(i), -1)
    for k, v in enumerate(j.tolist()):  # longest rising subsequence
        t = bisect_left(tops, v)
        before[k] = ends[t - 1] if t else -1
        tops[t:t + 1], ends[t:t + 1] = [v], [k]
    keep = []
    k = ends[-1] if ends else -1
    while k >= 0:
        keep.append(k)
        k = before[k]
    i, j = i[keep[::-1]], j[keep[::-1]]
    # Anchors of one diagonal that overlap are one run.
    new = np.flatnonzero((np.diff(i, prepend=-gram - 1) > gram) | (np.diff(j - i, prepend=-len(x) - 1) != 0))
    last = np.append(new[1:], len(i))[:len(new)] - 1
    out_i, out_j, pi, pj = [], [], 0, 0
    for si, sj, ei in [*zip(i[new].tolist(), j[new].tolist(), (i[last] + gram).tolist()), (len(a), len(b), len(a))]:
        skip = max(0, pi - si, pj - sj)
        if skip > ei - si:
            continue
        si, sj = si + skip, sj + skip
        if si > pi and sj > pj:
            if (si - pi) * (sj - pj) > 20_000_000_000:
                return None
            pairs = np.array(lcs_pairs(a[pi:si], b[pj:sj], cells, 10**18), dtype=np.int64).reshape(-1, 2)
            out_i.append(pairs[:, 0] + pi)
            out_j.append(pairs[:, 1] + pj)
        out_i.append(np.arange(si, ei))
        out_j.append(np.arange(sj, sj + ei - si))
        pi, pj = ei, sj + ei - si
    i, j = np.concatenate([np.empty(0, dtype=np.int64), *out_i]), np.concatenate([np.empty(0, dtype=np.int64), *out_j])
    same = x[i] == y[j]
    return i[same], j[same]


def _corridor(a: list, b: list, cells: int, gram: int = 24, r: int = 7, chunks: int = 150):
    """First and last column that any best path can have in a row, as a function of rows; None where that isn't found to be narrow.

    The cost of a path is its number of unmatched tokens. Some path M is made first. Where a best path P leaves M and comes back to it, it
    costs no more there than M does. If on its way it is more than w columns off M, it costs at least 2 w less what M costs, so M costs
    more than w there. And it costs 1 at least for each of the chunks of ``r`` tokens of ``a`` that it doesn't match as a whole, and
    it can match only those that ``b`` has somewhere off M. In each block of chunks P either changes its diagonal by as many as the block has
    chunks, which costs that much, or stays in a window of diagonals twice as wide: the window with the most chunks found bounds the cost
    of the block from below. Stretches of blocks whose bounds sum up to more than M's cost have no P; w of a row is the most that M costs in others around it.
    """
    codes, _ = pd.factorize(np.array([*a, *b], dtype=object))
    x, y = codes[:len(a)].astype(np.int64), codes[len(a):].astype(np.int64)
    n, m = len(x), len(y)
    if (path := _some_path(a, b, x, y, gram, cells)) is None:
        return None
    i, j = path
    ends_i, ends_j = np.append(i, n), np.append(j, m)  # M matches the ends, too

    def columns(row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Columns at which M comes to a row and leaves it, and its matches before."""
        k = np.searchsorted(i, row)
        first = np.where(k > 0, j[np.maximum(k, 1) - 1] + 1, 0) if len(j) else np.zeros_like(k)
        return first, np.where(ends_i[k] == row, ends_j[k], first), k

    lowest, highest = len(i) - n, m - len(i)  # diagonals that paths as good as M can reach
    h = _grams(y, r)
    place = np.argsort(h, kind="stable")
    h = h[place]
    new = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, dtype=np.int64)
    known = h[new]
    at = np.cumsum(np.bincount(new, minlength=len(h))) * (m + 1) - (m + 1) + place if len(h) else place
    starts = np.arange(0, n - r + 1, r)
    starts = starts[:len(starts) // chunks * chunks]
    if not len(starts) or not len(known):
        return None
    asked = _grams(x, r)[starts]
    gram_no = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    there = known[gram_no] == asked
    blocks, windows = len(starts) // chunks, (highest - lowest) // chunks + 2
    least = np.zeros(blocks, dtype=np.int64)
    step = max(1, min(200, 4_000_000 // windows))
    for lo in range(0, blocks, step):
        hi = min(blocks, lo + step)
        s, g, ok = (v[lo * chunks:hi * chunks] for v in (starts, gram_no, there))
        x0 = np.searchsorted(at, g * (m + 1) + np.clip(s + lowest, 0, m))
        x1 = np.where(ok, np.searchsorted(at, g * (m + 1) + np.clip(s + highest, 0, m), side="right"), x0)
        count = x1 - x0
        chunk = np.repeat(np.arange(len(s)), count)
        found = place[np.arange(count.sum()) + np.repeat(x0 - np.cumsum(count) + count, count)]
        first, last, _ = columns(s)
        off = (found < first[chunk]) | (found > last[chunk])
        chunk, window = chunk[off], (found[off] - s[chunk[off]] - lowest) // chunks
        cell = chunk * windows + window
        once = np.append(True, cell[1:] != cell[:-1])[:len(cell)]
        hits = np.bincount(chunk[once] // chunks * windows + window[once], minlength=(hi - lo) * windows).reshape(hi - lo, windows)
        least[lo:hi] = np.maximum(0, chunks - (hits[:, 1:] + hits[:, :-1]).max(axis=1))
    # A block more, of no bound, for the rows left over. P goes off M in block s and comes back in block e.
    edge = np.append(np.arange(blocks + 1) * (chunks * r), n)
    first, last, k = columns(edge)
    low, high = edge + first - 2 * k, edge + last - 2 * k
    total = np.concatenate([[0], np.cumsum(np.append(least, 0))])
    back, away = total[:-1] - high[1:], total[1:] - low[:-1]
    ahead = np.minimum.accumulate(back[::-1])[::-1]
    e = np.maximum(np.searchsorted(ahead, away, side="right") - 1, np.arange(blocks + 1))
    most, w = high[e + 1] - low[:-1], np.zeros(blocks + 1, dtype=np.int64)
    for d in range(int((e - np.arange(blocks + 1)).max()) + 1):
        s = np.flatnonzero(e - np.arange(blocks + 1) >= d)
        w[s + d] = np.maximum(w[s + d], most[s])
    if w.mean() * 4 > highest - lowest:
        return None
    lefts = np.minimum.accumulate((first[:-1] - w)[::-1])[::-1].tolist()
    rights = np.maximum.accumulate(last[1:] + w).tolist()

    def reach(lo: int, hi: int) -> tuple[int, int]:
        return max(0, lefts[min(lo // (chunks * r), blocks)]), min(m, rights[min(hi // (chunks * r), blocks)])

    return reach


def lcs_pairs(a: list, b: list, cells: int = 40_000_000, large: int = 20_000_000_000) -> list[tuple[int, int]]:
    """Index pairs of the alignment that scores +10 a match, -5 a mismatch and -1 a gap, traced match, up, left.

    A mismatch never beats two gaps, so the pairs are those of a longest common subsequence. A row of the score table is kept
    as one integer of bits, 0 where the score rises along the row, and made from the row above by one addition; its carries are
    1 where the score rises down the column, which is all the trace asks. Bands of rows whose carries take four bytes for each
    of ``cells`` are held at once: the first row of each band is kept, and a band is made again when the trace comes to it.

    With a score of at least k, no best path leaves the diagonals that n - k steps down and m - k steps right can reach, so
    cells beyond them are left out: exact once the table so cut scores k. k is guessed first; a cut table's own score, which
    some path has, is a k that holds. That leaves a share of all cells; tables of over ``large`` cells are cut to a corridor that
    all best paths are shown to keep to (:func:`_corridor`), where there is one, so their time grows with the streams' lengths.
    """
    out: list[tuple[int, int]] = []
    # An equal tail is matched by the trace first, whatever precedes it.
    n, m = len(a), len(b)
    while n and m and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
        out.append((n, m))
    places: dict = {}
    for j in range(m):
        places.setdefault(b[j], []).append(j)

    def masks(left: int, right: int):
        """Bits of the columns from ``left`` to ``right`` that hold a token."""
        size = (right - left) // 8 + 1

        @lru_cache(maxsize=max(1, 4 * cells // size))
        def mask(token) -> int:
            at = places[token]
            at = at[bisect_left(at, left):bisect_left(at, right)]
            if len(at) * 64 > right - left:
                flags = np.zeros(right - left, dtype=bool)
                flags[np.array(at) - left] = True
                return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")
            bits = bytearray(size)
            for j in at:
                bits[(j - left) >> 3] |= 1 << ((j - left) & 7)
            return int.from_bytes(bits, "little")

        return mask

    def rows(above: int, lo: int, hi: int, left: int, right: int, carries: list | None = None) -> int:
        mask, full, size = masks(left, right), (1 << (right - left)) - 1, (right - left) // 8 + 1
        for i in range(lo, hi):
            if a[i] not in places:
                if carries is not None:
                    carries.append(None)
                continue
            both = above & mask(a[i])
            total = above + both
            if carries is not None:
                carries.append((total ^ above ^ both).to_bytes(size + 1, "little"))
            above = (total | (above ^ both)) & full
        return above

    def bands(k: int) -> tuple[int, list[tuple[int, int, int, int, int]]]:
        """The score of the table cut for ``k``, and its bands: rows from, to, columns from, to, first row."""
        step, kept, score = max(1, min(4_096, 32 * cells // (n + m - 2 * k + 4_096))) if reach is None else 2_048, [], 0
        above, left, right = 0, 0, 0
        for lo in range(0, n, step):
            hi = min(n, lo + step)
            # Columns that leave on the left take their part of the score along; those that come in on the right add none.
            new_left, new_right = (max(0, lo - (n - k)), min(m, hi + (m - k))) if reach is None else reach(lo, hi)
            gone = new_left - left
            score += gone - (above & ((1 << gone) - 1)).bit_count()
            above = (above >> gone) | (((1 << (new_right - right)) - 1) << (right - new_left))
            left, right = new_left, new_right
            kept.append((lo, hi, left, right, above))
            above = rows(above, lo, hi, left, right)
        return score + (right - left) - above.bit_count(), kept

    reach = _corridor(a[:n], b[:m], cells) if n * m > large else None
    k = min(n, m) * 19 // 20
    score, kept = bands(k)
    if score < k and reach is None:
        _, kept = bands(score)
    j = m
    for lo, i, left, right, first in reversed(kept):
        carries: list = []
        rows(first, lo, i, left, right, carries)
        while i > lo and j > 0:
            up = carries[i - lo - 1]
            if up is None:
                i -= 1
            elif a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                out.append((i, j))
            elif not up[(j - left) >> 3] >> ((j - left) & 7) & 1:
                i -= 1
            else:
                j -= 1
        if j == 0:
            break
    return out[::-1]


def token_pairs(first: DataFrame, second: DataFrame, key: str, order: str) -> DataFrame:
    """``key, a_id, a_pos, b_id, b_pos, raw``: aligned tokens of two texts' rows (key, id, order, text), row by row in order.

    Each side's tokens of a key are one stream. A key (one recording, one document) is one task: alignment is a whole-stream
    problem. Its table is banded, so memory grows with the streams' lengths only, not with their product.
    """
    def stream(df: DataFrame, raw: bool) -> DataFrame:
        # Fresh names on either side, as both may come from one table. A text's tokens move as one row.
        toks = (df.select(F.col(key).alias(key), F.col("id").alias("id"), F.col(order).alias("ord"), words(F.col("text")).alias("raw"))
                .withColumn("tok", F.transform("raw", align_token)).filter(F.exists("tok", lambda t: t != "")))
        return toks if raw else toks.drop("raw")

    def flat(pdf: pd.DataFrame) -> tuple[list, np.ndarray, np.ndarray]:
        """Tokens that aren't empty, with the row and the place in its text of each."""
        pdf = pdf.sort_values(["ord", "id"])
        at = [(i, p) for i, toks in enumerate(pdf["tok"]) for p, t in enumerate(toks) if t]
        row, pos = np.array(at, dtype=np.int64).reshape(-1, 2).T
        return [t for toks in pdf["tok"] for t in toks if t], pdf.index.to_numpy()[row], pos

    def align(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:  # an empty side comes without columns
            return pd.DataFrame(columns=[key, "a_id", "a_pos", "b_id", "b_pos", "raw", "at"])
        a, b = a.reset_index(drop=True), b.reset_index(drop=True)
        (x, a_row, a_pos), (y, b_row, b_pos) = flat(a), flat(b)
        i, j = np.array(lcs_pairs(x, y), dtype=np.int64).reshape(-1, 2).T
        said = b["raw"].to_numpy()
        return pd.DataFrame({key: a[key].to_numpy()[a_row[i]], "a_id": a["id"].to_numpy()[a_row[i]], "a_pos": a_pos[i], "b_id": b["id"].to_numpy()[b_row[j]], "b_pos": b_pos[j],
                             "raw": [said[r][p] for r, p in zip(b_row[j], b_pos[j], strict=True)], "at": np.arange(len(i))})

    kind = dict(first.dtypes)[key]
    return (stream(first, False).groupBy(key).cogroup(stream(second, True).groupBy(key))
            .applyInPandas(align, f"{key} {kind}, a_id bigint, a_pos int, b_id bigint, b_pos int, raw string, at bigint"))


def matched_text(first: DataFrame, second: DataFrame, key: str, order: str) -> DataFrame:
    """``id, gemini_transcript, _m``: for each row of ``first`` that has aligned tokens of ``second`` those as they were written, and their number.

    As :func:`token_pairs`, but tokens go to Python as one text a row and come back so: no row is made for a token.
    """
    named = lambda df: df.select(F.col(key).alias(key), F.col("id").alias("id"), F.col(order).alias("ord"), "text")
    said = named(first).withColumn("tok", F.array_join(align_tokens(F.col("text")), " ")).filter("tok <> ''").drop("text")
    # Tokens that are empty stay, so that both columns have as many words.
    heard = named(second).withColumn("_w", words(F.col("text"))).withColumns({"raw": F.array_join("_w", " "), "tok": F.array_join(F.transform("_w", align_token), " ")}).filter("trim(tok) <> ''").drop("text", "_w")

    def split(texts: pd.Series, seen: dict) -> list:
        """Words of all texts; equal ones are one object."""
        out: list = []
        for lo in range(0, len(texts), 10_000):
            out += [seen.setdefault(t, t) for t in " ".join(texts.iloc[lo:lo + 10_000]).split(" ")]
        return out

    def align(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:  # an empty side comes without columns
            return pd.DataFrame(columns=["id", "gemini_transcript", "_m"])
        a, b, seen = a.sort_values(["ord", "id"]), b.sort_values(["ord", "id"]), {}
        x, tok, raw = split(a["tok"], seen), split(b["tok"], seen), split(b["raw"], {})
        raw, tok = [r for r, t in zip(raw, tok, strict=True) if t], [t for t in tok if t]
        ends, ids = np.cumsum([t.count(" ") + 1 for t in a["tok"]]), a["id"].to_numpy()
        i, j = np.array(lcs_pairs(x, tok), dtype=np.int64).reshape(-1, 2).T
        row = np.searchsorted(ends, i, side="right")
        start = np.flatnonzero(np.diff(row, prepend=-1))
        stop, got = np.append(start[1:], len(row)), [raw[k] for k in j]
        return pd.DataFrame({"id": ids[row[start]], "gemini_transcript": [" ".join(got[s:e]) for s, e in zip(start, stop, strict=True)], "_m": stop - start})

    return said.groupBy(key).cogroup(heard.groupBy(key)).applyInPandas(align, "id bigint, gemini_transcript string, _m bigint")


def aligned_text(first: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``first`` with the aligned raw tokens (``gemini_transcript``) and ``alignment_score``, 10 x matched / tokens.

    Rows without a match get null for both.
    """
    return scored(first, pairs.groupBy(F.col("a_id").alias("id")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "raw"))), lambda x: x["raw"]), " ").alias("gemini_transcript"), F.count("*").alias("_m")))


def scored(first: DataFrame, got: DataFrame) -> DataFrame:
    """Rows of ``first`` with ``gemini_transcript`` and ``alignment_score`` from :func:`matched_text`."""
    n = F.size(align_tokens(F.col("text")))
    # least() passes over nulls, so a row without a match must be kept from it.
    score = F.when(F.col("_m").isNotNull(), F.round(F.least("_m", n) / F.greatest(F.col("_m"), n, F.lit(1)) * 10, 2))
    return first.join(got, "id", "left").withColumn("alignment_score", score).drop("_m")
