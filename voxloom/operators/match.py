"""One-to-one matching of text blocks by set F1, and the evaluation report."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import eval_tokens, word_errors


def f1(a: frozenset, b: frozenset) -> float:
    if not a or not b:
        return 0.0
    c = len(a & b)
    if not c:
        return 0.0
    p, r = c / len(b), c / len(a)
    return 2 * p * r / (p + r)


def numbered(truth: Iterable[str], preds: Iterable[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Arguments of :func:`greedy_pairs` from texts of tokens without repeats, a space between two."""
    sides = [list(truth), list(preds)]
    ends = [np.cumsum([0, *(x.count(" ") + 1 if x else 0 for x in side)], dtype=np.int64) for side in sides]
    tokens = " ".join(x for side in sides for x in side if x).split()
    codes, seen = pd.factorize(np.array(tokens, dtype=object))
    cut = ends[0][-1]
    return ends[0], codes[:cut], ends[1], codes[cut:], len(seen)


def _scores(common: np.ndarray, size: np.ndarray, own: int | np.ndarray) -> np.ndarray:
    """F1 of ``common`` tokens (above 0) between sets of ``size`` and ``own``."""
    p, r = common / size, common / own
    return 2 * p * r / (p + r)


def _held(t_at: np.ndarray, t_tok: np.ndarray, p_at: np.ndarray, p_tok: np.ndarray, tokens: int) -> list[tuple[int, float]]:
    """:func:`greedy_pairs` of few predictions: all scores are held."""
    n, m = len(t_at) - 1, len(p_at) - 1
    have = np.zeros((m, tokens), dtype=np.float32)
    have[np.repeat(np.arange(m), np.diff(p_at)), p_tok] = 1
    size, free, out = np.maximum(np.diff(p_at), 1), np.ones(m), []
    if not m:
        return [(-1, 0.0)] * n
    for lo in range(0, n, 1_024):
        hi = min(n, lo + 1_024)
        asked = np.zeros((hi - lo, tokens), dtype=np.float32)
        asked[np.repeat(np.arange(hi - lo), np.diff(t_at[lo:hi + 1])), t_tok[t_at[lo]:t_at[hi]]] = 1
        common = (asked @ have.T).astype(np.float64)
        p, r = common / size, common / np.maximum(np.diff(t_at[lo:hi + 1]), 1)[:, None]
        for row in np.divide(2 * p * r, p + r, out=common, where=common > 0):
            row *= free
            best = int(row.argmax())
            score = float(row[best])
            out.append((best, score) if score > 0 else (-1, 0.0))
            if score > 0:
                free[best] = 0
    return out


class _Bits:
    """Sets of tokens in order of size, as rows of bits a token; how many of some tokens each set has is summed on whole words of bits.

    A row of a token that few sets have is held as the words that aren't 0.
    """

    def __init__(self, sets: list[np.ndarray], tokens: int):
        sizes = np.array([len(s) for s in sets])
        self.order = np.argsort(sizes, kind="stable")
        # First place of each size; each size begins a word, so sizes are ranges of words.
        count = np.bincount(sizes)
        words = (count + 63) // 64
        self.first = np.concatenate([[0], np.cumsum(words)])
        self.width = int(self.first[-1])
        ordered = sizes[self.order]
        at = self.first[ordered] * 64 + np.arange(len(sets)) - np.concatenate([[0], np.cumsum(count)])[ordered]
        self.bit = np.empty_like(at)
        self.bit[self.order] = at
        self.owner = np.full(self.width * 64, -1)
        self.owner[at] = self.order
        self.alive = self._row(np.sort(at))
        tok, bit = np.concatenate(sets), np.repeat(self.bit, sizes)
        by = np.lexsort((bit, tok))
        ends = np.searchsorted(tok[by], np.arange(tokens + 1))
        self.rows: list = [None] * tokens
        for t in range(tokens):
            if ends[t] < ends[t + 1]:
                js = bit[by[ends[t]:ends[t + 1]]]
                self.rows[t] = self._row(js) if len(js) > self.width else self._few(js)

    def _few(self, js: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word = js >> 6
        start = np.flatnonzero(np.diff(word, prepend=-1))
        return word[start], np.bitwise_or.reduceat(np.uint64(1) << (js & 63).astype(np.uint64), start)

    def _row(self, js: np.ndarray) -> np.ndarray:
        row = np.zeros(self.width, dtype=np.uint64)
        at, value = self._few(js)
        row[at] = value
        return row

    def kill(self, s: int) -> None:
        at = int(self.bit[s])
        self.alive[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))

    def planes(self, tokens: np.ndarray, lo: int, hi: int) -> list[np.ndarray]:
        """Numbers of ``tokens`` in each set of the words from ``lo`` to ``hi``, a row of bits a binary digit."""
        level: list = []
        for t in tokens:
            row = self.rows[t]
            if isinstance(row, tuple):
                x, y = np.searchsorted(row[0], (lo, hi))
                if x == y:
                    continue
                full = np.zeros(hi - lo, dtype=np.uint64)
                full[row[0][x:y] - lo] = row[1][x:y]
                level.append(full)
            elif row is not None:
                level.append(row[lo:hi])
        out = []
        while level:
            carry = []
            while len(level) > 2:
                x, y, z = level.pop(), level.pop(), level.pop()
                u = x ^ y
                carry.append((x & y) | (u & z))
                level.append(u ^ z)
            if len(level) > 1:
                x, y = level
                carry.append(x & y)
                level = [x ^ y]
            out.append(level[0])
            level = carry
        return out

    def best(self, tokens: np.ndarray, smallest: int, largest: int, least: float) -> tuple[float, list[np.ndarray]]:
        """The highest F1 of ``tokens`` with a living set of a size from ``smallest`` to ``largest``, if at least ``least`` (above 0), and the sets that have it."""
        own, found = len(tokens), []
        lo, hi = int(self.first[smallest]), int(self.first[largest + 1])
        if lo == hi:
            return least, found
        planes = self.planes(tokens, lo, hi)
        for size in range(smallest, largest + 1):
            x, y = int(self.first[size]) - lo, int(self.first[size + 1]) - lo
            if x == y or _scores(min(own, size), size, own) < least:
                continue
            mask, common = self.alive[x + lo:y + lo], 0
            for k in range(len(planes) - 1, -1, -1):
                some = mask & planes[k][x:y]
                if some.any():
                    mask, common = some, common | 1 << k
            if not common:
                continue
            score = float(_scores(common, size, own))
            if score >= least:
                word = np.flatnonzero(mask)
                k, at = np.nonzero(np.unpackbits(mask[word, None].view(np.uint8), axis=1, bitorder="little"))
                found = [*(found if score == least else []), self.owner[(word[k] + x + lo) * 64 + at]]
                least = score
        return least, found


def greedy_pairs(t_at: np.ndarray, t_tok: np.ndarray, p_at: np.ndarray, p_tok: np.ndarray, tokens: int, held: int = 2_000) -> list[tuple[int, float]]:
    """For each truth in order the best unused prediction (ties: the first) and its F1; (-1, 0.0) without a common token.

    Sets are given as the numbers of their tokens, below ``tokens``, one set behind the other, and where each begins. A prediction is
    used up by any score above 0. Scores of up to ``held`` predictions are held. Of more, equal sets are one class, whose first
    unused member counts; classes are searched by size, those that could score highest first, and sizes that can't reach the best
    score so far are left out. No token's list of predictions is walked, so frequent tokens cost no more than others.
    """
    m = len(p_at) - 1
    if m <= held:
        return _held(t_at, t_tok, p_at, p_tok, tokens)
    classes: dict[bytes, list[int]] = {}
    for j in range(m - 1, -1, -1):  # so the first member stands last and is popped first
        if p_at[j] < p_at[j + 1]:
            classes.setdefault(np.sort(p_tok[p_at[j]:p_at[j + 1]]).tobytes(), []).append(j)
    keys, members = list(classes), list(classes.values())
    number, out = {k: c for c, k in enumerate(keys)}, []
    live, here, bits, less = len(members), np.arange(len(members)), None, 0.0
    heads = np.array([x[-1] for x in members])
    for i in range(len(t_at) - 1):
        own = np.sort(t_tok[t_at[i]:t_at[i + 1]])
        if not len(own) or not live:
            out.append((-1, 0.0))
            continue
        score, c = 1.0, number.get(own.tobytes(), -1)
        if c >= 0 and members[c]:
            score = float(_scores(len(own), len(own), len(own)))
        else:
            if bits is None or live * 2 < len(here):  # used classes leave
                here = np.flatnonzero([bool(x) for x in members])
                bits = _Bits([np.frombuffer(keys[c], dtype=p_tok.dtype) for c in here], tokens)
                local = {int(c): k for k, c in enumerate(here)}
            most, x = len(bits.first) - 2, len(own)
            # Begun where matches were of late: so many tokens less than the truth.
            a = min(most, max(1, x - round(less) - 1))
            b = min(most, a + 2)
            score, found = bits.best(own, a, b, 1e-300)
            # A smaller set can't have more in common than it holds, a larger one no more than the truth.
            below, above = a - 1, b + 1
            least_size = next((s for s in range(1, a) if _scores(s, s, x) >= score), a)
            if least_size <= below:
                more, sets = bits.best(own, least_size, below, score)
                score, found = more, (found + sets if more == score else sets) if sets else found
            largest = next((s for s in range(most, b, -1) if _scores(x, s, x) >= score), b)
            if above <= largest:
                more, sets = bits.best(own, above, largest, score)
                score, found = more, (found + sets if more == score else sets) if sets else found
            if not found:
                out.append((-1, 0.0))
                continue
            sets = here[np.concatenate(found)]
            c = int(sets[np.argmin(heads[sets])])
            less += (x - len(keys[c]) / own.itemsize - less) / 64
        out.append((members[c].pop(), score))
        if members[c]:
            heads[c] = members[c][-1]
        else:
            live -= 1
            if bits is not None:
                bits.kill(local[c])
    return out


def greedy_match(truth: DataFrame, preds: DataFrame, key: str, order: str = "turn") -> DataFrame:
    """``key, turn, pred, score``: greedy one-to-one matching in each document (key); ``pred`` is null where nothing matches.

    A document's turns are one task: the matching is sequential by definition. Only token sets go there.
    """
    kind = dict(truth.dtypes)[key]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty:  # an empty side comes without columns
            return pd.DataFrame(columns=[key, "turn", "pred", "score"])
        if b.empty:
            return pd.DataFrame({key: a[key], "turn": a[order], "pred": pd.array([None] * len(a), dtype="Int64"), "score": 0.0})
        a, b = a.sort_values(order), b.sort_values(order)
        got = greedy_pairs(*numbered(a["toks"], b["toks"]))
        at = b[order].to_numpy()
        return pd.DataFrame({key: a[key].to_numpy(), "turn": a[order].to_numpy(), "pred": pd.array([int(at[j]) if j >= 0 else None for j, _ in got], dtype="Int64"), "score": [s for _, s in got]})

    side = lambda df: df.select(F.col(key).alias(key), F.col(order).cast("bigint").alias(order), F.array_join(F.array_distinct(eval_tokens(F.col("text"))), " ").alias("toks"))
    return side(truth).groupBy(key).cogroup(side(preds).groupBy(key)).applyInPandas(run, f"{key} {kind}, turn bigint, pred bigint, score double")


def report(truth: DataFrame, candidates: dict[str, DataFrame], key: str, order: str = "turn", least: float = 0.6, compat: bool = False) -> DataFrame:
    """``key, turn, GT`` and per candidate ``Seg<X>`` (F1) and ``WER_<X>`` (null below ``least``); with ``compat`` a 0 is null too."""
    out = truth.select(key, F.col(order).cast("bigint").alias("turn"), F.col("speaker").alias("GT"), F.col("text").alias("_ref"))
    for name, preds in candidates.items():
        got = greedy_match(truth, preds, key, order)
        said = preds.select(key, F.col(order).cast("bigint").alias("pred"), F.col("text").alias("_hyp"))
        ref, hyp = eval_tokens(F.col("_ref")), eval_tokens(F.col("_hyp"))
        rate = F.when(F.col("score") >= least, F.when(F.size(ref) == 0, F.lit(0.0)).otherwise(word_errors(ref, hyp) / F.size(ref)))
        out = (out.join(got, [key, "turn"], "left").join(said, [key, "pred"], "left").withColumns({f"Seg{name}": F.round(F.coalesce("score", F.lit(0.0)), 4), f"WER_{name}": F.round(rate, 4)})
               .drop("pred", "score", "_hyp"))
        if compat:
            out = out.withColumn(f"WER_{name}", F.nullif(f"WER_{name}", F.lit(0.0)))
    return out.drop("_ref")
