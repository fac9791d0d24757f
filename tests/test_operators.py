import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from voxloom.operators import align, chunk, cluster, incremental, intervals, items, match, models, relational, search, windows
from voxloom.plans import pipeline

IV = "lecture_id string, id long, s long, e long"


def intervals_of(rng, n, ids=0):
    return [(rng.choice("ab"), ids + i, s := rng.randint(0, 200_000), s + rng.randint(-500, 9_000)) for i in range(n)]


def test_overlap_pairs_brute_force(spark):
    rng = random.Random(2)
    a, b = intervals_of(rng, 120) + [("a", 500, 0, 30_000_000), (None, 501, 0, 5)], intervals_of(rng, 120) + [("b", 700, 5, 20_000_000), ("a", 701, None, 5)]
    got = rows(intervals.overlap_pairs(spark.createDataFrame(a, IV), spark.createDataFrame(b, IV), bin_ms=4_000), "lecture_id", "a_id", "b_id", "ov")
    ok = lambda r: None not in r and r[3] > r[2]
    want = [(x[0], x[1], y[1], min(x[3], y[3]) - max(x[2], y[2])) for x in a if ok(x) for y in b if ok(y) and x[0] == y[0] and min(x[3], y[3]) > max(x[2], y[2])]
    assert got == sorted(want, key=repr)


def test_best_overlap_ties_and_minimum(spark):
    segs = spark.createDataFrame([("a", 1, 0, 2000), ("a", 2, 5000, 6000), ("a", 3, 9000, 9499), ("a", 4, 20000, 20500)], IV)
    turns = spark.createDataFrame([("a", 1, 0, 1000, "x"), ("a", 0, 1000, 2000, "y"), ("a", 2, 5000, 5000, "z"), ("a", 3, 9000, 9499, "w"), ("a", 4, 20000, 20500, "v")], "lecture_id string, seq long, s long, e long, speaker string")
    assert rows(intervals.best_overlap(segs, turns, "id")) == [(1, "y", 1000), (4, "v", 500)]


def test_named_speakers(spark):
    t = spark.createDataFrame([("a", 1, "s0"), ("a", 2, None), ("a", 3, "s9")], "lecture_id string, id long, raw string")
    m = spark.createDataFrame([("a", "s0", "Ann"), ("b", "s9", "Bob"), ("a", None, "No")], "lecture_id string, local_id string, speaker string")
    assert rows(intervals.named_speakers(t, m, "MAIN"), "id", "speaker") == [(1, "Ann"), (2, "MAIN"), (3, "MAIN")]


def test_window_generators(spark):
    d = spark.createDataFrame([(1, 109_000), (2, 108_999), (3, 0), (4, None), (5, 30_500), (6, 30_501)], "i int, d long")
    assert [r[1:] for r in rows(windows.tumbling(d, "d", 54_000, 1_000), "i", "s", "e") if r[0] == 1] == [(0, 54000), (108000, 109000), (54000, 108000)]
    assert len([r for r in rows(windows.tumbling(d, "d", 54_000, 1_000), "i", "s", "e") if r[0] == 2]) == 2
    slide = rows(windows.sliding(d, "d", 30_000, 15_000, 500), "i", "s", "e")
    assert [r[1:] for r in slide if r[0] == 5] == [(0, 30000), (15000, 30500)] and (6, 30000, 30501) in slide
    assert not [r for r in slide if r[0] in (3, 4)]


def test_label_and_features(spark):
    d = spark.createDataFrame([(0.01, 9000.0, 0.5), (0.02, 3001.0, 0.11), (0.5, 3000.0, 0.5), (0.5, 4000.0, 0.1)], "r double, c double, z double")
    assert [x[0] for x in d.select(windows.label_window(F.col("r"), F.col("c"), F.col("z"))).collect()] == ["SILENCE", "KIRTAN", "LECTURE", "LECTURE"]
    f = windows.window_features(spark.createDataFrame([(1, 3.0), (1, 4.0)], "k int, value double"), ["k"]).first()
    assert abs(f.rms - 12.5 ** 0.5) < 1e-12 and f.n == 2


def test_runs_and_gap_markers(spark):
    data = [("a", 1, 0, 5000, "x", "one"), ("a", 2, 6000, 20000, "x", "two"), ("a", 3, 7000, 9000, "x", "three"), ("a", 4, 117_000, 118_000, "y", "four"), ("a", 5, 225_999, 226_000, "x", "five"), ("a", 6, 700_000, 800_000, "x", "six")]
    df = spark.createDataFrame(data, "lecture_id string, seq long, s long, e long, speaker string, text string").withColumn("blk", F.floor(F.col("seq") / 2))
    runs = windows.merge_runs(df, ["lecture_id"], "seq", "blk")
    assert rows(runs, "run_no", "speaker", "s", "e", "text") == [(1, "x", 0, 9000, "one two three"), (2, "y", 117000, 118000, "four"), (3, "x", 225999, 800000, "five six")]
    out = rows(windows.with_gap_markers(runs, ["lecture_id"], 108_000, "[GAP]", "M", block_runs=2), "run_no", "part", "speaker", "s", "e", "text")
    assert [r for r in out if r[1] == 0] == [(2, 0, "M", 9000, 117000, "[GAP]")] and len(out) == 4


def test_null_speaker_run_starts(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, "x")], "k string, o long, v string").withColumn("blk", F.lit(0))
    assert rows(windows.island_numbers(df, ["k"], "o", "blk", F.col("v")), "o", "run_no") == [(1, 1), (2, 1), (3, 2)]


def test_headings(spark):
    df = spark.createDataFrame([("a", 1, "intro"), ("a", 2, "Speaker 1"), ("a", 3, "hello"), ("a", 4, "there"), ("a", 5, "Audience 2"), ("a", 6, "yes")], "k string, o long, text string").withColumn("blk", F.floor(F.col("o") / 3))
    from voxloom.functions.text import is_heading
    assert rows(windows.fill_headings(df, ["k"], "o", "blk", is_heading(F.col("text"), "Main")), "o", "speaker") == [(1, "Unknown"), (3, "Speaker 1"), (4, "Speaker 1"), (6, "Audience 2")]


def test_round_robin(spark):
    df = spark.createDataFrame([(i * i,) for i in range(57)], "i long").repartition(3)
    assert rows(windows.round_robin(df, ["i"], 4, blocks=7), "i", "position", "slot") == sorted([(i * i, i, i % 4) for i in range(57)], key=repr)


ITEM = "lecture_id string, pos long, type string, s long, e long, gemini_transcript string, alignment_score double"


def item_rows(spec, key="a"):
    kinds = {"W": items.SEGMENT, "B": items.BRIDGE, "G": items.GROUP}
    return [(key, i, kinds[c[0]], i * 1000, i * 1000 + 500, None if c.endswith("-") else f"{c}{i}", 10.0 if "p" in c else 5.0 if c[0] == "W" else None) for i, c in enumerate(spec, 1)]


def seq_push(rows_):
    """Sequential model: a bridge looks at the last kept row and the next one."""
    out, xs = [], [list(r) for r in rows_]
    for i, r in enumerate(xs):
        if r[2] == items.BRIDGE and out and out[-1][2] == items.SEGMENT and i + 1 < len(xs) and xs[i + 1][2] == items.SEGMENT:
            p, n, t = out[-1], xs[i + 1], r[5] or ""
            pp, np_ = (p[6] or 0) >= 9.99, (n[6] or 0) >= 9.99
            if pp != np_ and t:
                if pp:
                    n[5] = (t + " " + (n[5] or "")).strip()
                else:
                    p[5] = ((p[5] or "") + " " + t).strip()
                continue
        out.append(r)
    return out


def test_push_bridges_equals_the_sequential_model(spark):
    rng = random.Random(8)
    data = []
    for k in range(60):
        data.append(item_rows([rng.choice(["W", "Wp", "B", "B", "B-", "G"]) for _ in range(rng.randint(1, 9))], f"k{k}"))
    df = spark.createDataFrame([r for d in data for r in d], ITEM)
    got = rows(items.push_bridges(df), "lecture_id", "pos", "gemini_transcript")
    assert got == sorted([(r[0], r[1], r[5]) for d in data for r in seq_push(d)], key=repr)


def test_interpolation(spark):
    df = spark.createDataFrame(item_rows(["B", "W", "B", "B", "W", "B"]) + item_rows(["B"], "b"), ITEM)
    got = {(r.lecture_id, r.pos): (r.s, r.e) for r in items.interpolate_bridges(df).collect()}
    assert got["a", 3] == got["a", 4] == (2500, 5000)
    assert got["a", 1] == (1700, 2000) and got["a", 6] == (5500, 5800) and got["b", 1] == (1000, 1500)


def test_merge_items_order(spark):
    w = spark.createDataFrame([("a", 1, 0, 1000, " hi "), ("a", 2, 5000, 6000, None)], "lecture_id string, id long, s long, e long, text string")
    g = spark.createDataFrame([("a", 7, 0, 1000, "hey", "S"), ("a", 8, 2000, 3000, "b", None), ("a", 9, 1000, 1000, "z", "S")], "lecture_id string, id long, s long, e long, text string, speaker string")
    assert [(r.pos, r.type, r.id) for r in sorted(items.merge_items(w, g).collect(), key=lambda r: r.pos)] == [
        (1, items.SEGMENT, 1), (2, items.GROUP, 7), (3, items.BRIDGE, 9), (4, items.BRIDGE, 8), (5, items.SEGMENT, 2)]


def nw(a, b):
    n, m = len(a), len(b)
    s = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if i == 0 or j == 0:
                s[i][j] = -(i + j)
            else:
                s[i][j] = max(s[i - 1][j - 1] + (10 if a[i - 1] == b[j - 1] else -5), s[i - 1][j] - 1, s[i][j - 1] - 1)
    out, i, j = [], n, m
    while i and j:
        if s[i][j] == s[i - 1][j - 1] + (10 if a[i - 1] == b[j - 1] else -5):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif s[i][j] == s[i - 1][j] - 1:
            i -= 1
        else:
            j -= 1
    return out[::-1]


@pytest.mark.parametrize("cells", [40_000_000, 20])
def test_alignment_equals_scored_alignment(cells):
    rng = random.Random(cells)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in "ab")
        assert align.lcs_pairs(a, b, cells) == nw(a, b)


def test_long_recordings_are_aligned_as_a_whole(spark):
    rng, hour = random.Random(5), 3_600_000
    said = [[f"w{rng.randint(0, 40)}" for _ in range(12)] for _ in range(40)]
    # Segments of 15 minutes over ten hours; each group starts a minute before its segment, so some in the hour before.
    w = spark.createDataFrame([("a", i, i * hour // 4, (i + 1) * hour // 4 - 1, " ".join(x)) for i, x in enumerate(said)], "lecture_id string, id long, s long, e long, text string")
    g = spark.createDataFrame([("a", i, max(0, i * hour // 4 - 60_000), (i + 1) * hour // 4 - 1, " ".join(t for t in x if rng.random() < 0.9), "S") for i, x in enumerate(said)],
                              "lecture_id string, id long, s long, e long, text string, speaker string")
    merged = items.merge_items(w, g)
    flat = {k: [(r.id, t) for r in sorted(merged.filter(F.col("type") == k).collect(), key=lambda r: r.pos) for t in (r.whisper_transcript or r.gemini_transcript).split()] for k in (items.SEGMENT, items.GROUP)}
    first, second = flat[items.SEGMENT], flat[items.GROUP]
    want = {}
    for i, j in nw([t for _, t in first], [t for _, t in second]):
        want.setdefault(first[i][0], []).append(second[j][1])
    got = {r.id: r.gemini_transcript for r in pipeline.aligned_items(merged).collect()}
    assert len(got) == 40 and {k: v for k, v in got.items() if v} == {k: " ".join(v) for k, v in want.items()}


def _told(rng, phrases, n):
    """A text of ``n`` phrases, and the same with words put in, left out and changed, and stretches left out."""
    a = [w for _ in range(n) for w in rng.choice(phrases)]
    b, k = [], 0
    while k < len(a):
        x = rng.random()
        b += [a[k]] if x < 0.96 else ["um", a[k]] if x < 0.98 else ["other"] if x < 0.99 else []
        k += 60 if x > 0.999 else 1
    return a, b


def test_corridor_has_the_pairs_of_the_whole_table():
    for seed, distinct in ((1, 4_000), (2, 300), (3, 12)):  # many alike passages leave a wide corridor or none
        rng = random.Random(seed)
        a, b = _told(rng, [[f"w{rng.randint(0, 500)}" for _ in range(rng.randint(3, 9))] for _ in range(distinct)], 4_000)
        assert align.lcs_pairs(a, b, large=0) == align.lcs_pairs(a, b, large=10**18)
    for n in (0, 1, 40):
        assert align.lcs_pairs(a[:n], b[:3 * n], large=0) == align.lcs_pairs(a[:n], b[:3 * n], large=10**18)


def test_corridor_keeps_the_time_of_long_recordings_near_their_length():
    rng = random.Random(4)
    a, b = _told(rng, [[f"w{rng.randint(0, 900)}" for _ in range(rng.randint(3, 9))] for _ in range(9_000)], 200_000)
    began = time.process_time()
    i, j = zip(*align.lcs_pairs(a, b), strict=True)
    assert time.process_time() - began < 40 and len(i) > 0.9 * len(b)
    assert all(a[x] == b[y] for x, y in zip(i, j, strict=True)) and all(p < q for p, q in zip(j, j[1:]))


def test_matched_text_equals_token_pairs(spark):
    w = spark.createDataFrame([("a", 1, 1, "One, two -- three"), ("a", 2, 2, "--"), ("a", 3, 3, None), ("a", 4, 4, "four five"), ("b", 5, 1, "alone")], "lecture_id string, id long, pos long, text string")
    g = spark.createDataFrame([("a", 9, 1, "ONE \u2013 three!"), ("a", 8, 2, "- five -"), ("c", 7, 1, "x")], "lecture_id string, id long, pos long, text string")
    want = rows(align.aligned_text(w, align.token_pairs(w, g, "lecture_id", "pos")))
    assert rows(align.scored(w, align.matched_text(w, g, "lecture_id", "pos"))) == want and ("ONE three!" in repr(want))


def test_aligned_text_and_score(spark):
    s = "lecture_id string, id long, pos long, text string"
    w = spark.createDataFrame([("a", 1, 1, "the cat sat"), ("a", 2, 2, "on mats"), ("a", 3, 3, "..."), ("b", 4, 1, "alone")], s)
    g = spark.createDataFrame([("a", 9, 1, "The CAT, sat on"), ("a", 8, 2, "big mats!")], s)
    got = rows(align.aligned_text(w, align.token_pairs(w, g, "lecture_id", "pos")), "id", "gemini_transcript", "alignment_score")
    assert got == [(1, "The CAT, sat", 10.0), (2, "on mats!", 10.0), (3, None, None), (4, None, None)]


def test_chunks_and_times(spark):
    df = spark.createDataFrame([(1, "Aa bb. Cc dd. Ee.", 0, 1600), (2, "", 0, 5), (3, None, 0, 5), (4, "short", 10, 20)], "i int, text string, s long, e long")
    c = chunk.chunked(df, "text", 14)
    assert rows(c, "i", "chunk_no", "chunk") == [(1, 0, "Aa bb. Cc dd."), (1, 1, "Ee."), (4, 0, "short")]
    assert rows(chunk.prorated(c, ["i"]), "i", "chunk_no", "from_s", "to_s") == [(1, 0, 0.0, 1300.0), (1, 1, 1300.0, 1600.0), (4, 0, 10.0, 20.0)]
    f = chunk.chunk_counts(df.filter("text is not null"), "text", 14)
    assert {r.i: r.chunks for r in f.collect()} == {1: ["Aa bb. Cc dd.", "Ee."], 2: [], 4: ["short"]}


def plain_linkage(x, t):
    d = 1 - (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
    groups = [[i] for i in range(len(x))]
    while len(groups) > 1:
        best = min((d[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if best[0] >= t:
            break
        groups[best[1]] += groups.pop(best[2])
    first = sorted(groups, key=min)
    out = np.zeros(len(x), dtype=int)
    for k, g in enumerate(first):
        out[g] = k
    return out


def test_average_linkage_brute_force():
    rng = np.random.default_rng(4)
    for n in (2, 3, 9, 25):
        for t in (0.1, 0.4, 0.8):
            x = rng.normal(size=(n, 3))
            assert (cluster.average_linkage(x, t) == plain_linkage(x, t)).all()
    assert list(cluster.average_linkage(np.ones((4, 2)), 0.3)) == [0, 0, 0, 0] and list(cluster.average_linkage(np.ones((1, 2)), 0.3)) == [0]


def test_clusters_are_exact_above_the_held_distances(spark):
    x = np.random.default_rng(6).normal(size=(60, 4))
    for t in (0.2, 0.5, 0.9):
        want = plain_linkage(x, t)
        for held in (1, 7, 30):
            assert (cluster.average_linkage(x, t, held) == want).all()
    df = spark.createDataFrame([("a", i, [float(v) for v in e]) for i, e in enumerate(x)], "lecture_id string, seg_id long, emb array<double>")
    assert [r.cluster for r in sorted(cluster.local_clusters(df, 0.5, most=7).collect(), key=lambda r: r.seg_id)] == list(plain_linkage(x, 0.5))
    centres = df.select("lecture_id", F.col("seg_id").alias("cluster"), F.lit(1).cast("long").alias("size"), F.col("emb").alias("centroid"))
    assert [r["global"] for r in sorted(cluster.global_clusters(centres, 0.5, most=7).collect(), key=lambda r: r.cluster)] == list(plain_linkage(x, 0.5))


def test_clusters_and_names(spark):
    rng = np.random.default_rng(1)
    base = {"p": np.array([1.0, 0, 0]), "q": np.array([0, 1.0, 0]), "r": np.array([0, 0, 1.0])}
    data = [(k, i, [float(v) for v in base[s] + rng.normal(scale=0.02, size=3)]) for k, who in (("a", "ppqqp"), ("b", "prr"), ("c", "p")) for i, s in enumerate(who)]
    data += [("a", 90, [float("nan"), 0.0, 0.0]), ("a", 91, []), ("a", 92, None)]
    df = spark.createDataFrame(data, "lecture_id string, seg_id long, emb array<double>")
    for most in (4000, 2):
        local = cluster.local_clusters(df, 0.3, most=most)
        by = {}
        for r in local.collect():
            by.setdefault((r.lecture_id, r.cluster), set()).add(r.seg_id)
        assert sorted(map(sorted, by.values())) == [[0], [0], [0, 1, 4], [1, 2], [2, 3]]
    c = cluster.centroids(cluster.local_clusters(df, 0.3).join(df, ["lecture_id", "seg_id"]), ["lecture_id", "cluster"])
    for most in (8000, 3):
        names = rows(cluster.speaker_names(cluster.global_clusters(c, 0.35, most=most), "M"), "lecture_id", "local_id", "speaker")
        assert [n[:2] for n in names if n[2] == "M"] == [("a", "0"), ("b", "0"), ("c", "0")] and len({n[2] for n in names}) == 3
    one = cluster.global_clusters(c.limit(1), 0.35).collect()
    assert one[0]["global"] == 0
    assert cluster.speaker_map(spark.createDataFrame([("a", "0", "M")], "lecture_id string, local_id string, speaker string")).first().speakers == {"0": "M"}


def test_greedy_pairs_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        words = [f"t{i}" for i in range(rng.choice([4, 12, 50]))]
        truth, preds = ([sorted(set(rng.choices(words, k=rng.randint(0, 9)))) for _ in range(rng.randint(0, 90))] for _ in range(2))
        free, want = list(range(len(preds))), []
        for t in truth:
            scores = [match.f1(frozenset(t), frozenset(preds[j])) for j in free]
            best = max(range(len(free)), key=lambda k: (scores[k], -free[k]), default=None)
            want.append((-1, 0.0) if best is None or not scores[best] else (free.pop(best), scores[best]))
        for held in (0, 2_000):
            assert match.greedy_pairs(*match.numbered(map(" ".join, truth), map(" ".join, preds)), held=held) == want


def test_greedy_pairs_of_many_alike_texts():
    # Walking the lists of the words' predictions takes the square of their number.
    preds = [" ".join(f"w{k}" for k in range(i % 3, 14)) for i in range(40_000)]
    began = time.process_time()
    got = match.greedy_pairs(*match.numbered(preds[::-1], preds))
    assert time.process_time() - began < 10
    assert [j for j, _ in got[:4]] == [0, 2, 1, 3] and {j for j, _ in got} == set(range(40_000)) and all(s == 1 for _, s in got)


def test_greedy_match(spark):
    s = "doc string, turn long, speaker string, text string"
    t = spark.createDataFrame([("d", 0, "A", "a b c d"), ("d", 1, "B", "a b"), ("d", 2, "C", "zz"), ("e", 0, "A", "a")], s)
    p = spark.createDataFrame([("d", 10, "x", "a b x y z w"), ("d", 11, "x", "a b c d"), ("d", 12, "x", "a b c d")], s)
    assert rows(match.greedy_match(t, p, "doc"), "doc", "turn", "pred") == [("d", 0, 11), ("d", 1, 12), ("d", 2, None), ("e", 0, None)]
    r = {x.turn: x for x in match.report(t.filter("doc = 'd'"), {"A": p}, "doc").collect()}
    assert (r[0].SegA, r[0].WER_A) == (1.0, 0.0) and r[1].WER_A == 1.0 and r[2].WER_A is None and r[2].SegA == 0.0
    assert {x.turn: x.WER_A for x in match.report(t.filter("doc = 'd'"), {"A": p}, "doc", compat=True).collect()}[0] is None


def test_report_of_a_long_recording_equals_matching_by_hand(spark):
    # Above the size at which all scores are held.
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 60)}" for _ in range(rng.randint(0, 12))) for _ in range(2_100)]
    t = spark.createDataFrame([("d", i, "S", x) for i, x in enumerate(texts)], "doc string, turn long, speaker string, text string")
    p = t.select("doc", "turn", F.array_join(F.slice(F.split("text", " "), 2, 20), " ").alias("text"))
    free, want = {i: frozenset(x.split()[1:]) for i, x in enumerate(texts)}, []
    for x in texts:
        mine = frozenset(x.split())
        best = max(free, key=lambda j: (match.f1(mine, free[j]), -j))
        score = match.f1(mine, free[best])
        want.append(round(score, 4))
        if score:
            del free[best]
    got = match.report(t, {"A": p}, "doc").orderBy("turn").collect()
    assert len(got) == len(want) and all(abs(r.SegA - w) < 1e-4 for r, w in zip(got, want, strict=True))


def test_incremental(spark):
    ids = spark.createDataFrame([(x,) for x in "abcdef"], "k string")
    out = spark.createDataFrame([("a", "[1]"), ("b", "[]"), ("c", "[1"), ("d", None), ("e", '{"a": 1}')], "k string, doc string")
    assert rows(incremental.pending_valid(ids, out, "k")) == [("b",), ("c",), ("d",), ("e",), ("f",)]
    assert rows(incremental.pending(ids, out, "k")) == [("f",)]
    assert rows(incremental.first_with(ids, out, "k", 2)) == [("a",), ("b",)]
    assert rows(incremental.ready(ids, out.select("k"))) == [(x,) for x in "abcde"]


def test_models(spark):
    waits = []
    calls = iter([RuntimeError("429 slow down"), models.CallTimeout("x"), 7])

    def call():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    policy = models.Retry(base_s=1)
    assert models.with_retry(call, policy, sleep=waits.append) == 7 and waits == [1, 2]

    class Busy(Exception):
        code = 429

    def fail(e):
        def call():
            raise e
        return call

    two = models.Retry(attempts=2, base_s=1)
    for error, seen in ((ValueError("bad"), ValueError), (Busy(), models.Exhausted), (models.CallTimeout(), models.Exhausted)):
        waits.clear()
        with pytest.raises(seen):
            models.with_retry(fail(error), two, sleep=waits.append)
        assert waits == [1]
    import time
    with pytest.raises(models.CallTimeout):
        models.with_timeout(lambda: time.sleep(2), 0.05)

    def factory():
        def model(row):
            if row["x"] == 2:
                raise ValueError("no")
            return [{"y": row["x"] * 10.0}] * row["x"]
        return model

    got = rows(models.apply_model(spark.createDataFrame([(1,), (2,), (3,)], "x long"), factory, "y double", ["x"]))
    assert got == [(1, 10.0, None), (2, None, "ValueError: no"), (3, 30.0, None), (3, 30.0, None), (3, 30.0, None)] or got[1][2] == "ValueError: no"


def test_relational_and_search(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert rows(relational.top_per_key(df, ["k"], [F.desc("v")])) == [("a", 2), ("b", 3)]
    assert rows(relational.difference(df.select("k"), df.select("k").distinct())) == [("a",)]
    assert len(rows(relational.cube(df, ["k"], F.count("*")))) == 3 and len(rows(relational.rollup(df, ["k"], F.count("*")))) == 3
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, None)], "vec_id long, embedding array<double>")
    assert [(r.query, r.neighbour) for r in search.nearest_vectors(v, v.filter("vec_id = 1")).collect()] == [(1, 2)]
    assert [r.neighbour for r in search.nearest_vectors(v, v.filter("vec_id = 1"), k=2).orderBy("distance").collect()] == [2, 3]


def test_long_and_endless_intervals_meet_exactly(spark):
    import random

    random.seed(3)

    def made(n):
        out = []
        for i in range(n):
            s, length = random.randrange(0, 20_000_000), random.choice([0, 500, 5000, 40_000, 3_600_000, 9_000_000, 10**13 if i % 40 == 0 else 100])
            out.append((random.choice(["k", "k", "k", "m", None]), i, s, s + length))
        return out

    A, B = made(300), made(300)
    a = spark.createDataFrame(A,"lecture_id string, id long, s long, e long")
    b = spark.createDataFrame(B,"lecture_id string, id long, s long, e long")
    got = sorted((r.a_id, r.b_id, r.ov) for r in intervals.overlap_pairs(a, b).collect())
    want = sorted((x[1], y[1], min(x[3], y[3]) - max(x[2], y[2])) for x in A for y in B if x[0] and x[0] == y[0] and x[3] > x[2] and y[3] > y[2] and min(x[3], y[3]) > max(x[2], y[2]))
    assert got == want and len(want) > 1000
    assert sorted(r.id for r in intervals.overlapping(a, b, "id").collect()) == sorted({w[0] for w in want})
    same = intervals.overlap_pairs(a, a).filter("a_id = b_id").count()
    assert same == sum(1 for x in A if x[0] and x[3] > x[2])
