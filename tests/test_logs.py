from tests.helpers import clashing, rows
from voxloom.operators import logs

LINES = [
    "stray line before any head", "=== STEP 1: List ===", "2027-05-25 09:02:20 - merge.items - INFO - batch of 75 rows flushed", "", "    | 2027-05-25 09:02:20 - x.y - INFO - quoted",
    "I0525 09:02:28.506991  1184 merge_items.cc:105] no overlap for segment 45", "Traceback (most recent call last):", '  File "/srv/a.py", line 3, in run', "KeyError: 'A'", "", "",
    "2029/07/31 13:14:17,528 INFO    (vad.energy) chunk 32 sent", "Jul 31 13:13:43 box3 asrd[179]: <info> wrote 43 segments", "/opt/p2/init.py:22: UserWarning: ", "", "more text:", "  warnings.warn(x)",
    "time=2029-08-07T16:12:17Z level=warning comp=asr.align msg=\"timeout after 38s\"", "ERROR:dia.worker:weights accepted", "ValueError: no head", "[SKIP] lec00_1", "[1/7] Write blocks...",
    ">>> [51/94] lec00_2", '{"ts": "2028-01-07T12:34:25Z", "lvl": "info", "logger": "asr.loader", "msg": "found a time: 00:10:10"}', "{", '  "file": "t"', "}", "1891778213944 | E | fuzz.tokens | header repaired",
    "[2028-11-30T02:18:37.889Z] [INFO] [gemini.client] weights of 19", "half-speed mode chosen", "", "undo it", None, "   ",
]

# A second message of every layout: a layout is known by what differs behind it.
MORE = [
    "2027-05-25 09:12:20 - merge.items - INFO - batch of 5 cells flushed", "W0525 09:02:28.506992  1185 merge_items.cc:7] no gap for segment 45", "2029/07/31 13:14:17,529 DEBUG   (vad.energy) chunk 33 lost",
    "Jul 31 13:13:44 box3 asrd[180]: <error> read 43 segments", 'time=2029-08-07T16:12:17Z level=info comp=asr.load msg="stopped after 3s"', "WARNING:dia.worker:weights refused",
    '{"ts": "2028-01-07T12:34:26Z", "lvl": "info", "logger": "asr.loader", "msg": "lost a time: 00:10:11"}', "1891778213945 | W | fuzz.tokens | body repaired", "[2028-11-30T02:18:37.890Z] [WARNING] [gemini.client] biases of 19",
]


def frame(spark, names=("a.txt",)):
    data = [(100 * k + i, n, i, t) for k, n in enumerate(names) for i, t in enumerate(LINES, 1)]
    return spark.createDataFrame(data + data[:9] + [(900 + i, "z.txt", i, t) for i, t in enumerate(MORE)], "line_id long, log_name string, line_no int, raw_line string")


def bounds():
    heads = [i for i, t in enumerate(LINES, 1) if t and (t.startswith(("===", "2027", "I0525", "2029/", "Jul", "/opt", "time=", "ERROR:", "[", ">>>", '{"ts', "18917")))]
    out = []
    for a, b in zip(heads, [*heads[1:], len(LINES) + 1]):
        out.append((a, max(i for i in range(a, b) if (LINES[i - 1] or "").strip())))
    return out


def test_bounds(spark):
    got = rows(logs.entry_bounds(clashing(frame(spark, ("a.txt", "b.txt")))), "first_line_id", "last_line_id")
    assert got == sorted([p for p in bounds()] + [(a + 100, b + 100) for a, b in bounds()] + [(900 + i, 900 + i) for i in range(len(MORE))], key=repr)


def test_joining_decides(spark):
    """Without joined templates there are no layouts: only marks and warnings open entries."""
    from voxloom.operators.logs import mark_kind, masked

    heads = rows(logs.entry_bounds(frame(spark)), "first_line_id")
    alone = rows(logs.entry_bounds(frame(spark), similar=1.01), "first_line_id")
    assert len(alone) < len(heads) and [x[0] for x in alone] == sorted((i for i, t in enumerate(LINES, 1) if t and mark_kind(masked(t))), key=lambda i: repr((i,)))


def test_order_and_partitions_do_not_matter(spark):
    base = frame(spark)
    one, many = (rows(logs.templates(base.repartition(n))) for n in (1, 7))
    assert one == many
    small = logs.mined(logs.tokenised(base).repartition(3))
    assert {r.mask for r in small.collect()} == {logs.SEP.join(logs.masked(t)) for t in [*LINES, *MORE] if t and t.strip()}


def test_parts_are_merged_again(spark, monkeypatch):
    monkeypatch.setattr(logs, "PART_SEQUENCES", 3)
    lines = [(i, "a", i, f"2027-05-25 09:02:{i % 60:02d} - c.d - INFO - worker {w} sent {i} rows") for i, w in enumerate(["alpha", "beta", "gamma", "delta", "eta", "zeta", "iota", "kappa", "mu", "nu", "xi", "pi"])]
    got = logs.templates(spark.createDataFrame(lines, "line_id long, log_name string, line_no int, raw_line string")).filter("n_sequences > 1").collect()
    assert len(got) == 1 and got[0].template == "<T> - <C> - <L> - worker <*> sent <N> rows" and got[0].kind == "record" and got[0].head == "<T> - <C> - <L>"


def test_kinds_of_templates():
    kind = lambda t: logs.mark_kind(logs.masked(t))
    assert [kind(t) for t in ("=== STEP 1: List ===", "[SKIP] a1", "[1/7] Write", ">>> [51/94] x", "==> 3 of 9", "/a/b.py:3: UserWarning: old", "[DEBUG] x", "[1, 2]", "{", "--- a", "KeyError: 'A'", "  [SKIP] a")] == [
        "banner", "tag", "step", "progress", "progress", "warning", "tag", None, None, None, None, None]
    zone = lambda t: logs.zone(logs.masked(t))
    assert [zone(t) for t in ("2027-05-25 09:02:20 - m.i - INFO - x", "found 10:20 there", "  10:20 x", "ERROR:a.b:x", "error in it", "5 at 10:20", "at=10:20 x")] == [5, 0, 0, 3, 0, 0, 3]


def test_fields(spark):
    e = {r.first_line_id: r for r in logs.entries(frame(spark)).collect()}
    pick = lambda i: (e[i].time, e[i].level, e[i].component, e[i].message)
    assert pick(3)[:3] == ("2027-05-25 09:02:20", "INFO", "merge.items") and pick(3)[3].endswith("quoted")
    assert pick(6)[:3] == ("0525 09:02:28.506991", "INFO", "merge_items.cc") and "KeyError" in pick(6)[3]
    assert pick(12) == ("2029/07/31 13:14:17,528", "INFO", "vad.energy", "chunk 32 sent")
    assert pick(13) == ("Jul 31 13:13:43", "INFO", "asrd", "wrote 43 segments")
    assert pick(14)[:3] == (None, "WARNING", "/opt/p2/init.py:22") and e[14].kind == "warning" and e[14].last_line_id == 17
    assert pick(18) == ("2029-08-07T16:12:17Z", "WARNING", "asr.align", "timeout after 38s")
    assert pick(19)[:3] == (None, "ERROR", "dia.worker")
    assert pick(24) == ("2028-01-07T12:34:25Z", "INFO", "asr.loader", 'found a time: 00:10:10\n{\n  "file": "t"\n}')
    assert pick(28) == ("1891778213944", "ERROR", "fuzz.tokens", "header repaired")
    assert [e[i].kind for i in (2, 21, 22, 23)] == ["banner", "tag", "step", "progress"]


def test_empty_and_keyless(spark):
    schema = "line_id long, log_name string, line_no int, raw_line string"
    assert logs.entries(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(1, None, 1, "[SKIP] x"), (2, "a", None, "[SKIP] x"), (3, "a", 1, "[SKIP] " + "x" * 200_000)], schema)
    assert rows(logs.entry_bounds(df)) == [(3, 3)]


def test_templates_merge_and_slots(spark):
    lines = [(i, "a", i, f"2027-05-25 09:02:{i % 60:02d} - c.d - INFO - worker {w} sent {i} rows") for i, w in enumerate(["alpha", "beta", "gamma"] * 20)]
    got = logs.templates(spark.createDataFrame(lines, "line_id long, log_name string, line_no int, raw_line string").repartition(3)).collect()
    assert [(r.template, r.n_lines) for r in got] == [("<T> - <C> - <L> - worker <*> sent <N> rows", 60)]


def test_lcs_and_join():
    assert logs.lcs(list("axbyc"), list("abzc")) == [(0, 0), (2, 1), (4, 3)]
    assert logs.join_templates("a b c d".split(), "a x c d".split()) == ["a", "<*>", "c", "d"]
    assert logs.join_templates("a b".split(), "x y z w q".split()) is None


def test_long_entries_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(logs, "BLOCK_LINES", 4)
    data = [(i, "a", i, "[DONE] x" if i in (2, 12) else f"line {i}" if i != 11 else "") for i in range(1, 14)]
    got = rows(logs.entries(spark.createDataFrame(data, "line_id long, log_name string, line_no int, raw_line string")), "first_line_id", "last_line_id", "n_lines", "part_no", "kind", "message")
    assert got == [(12, 13, 2, 0, "tag", "[DONE] x\nline 13"), (2, 10, 9, 0, "tag", "[DONE] x\nline 3"), (2, 10, 9, 1, "tag", "line 4\nline 5\nline 6\nline 7"), (2, 10, 9, 2, "tag", "line 8\nline 9\nline 10")]


def test_templates_do_not_depend_on_pieces(spark, monkeypatch):
    """Pairs of alike sequences that join nothing else meet, however few sequences a task takes up at once."""
    pairs = [f"2027-05-25 09:02:20 - c.d - INFO - {x} took {y} of the {x}{x} rows {x}{y}" for x in ("ab", "cd", "ef", "gh", "ij", "kl") for y in ("one", "two")]
    base = spark.createDataFrame([(i, "a", i, t) for i, t in enumerate(pairs)], "line_id long, log_name string, line_no int, raw_line string")
    whole = rows(logs.templates(base))
    assert len(whole) < len(pairs)
    for piece in (1, 2, 5):
        monkeypatch.setattr(logs, "PART_SEQUENCES", piece)
        assert rows(logs.templates(base)) == whole


def test_clusters_meet_all_templates():
    """The index of first tokens finds the template that a comparison with all finds, whatever it was told to expect."""
    import random

    r = random.Random(5)
    seqs = [list(s) for s in dict.fromkeys(tuple(r.choice("aabbcdefghijkl") for _ in range(r.randint(1, 12))) for _ in range(600))]
    made, at = [], []
    for s in seqs:
        i = next((i for i, t in enumerate(made) if logs.join_templates(t, s) is not None), len(made))
        made[i:i + 1] = [logs.join_templates(made[i], s) if i < len(made) else s]
        at.append(i)
    for piece in (1, 50, 600):
        book, got = logs.Clusters(), []
        for k in range(0, len(seqs), piece):
            book.expect(seqs[k:k + piece])
            got += [book.add(s) for s in seqs[k:k + piece]]
        assert (got, book.rows) == (at, made)


def test_long_lcs_is_that_of_the_table():
    """Of several longest subsequences, long sequences give the one that short ones do."""
    short = ["x", *"abab", "y"], ["z", *"baba", "w"]
    mid = logs.lcs(*short)
    pad = [f"p{i}" for i in range(60)], [f"q{i}" for i in range(60)]
    long = logs.lcs(["x", *"abab", *pad[0], *pad[0], "y"], ["z", *"baba", *pad[1], *pad[1], "w"])
    assert long == mid
