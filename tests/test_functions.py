import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import rows
from voxloom.functions import text as tx
from voxloom.functions import vectors as vx
from voxloom.functions.timeutil import clock_seconds, hms, overlap
from voxloom.operators.chunk import split_text


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


def test_hms_and_clock(spark):
    got = spark.createDataFrame([(0.0,), (3661.9,), (400_000.0,), (None,)], "v double").select(hms(F.col("v")))
    assert [r[0] for r in got.collect()] == ["00:00:00", "01:01:01", "111:06:40", None]
    t = spark.createDataFrame([("01:30.5",), ("1:00:02",), ("x",), (None,), ("7",)], "v string").select(clock_seconds(F.col("v")))
    assert [r[0] for r in t.collect()] == [90.5, 3602.0, None, None, None]


def test_overlap(spark):
    df = spark.createDataFrame([(0, 5, 5, 9), (0, 5, 3, 9), (0, 9, 4, 4), (None, 5, 3, 9), (8, 9, 0, 1)], "a int, b int, c int, d int")
    assert [r[0] for r in df.select(overlap(*[F.col(c) for c in "abcd"])).collect()] == [0, 2, 0, None, 0]


def py_align(t):
    return [w for w in (re.sub(r"[^\w]", "", x.lower()) for x in t.split()) if w]


def test_tokens_follow_unicode(spark):
    texts = ["Käse, foo_bar -- x2!", "a b　c", "", "...", "Éa ñ9 й"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "v string")
    assert [r[0] for r in df.select(tx.align_tokens(F.col("v"))).collect()] == [py_align(t) for t in texts] + [[]]
    assert [r[0] for r in df.select(tx.eval_tokens(F.col("v"))).collect()][0] == ["k", "se", "foo", "bar", "x2"]


def test_sentences_fence_first_text_heading_stem(spark):
    assert one(spark, "A b. C! D? e", "string", tx.sentences) == ["A b.", "C!", "D?", "e"]
    assert one(spark, "```json\n[1]\n```", "string", tx.strip_fence) == "[1]" and one(spark, " [2] ", "string", tx.strip_fence) == "[2]"
    df = spark.createDataFrame([("", "b "), (None, None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(tx.first_text(F.col("x"), F.col("y"))).collect()] == ["b", "", "a"]
    h = spark.createDataFrame([("audience 12",), ("Main (X)",), ("Speaker",), (None,)], "v string").select(tx.is_heading(F.col("v"), "Main (X)"))
    assert [r[0] for r in h.collect()] == [True, True, False, None]
    assert [one(spark, p, "string", tx.stem) for p in ("/a/b.c/d.e.mp3", "x", "/q/.hid")] == ["d.e", "x", ".hid"]


def test_diarization_line(spark):
    df = spark.createDataFrame([("start=1.0s stop=2.5s speaker_X1",), ("junk",)], "v string")
    f = tx.diarization_line(F.col("v"))
    assert [tuple(r) for r in df.select(*[c.alias(k) for k, c in f.items()]).collect()] == [(1.0, 2.5, "X1"), (None, None, None)]


def py_wer(r, h):
    d = list(range(len(h) + 1))
    for i, a in enumerate(r, 1):
        p, d[0] = d[0], i
        for j, b in enumerate(h, 1):
            p, d[j] = d[j], min(p + (a != b), d[j] + 1, d[j - 1] + 1)
    return d[-1] / len(r) if r else 0.0


def test_wer_and_set_f1(spark):
    rng = random.Random(5)
    data = [([rng.choice("a b c d e ff".split()) for _ in range(rng.randint(0, 12))], [rng.choice("a b c d e ff".split()) for _ in range(rng.randint(0, 12))]) for _ in range(300)]
    data.append(([f"w{i}" for i in range(3000)], [f"w{i}" for i in range(0, 3000, 2)]))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(data)], "i int, a array<string>, b array<string>")
    for i, w, f in rows(df.select("i", tx.wer(F.col("a"), F.col("b")), tx.set_f1(F.col("a"), F.col("b")))):
        a, b = data[i]
        x, y = set(a), set(b)
        c = len(x & y)
        assert math.isclose(w, py_wer(a, b)) and math.isclose(f, 2 * (c / len(y)) * (c / len(x)) / (c / len(y) + c / len(x)) if c else 0.0)


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 2.0]), (None, [1.0]), ([float("nan")], [1.0]), ([], [])], "a array<double>, b array<double>")
    d = [r[0] for r in df.select(vx.cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert math.isclose(d[0], 0.04) and d[1] == 1.0 and d[2] is None and d[3] is None
    assert [r[0] for r in df.select(vx.is_valid(F.col("a"))).collect()] == [True, True, True, False, False, False]
    assert df.select(vx.l2_normalize(F.col("a"))).collect()[0][0] == [0.6, 0.8] and df.select(vx.l2_normalize(F.col("a"))).collect()[1][0] == [0.0, 0.0]


def test_split_text_cases():
    assert split_text("Hi. " + "x" * 9 + " yy.", 10) == ["Hi.", "x" * 9, "yy."]
    assert split_text("Hi. " + "x" * 9 + " yy.", 10, repeat=True) == ["Hi.", "x" * 9, "yy.", "Hi."]
    assert split_text("w" * 30, 10) == ["w" * 30] and split_text("", 10) == [] and split_text("a b. c d.", 100) == ["a b. c d."]
    assert split_text("abc. defgh.", 10) == ["abc.", "defgh."] and split_text("abc. defgh.", 11) == ["abc. defgh."]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?", max_size=120), st.integers(5, 30))
def test_split_text_keeps_all_words(text, most):
    parts = split_text(text, most)
    assert " ".join(parts).split() == text.split()
    assert all(len(p) <= most or " " not in p for p in parts)


def test_sql_functions(spark):
    from voxloom.functions.udfs import register

    register(spark)
    assert [tuple(r) for r in spark.sql("select * from split_text('Aa bb. Cc dd. Ee.', 14)").collect()] == [(0, "Aa bb. Cc dd."), (1, "Ee.")]
    assert spark.sql("select lcs_length(array('a', 'b', 'c'), array('b', 'x', 'c')), lcs_length(null, array('a'))").first()[:] == (2, None)
    df = spark.createDataFrame([(1, "Aa. Bb."), (2, None)], "i int, t string")
    df.createOrReplaceTempView("texts_for_split")
    assert [tuple(r) for r in spark.sql("select i, chunk from texts_for_split, lateral split_text(t, 4)").collect()] == [(1, "Aa."), (1, "Bb.")]


def test_edit_distance_brute_force():
    import random

    rng = random.Random(2)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]

    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 90))] for _ in range(2))
        assert tx.edit_distance(a, b) == slow(a, b)


def test_split_text_lanes():
    assert split_text("Aa. " + "b" * 4 + " " + "c" * 6 + " dd. Ee. Ff.", 9) == ["Aa.", "bbbb", "cccccc", "dd.", "Ee. Ff."] or split_text("Aa. bbbb cccccc dd. Ee. Ff.", 9) == ["Aa.", "bbbb", "cccccc dd.", "Ee. Ff."]
    assert split_text("Hi. " + "x" * 9 + " yy. Zz. " + "v" * 12 + ".", 10, repeat=True) == ["Hi.", "x" * 9, "yy.", "Hi. Zz.", "v" * 12 + ".", "Hi. Zz."]


def test_signal(spark):
    from voxloom.functions import signal

    df = spark.createDataFrame([([1.0, -1.0, 1.0, -1.0],), ([1.0, 1.0, 1.0, 1.0],), ([0.0, 0.0],), ([5.0],), ([],), (None,)], "x array<double>")
    got = [tuple(r) for r in df.select(signal.zero_crossing_rate(F.col("x")), signal.spectral_centroid(F.col("x"), 8)).collect()]
    assert got == [(0.75, 4.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (None, None), (None, None)]
