import random

import pytest

from tests.helpers import clashing, rows
from voxloom.operators.coverage import coverage

SCHEMA = "turn_id long, lecture_id string, start_s double, end_s double, speaker string"


def brute(data):
    by = {}
    for t, l, s, e, k in {tuple(r) for r in data}:
        if None in (l, s, e, k) or not k.strip() or not l.strip():
            continue
        a, b = round(s * 1000), round(e * 1000)
        if b > a:
            by.setdefault((l, k), []).append((a, b))
    out = []
    for (l, k), xs in by.items():
        periods = []
        for a, b in sorted(xs):
            if periods and a <= periods[-1][1]:
                periods[-1][1], periods[-1][2] = max(periods[-1][1], b), periods[-1][2] + 1
            else:
                periods.append([a, b, 1])
        out += [("period", l, k, a, b, n) for a, b, n in periods]
        out += [("gap", l, k, p[1], q[0], 0) for p, q in zip(periods, periods[1:])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [700, 50_000, 10**9])
def test_against_brute_force(spark, block):
    rng = random.Random(block)
    data = []
    for i in range(400):
        s = rng.randint(0, 900) / 10
        data.append((i, rng.choice(["a", "b"]), s, s + rng.randint(-10, 60) / 10, rng.choice(["x", "y", "z", None, " "])))
    data += data[:40] + [(900, "a", None, 2.0, "x"), (901, "a", 1.0, None, "x"), (902, None, 1.0, 2.0, "x"), (903, "a", float("nan"), 2.0, "x")]
    df = spark.createDataFrame([d for d in data if d[2] is None or d[2] == d[2]], SCHEMA)
    got = rows(coverage(clashing(df), ["lecture_id", "speaker"], block_ms=block), "kind", "lecture_id", "speaker", "from_ms", "to_ms", "members")
    assert got == brute([d for d in data if d[2] is None or d[2] == d[2]])


def test_touching_nested_and_ties(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 1.0, "x"), (2, "a", 1.0, 2.0, "x"), (3, "a", 0.2, 0.5, "x"), (4, "a", 3.0, 4.0, "x"), (5, "a", 3.0, 4.0, "x")], SCHEMA)
    assert rows(coverage(df, ["lecture_id", "speaker"]), "kind", "from_ms", "to_ms", "members") == [("gap", 2000, 3000, 0), ("period", 0, 2000, 3), ("period", 3000, 4000, 2)]


def test_empty(spark):
    assert coverage(spark.createDataFrame([], SCHEMA), ["lecture_id", "speaker"]).count() == 0
