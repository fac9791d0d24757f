import random

from pyspark.sql import functions as F

from tests.helpers import rows
from voxloom.operators import scan


def data(spark, n=500, seed=3):
    rng = random.Random(seed)
    out = [(k, i, rng.choice([None, 1, 2, 3])) for k in "ab" for i in rng.sample(range(5 * n), n)]
    return out, spark.createDataFrame(out, "k string, i long, v int").withColumn("blk", F.floor(F.col("i") / 97))


def test_sums_maxs_lag_and_last(spark):
    raw, df = data(spark)
    got = scan.block_scan(df, ["k"], "blk", [F.col("i")], sums={"s": F.col("v")}, maxs={"m": F.col("v")})
    lag = scan.block_lag(df, ["k"], "blk", [F.col("i")], {"before": F.col("i")})
    last = scan.block_last(df, ["k"], "blk", [F.col("i")], "last", F.when(F.col("v") == 2, F.col("i")))
    strict = scan.block_last(df, ["k"], "blk", [F.col("i")], "last", F.when(F.col("v") == 2, F.col("i")), inclusive=False)
    want, wl, wt, ws = [], [], [], []
    for k in "ab":
        s, m, b, t = 0, None, None, None
        for _, i, v in sorted(r for r in raw if r[0] == k):
            s += v or 0
            m = v if m is None else max(m, v or m)
            want.append((k, i, s, m))
            wl.append((k, i, b))
            ws.append((k, i, t))
            t = i if v == 2 else t
            wt.append((k, i, t))
            b = i
    assert rows(got, "k", "i", "s", "m") == sorted(want, key=repr)
    assert rows(lag, "k", "i", "before") == sorted(wl, key=repr)
    assert rows(last, "k", "i", "last") == sorted(wt, key=repr)
    assert rows(strict, "k", "i", "last") == sorted(ws, key=repr)


def test_salted_join_keeps_unmatched_and_null_keys(spark):
    l = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(60)], "i int, k string")
    r = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    got = rows(scan.salted_join(l, r, ["k"], F.col("i")), "i", "v")
    assert len(got) == 60 and all((v == 1) == (i % 3 != 0) for i, v in got)


def test_ms(spark):
    df = spark.createDataFrame([(1.2345,), (None,), (float("nan"),), (float("inf"),)], "s double")
    assert [r[0] for r in df.select(scan.ms(F.col("s"))).collect()] == [1235, None, None, None] or [r[0] for r in df.select(scan.ms(F.col("s"))).collect()] == [1234, None, None, None]


def test_checkpoints_are_tables_and_can_be_dropped(spark):
    from pathlib import Path

    from voxloom import session

    session.drop_checkpoints(spark)
    out = session.checkpointed(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"))
    path = session._WRITTEN[spark.sparkContext.applicationId][0]
    assert rows(out) == [(1, None), (2, "x")] and Path(path).exists()
    assert session.drop_checkpoints(spark) == 1 and not Path(path).exists()
