"""Small helpers for tests."""


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


def clashing(df):
    """The table with further columns whose names operators use inside."""
    from pyspark.sql import functions as F

    for name in ("blk", "n", "key", "at", "kind", "entry", "_id", "part", "speech", "node", "pos", "head", "spike", "source2", "rid", "lid", "raw", "form", "shard", "cap", "upto"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df
