import pytest

import __spark_entry__ as entry


def test_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and {"flagship_blocks", "p1_found", "p6_found", "p7_found"} <= set(q)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["flagship_blocks", "p1_found", "merge_items", "greedy_push", "bridge_interpolate", "heading_fill", "set_f1", "prorated_times", "stream_windows", "cosine_nearest", "wer", "chunk_2800", "gemini_round_trip", "map_round_trip", "turn_round_trip",
                                  "docx_round_trip", "vector_round_trip", "incremental_round_trip", "listing_pending", "final_projection", "signal_features", "offset_shift"])
def test_against_sql(spark, sf, name):
    import os

    import duckdb
    import pandas as pd

    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    want = c.sql(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cell = lambda x: None if pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    table = lambda df: sorted([tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).to_numpy().tolist()], key=repr)
    assert table(got) == table(want)


def test_pipeline(spark, sf):
    from voxloom.plans import reference_queries as r

    out = r.pipeline_blocks(spark, sf).collect()
    assert out and all(len(x.text) <= 2800 and x.start <= x.end for x in out)
