"""Driver contract: entry() and the query / oracle registries."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and sum(r["n"] for r in rows) > 0


def test_every_oracle_has_a_query():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_oracle_matches_on_small_scale(spark):
    import duckdb
    from tools_compare import compare
    con = duckdb.connect()
    for t in ("lineitem", "part", "supplier"):
        con.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name in ("minimum_slice_confusion", "w9_previous_win", "g5_price_grid", "r5_recommend"):
        assert compare(E.queries()[name](spark, "/root/testdata/sf0.001"), con, E.oracle_sql()[name]), name
