"""Driver contract: entry() runs, registry and oracle SQL line up."""


def test_entry_and_registry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert len(df.columns) == 70
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 140
