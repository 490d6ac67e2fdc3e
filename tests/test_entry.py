"""Driver contract: entry smoke, every query has an oracle."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"run_id", "measure", "value"}


def test_every_query_has_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert {n for n in q if not n.startswith("op") and n != "pipeline"} <= set(o) <= set(q)
    assert len(q) >= 70
