import __spark_entry__ as E

from tests.conftest import SF


def test_every_query_has_an_oracle_or_is_listed(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"asset_class", "symbol", "timeframe", "bar_count"} <= set(df.columns)


def test_all_queries_run_on_smallest_scale(spark):
    for name, fn in E.queries().items():
        df = fn(spark, SF)
        df.limit(1).collect()
        assert all(f.dataType.typeName() != "timestamp" for f in df.schema.fields), name
