import __spark_entry__ as E


def test_contract(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 60
    df = E.entry(spark)
    assert df.count() > 0


def test_a_few_queries_run_on_smoke_data(spark):
    qs = E.queries()
    for name in ("financial_facts", "silver_companies", "search", "deed_status", "pnl_flows"):
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0
