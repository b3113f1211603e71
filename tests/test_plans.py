"""Plan properties the design relies on at scale."""

import os

from pyspark.sql import functions as F

from ledgerlake.operators import targets as T
from ledgerlake.sources import filings as S
from tests.test_accounts import write_tree


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_compacted_read_prunes_buckets(spark, tmpdir_path):
    root, comp = os.path.join(tmpdir_path, "landed"), os.path.join(tmpdir_path, "comp")
    write_tree(root)
    S.compact_filing_lines(spark, root, comp, buckets=8)
    # targets come from a filtered state table, as in a gold run
    state = os.path.join(tmpdir_path, "state")
    spark.createDataFrame([("0100000001", "done"), ("0100000002", "pending")],
                          "enterprise_key string, status string").write.parquet(state)
    keys = spark.read.parquet(state).filter(F.col("status") == "done").select("enterprise_key")
    df = S.read_compacted_lines(spark, comp, keys, buckets=8)
    assert "dynamicpruning" in plan_of(df).lower()
    assert {r[0] for r in df.select("enterprise_key").distinct().collect()} == {"0100000001"}


def test_latest_deposits_is_partial_top_k(spark):
    dep = spark.createDataFrame([("c", f"r{i}", "2022-01-01", f"2022-02-{i % 28 + 1:02d}") for i in range(30)],
                                "company string, reference string, periodEndDate string, depositDate string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan_of(T.latest_deposits(dep, 20))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p


def test_flat_targets_push_filters_to_scan(spark, tmpdir_path):
    act = spark.createDataFrame([("0100.000.001", "55100", "MAIN")], "EntityNumber string, NaceCode string, "
                                "Classification string")
    ent = spark.createDataFrame([("0100.000.001", "AC", "2", "014")], "EnterpriseNumber string, Status string, "
                                "TypeOfEnterprise string, JuridicalForm string")
    act.write.parquet(os.path.join(tmpdir_path, "a"))
    ent.write.parquet(os.path.join(tmpdir_path, "e"))
    df = T.target_companies_flat(spark.read.parquet(os.path.join(tmpdir_path, "e")),
                                 spark.read.parquet(os.path.join(tmpdir_path, "a")))
    p = plan_of(df)
    assert "PushedFilters: [IsNotNull(Classification), EqualTo(Classification,MAIN)" in p
    assert "EqualTo(Status,AC)" in p
    assert df.count() == 1


def exchanges(df) -> int:
    return plan_of(df).count("Exchange hashpartitioning")


def test_search_plan(spark):
    """Token and number matching, and literal fallbacks, are equi-joins."""
    from ledgerlake.operators import search as SE
    from tests.test_views_search import companies
    q = SE.classify(spark.createDataFrame([(1, "central"), (2, "0836157420")], "query_id int, q string"))
    c = companies(spark)
    for hits in (SE.token_hits(SE._names(c), q, 5), SE.number_hits(c, q)):
        assert "CartesianProduct" not in plan_of(hits) and "NestedLoop" not in plan_of(hits)
    # only patterns with metacharacters or of one or two characters are tested against every name
    assert plan_of(SE.regex_hits(SE._names(c), q)).count("CartesianProduct") + plan_of(SE.regex_hits(SE._names(c), q)).count("NestedLoop") <= 1


def test_gold_chain_exchanges(spark, tmpdir_path):
    from ledgerlake.operators import accounts as A
    from ledgerlake.operators import gold as G
    from ledgerlake.operators import views as V
    root = os.path.join(tmpdir_path, "landed")
    write_tree(root)
    state = spark.createDataFrame([("0100.000.001", "done")], "_id string, status string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        gold = G.numbered_accounts(A.facts_from_lines(S.read_filing_lines(spark, root)), state, F.current_timestamp())
        # filings, companies, and the state's numbers
        assert exchanges(gold) <= 3
        assert exchanges(V.flow_node_totals(V.first_filing_per_year(V.year_rows(gold)))) == exchanges(V.pnl_flows(gold))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
