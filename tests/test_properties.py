"""Property checks: input order does not matter, number
normalisation round-trips, nesting keeps every company, edges out of the
revenue node add up, the event fold ignores arrival order."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import expr as X
from ledgerlake.operators import accounts as A
from ledgerlake.operators import deeds as D
from ledgerlake.operators import silver as S
from ledgerlake.operators import views as V

LINES = "enterprise_key string, filing_ref string, file_path string, line_no long, code string, value string"


def test_pivot_ignores_row_order(spark):
    rows = [("k1", "r1", "/k1/hbb/r1.csv", i, code, val) for i, (code, val) in enumerate([
        ("Accounting period end date", "2022-12-31"), ("70", None), ("70", "12"), ("70", "99"), ("60", "x"),
        ("60", "5"), ("9904", "3"), ("10/15", "30")])]
    base = sorted(tuple(r) for r in A.facts_from_lines(spark.createDataFrame(rows, LINES)).collect())
    for seed in range(3):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, LINES).repartition(3)
        assert sorted(tuple(r) for r in A.facts_from_lines(df).collect()) == base
    f = A.facts_from_lines(spark.createDataFrame(rows, LINES)).first()
    assert f["ca"] == 12 and f["achats"] == 0 and f["roe"] == 10


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=0, max_value=9_999_999_999))
def test_number_round_trip(spark, n):
    digits = f"{n:010d}"
    r = spark.createDataFrame([(digits, digits[1:] if digits[0] == "0" else digits)], "a string, b string").select(
        X.normalize_company_number(F.col("a")).alias("na"), X.normalize_company_number(F.col("b")).alias("nb")).first()
    assert r["na"] == f"{digits[:4]}.{digits[4:7]}.{digits[7:]}"
    assert r["na"] == r["nb"]
    again = spark.createDataFrame([(r["na"],)], "x string").select(
        X.company_key(F.col("x")).alias("k")).first()["k"]
    assert again == digits


def test_nesting_keeps_every_company(spark):
    parent = spark.createDataFrame([(f"c{i}", i) for i in range(20)] + [("c3", 99)], "EnterpriseNumber string, _seq long")
    child = spark.createDataFrame([(f"c{i % 7}", f"v{i}", i) for i in range(40)] + [(None, "orphan", 1)],
                                  "EntityNumber string, v string, _seq long")
    out = S.nest_children(parent, {"kids": (child, "EntityNumber")})
    assert out.count() == 21
    sizes = {(r["EnterpriseNumber"], r["_seq"]): len(r["kids"]) for r in out.collect()}
    assert sizes[("c0", 0)] == 6 and sizes[("c3", 99)] == sizes[("c3", 3)] and sizes[("c10", 10)] == 0
    firsts = out.filter(F.col("EnterpriseNumber") == "c1").select(F.col("kids")[0]["v"]).first()[0]
    assert firsts == "v1"


@settings(max_examples=20, deadline=None)
@given(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6), st.floats(-1e6, 1e6), st.floats(-1e6, 1e6))
def test_revenue_node_out_flows(spark, ca, mb, ebit, rn):
    df = spark.createDataFrame([("c", 2022, "r", ca, mb, ebit, rn)],
                               "enterprise_number string, year int, filing_ref string, ca double, marge_brute double, "
                               "ebit double, resultat_net double")
    out = sum(r["value"] for r in V.flow_edges(df).filter(F.col("source") == 0).collect())
    c, m = max(0.0, ca), max(0.0, mb)
    assert abs(out - (m + max(0.0, c - m))) <= 1e-6 * max(1.0, abs(out))


def test_fold_ignores_arrival_order(spark):
    from tests.test_deeds_pages import EVENTS, frame, table
    base = table(D.deed_status(frame(spark, EVENTS)))
    for seed in range(3):
        ev = EVENTS[:]
        random.Random(seed + 10).shuffle(ev)
        assert table(D.deed_status(frame(spark, ev).repartition(2))) == base
