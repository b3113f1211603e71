
from pyspark.sql import functions as F

from ledgerlake.operators import search as SE
from ledgerlake.operators import views as V

YEARS = "enterprise_number string, year int, filing_ref string, ca double, marge_brute double, ebit double, resultat_net double"


def edges(spark, row):
    df = spark.createDataFrame([("c",) + row], YEARS)
    return sorted((r["source"], r["target"], r["value"]) for r in V.flow_edges(df).collect())


def test_flow_rules(spark):
    # profit
    assert edges(spark, (2022, "r", 1000.0, 600.0, 200.0, 150.0)) == [
        (0, 1, 600.0), (0, 2, 400.0), (1, 3, 200.0), (1, 4, 400.0), (3, 5, 150.0), (3, 6, 50.0)]
    # loss with positive EBIT -> 3 -> 7
    assert (3, 7, 30.0) in edges(spark, (2022, "r", 1000.0, 600.0, 100.0, -30.0))
    # loss with EBIT <= 0 -> 1 -> 7
    assert (1, 7, 30.0) in edges(spark, (2022, "r", 1000.0, 600.0, -10.0, -30.0))
    # gross margin above revenue: no cost edge
    assert all(t != 2 for _, t, _ in edges(spark, (2022, "r", 100.0, 150.0, 0.0, 0.0)))
    # all zero: no edges
    assert edges(spark, (2022, "r", 0.0, 0.0, 0.0, 0.0)) == []


def test_node_totals(spark):
    df = spark.createDataFrame([("c", 2022, "r", 1000.0, 0.0, -10.0, -30.0)], YEARS)
    t = {r["node"]: r["total"] for r in V.flow_node_totals(df).collect()}
    assert t[0] == 1000.0 and t[2] == 1000.0 and t[7] == 30.0
    assert t[1] == 30.0  # no incoming edge -> sum of outgoing


def test_null_nonfinite_nested(spark):
    df = spark.createDataFrame(
        [(float("nan"), (float("inf"), 1.0), [float("-inf"), 2.0], {"k": float("nan")})],
        "a double, s struct<x: double, y: double>, arr array<double>, m map<string, double>")
    r = V.null_nonfinite(df).first()
    assert r["a"] is None and r["s"]["x"] is None and r["s"]["y"] == 1.0
    assert r["arr"] == [None, 2.0] and r["m"]["k"] is None


def test_display(spark):
    df = spark.createDataFrame([([], [])], "d array<struct<Denomination: string>>, a array<struct<StreetFR: string, "
                               "StreetNL: string, HouseNumber: string, Zipcode: string, MunicipalityFR: string, "
                               "MunicipalityNL: string>>")
    r = df.select(V.display_name(F.col("d")).alias("n"), V.display_address(F.col("a")).alias("a")).first()
    assert r["n"] == "Entreprise sans dénomination" and r["a"] == "Adresse non renseignée"
    df2 = spark.createDataFrame([([("", "Straat", "5", "1000", "", "Brussel")],)],
                                "a array<struct<StreetFR: string, StreetNL: string, HouseNumber: string, "
                                "Zipcode: string, MunicipalityFR: string, MunicipalityNL: string>>")
    assert df2.select(V.display_address(F.col("a"))).first()[0] == "Straat 5, 1000 Brussel"


def companies(spark, n_extra=60):
    rows = [("0836.157.420", "Hotel Central"), ("0123.456.789", "Grand Hôtel du Lac"),
            ("0999.999.999", "Garage Central")]
    rows += [(f"0500.000.{i:03d}", f"Widgetworks {i}") for i in range(n_extra)]
    df = spark.createDataFrame(rows, "EnterpriseNumber string, name string")
    code = F.when(F.col("name").startswith("Garage"), F.lit("45200")).otherwise(F.lit("55100"))
    return df.select(
        "EnterpriseNumber", F.lit("Actif").alias("StatusLabel"), F.lit("SA").alias("JuridicalFormLabel"),
        F.array(F.struct(F.lit("1").alias("TypeOfDenomination"), F.col("name").alias("Denomination"))).alias("denominations"),
        F.array(F.struct(F.lit("1000").alias("Zipcode"), F.lit("Bxl").alias("MunicipalityFR"))).alias("addresses"),
        F.array(F.struct(code.alias("NaceCode"), F.lit("SECO").alias("Classification"),
                         F.lit("x").alias("NaceLabel"))).alias("activities"))


def run(spark, queries):
    q = spark.createDataFrame(list(enumerate(queries)), "query_id int, q string")
    res = SE.search(companies(spark), q, limit=50)
    out = {}
    for r in res.collect():
        out.setdefault(queries[r["query_id"]], []).append((r["rank"], r["EnterpriseNumber"], r["source"]))
    return {k: sorted(v) for k, v in out.items()}


def test_search_cases(spark):
    r = run(spark, ["0836157420", "836157420", "836157", "central plaza", "hôtel", "widgetw", "Widgetworks", "x",
                    "lac$", "zz(", "a["])
    assert [e[1] for e in r["0836157420"]] == ["0836.157.420"]
    assert [e[1] for e in r["836157420"]] == ["0836.157.420"]
    assert "836157" not in r                                    # 6 digits: empty, no fallback
    assert [e[1] for e in r["central plaza"]] == ["0836.157.420"]  # garage filtered by sector
    assert sorted(e[1] for e in r["hôtel"]) == ["0123.456.789", "0836.157.420"]  # accents folded
    assert len(r["widgetw"]) == 50 and r["widgetw"][0][2] == "regex"             # partial word -> fallback
    assert len(r["Widgetworks"]) == 50 and r["Widgetworks"][0][2] == "token"
    assert "x" not in r                                          # too short
    assert [e[1] for e in r["lac$"]] == ["0123.456.789"]         # regex text
    assert "zz(" not in r and "a[" not in r                      # invalid regex: no rows, batch not failed


def test_search_top_k_is_partial_before_shuffle(spark):
    q = spark.createDataFrame([(1, "Widgetworks")], "query_id int, q string")
    hits = SE.token_hits(SE._names(companies(spark)), SE.classify(q), 50)
    plan = SE.rank_limit(hits, 50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "Window" in plan


def test_name_index_search_matches_plain(spark, tmpdir_path):
    queries = ["0836157420", "central plaza", "hôtel", "widgetw", "Widgetworks", "lac$"]
    q = spark.createDataFrame(list(enumerate(queries)), "query_id int, q string")
    comp = companies(spark)
    SE.build_name_index(comp, tmpdir_path + "/idx", buckets=4)
    a = SE.search_indexed(comp, tmpdir_path + "/idx", q, limit=50)
    b = SE.search(comp, q, limit=50)
    cols = ["query_id", "rank", "EnterpriseNumber", "source"]
    assert sorted(tuple(r) for r in a.select(cols).collect()) == sorted(tuple(r) for r in b.select(cols).collect())


def test_flows_and_series_from_flat_facts(spark):
    df = spark.createDataFrame([("c", 2022, "r1", 1000.0, 600.0, 200.0, 150.0),
                                ("c", 2022, "r2", 5.0, 5.0, 5.0, 5.0)], YEARS)
    edges = sorted((r["source"], r["target"]) for r in V.pnl_flows(df).collect())
    assert edges == [(0, 1), (0, 2), (1, 3), (1, 4), (3, 5), (3, 6)]     # first filing of the year only


def test_fold_strips_all_accents(spark):
    words = ["Hôtel", "Ho\u0302tel", "Șoseaua", "ẽtre", "Ἀθήνα", "ﬁne", "Łódź", "한글"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(SE.fold(F.col("w"))).collect()]
    assert got == ["hotel", "hotel", "soseaua", "etre", "αθηνα", "ﬁne", "łodz", "한글"]


def test_short_literal_and_number_windows(spark):
    r = run(spark, ["la", "12345", "0500000001", "500 000 001"])
    assert [e[1] for e in r["la"]] == ["0123.456.789"]
    assert "12345" not in r                                      # a dotted number has no run of five digits
    assert [e[1] for e in r["0500000001"]] == [e[1] for e in r["500 000 001"]] == ["0500.000.001"]


def test_undotted_numbers(spark):
    c = companies(spark, 2).withColumn("EnterpriseNumber", F.translate("EnterpriseNumber", ".", ""))
    q = spark.createDataFrame([(1, "36157"), (2, "0836157420")], "query_id int, q string")
    got = [(r["query_id"], r["EnterpriseNumber"]) for r in SE.number_hits(c, SE.classify(q)).collect()]
    assert got == [(1, "0836157420")]                            # ten digits are looked for with dots between


PATTERNS = ["hotel", "h.tel", "ho+tel", "hot(el|ring)", "hotel|ring", "hotel|x", "r.d.*ring", "small r?ing", "ring{2}s", "ri[mn]gs", "^red", "gear$", r"gear\.s", r"\bsmall", r"a\\bc",
            "[(]abc", "abc[]]def", "(?x) r e d", "(?i:red) ring", "ab", "", "((red))ring", "(((((red)))))ring", "re++d rin", "hotel??s", "é+lan", "ÉLAN", "sm.ll ..d ring", r"\Qa.b\E", "red{", "a|", "|{1,2}mall", "|?red", "zz(", "a["]


def test_required_grams(spark):
    got = {r["qt"]: r["branches"] for r in spark.createDataFrame([(p,) for p in PATTERNS], "qt string").select("qt", SE.required_grams(F.col("qt")).alias("branches")).collect()}
    want = {"hotel": [["hot", "ote", "tel"]], "h.tel": [["tel"]], "ho+tel": [["tel"]], "hot(el|ring)": [["hot"]], "hotel|ring": [["hot", "ote", "tel"], ["rin", "ing"]],
            "r.d.*ring": [["rin", "ing"]], "small r?ing": [["sma", "mal", "all", "ll ", "ing"]], "ring{2}s": [["rin"]], "^red": [["red"]], r"\bsmall": [["sma", "mal", "all"]],
            "ÉLAN": [["Éla", "lan"]], "re++d rin": [["d r", " ri", "rin"]], "hotel??s": [["hot", "ote"]], "((red))ring": [["rin", "ing"]]}
    assert {k: got[k] for k in want} == want
    assert all(got[p] is None for p in ["hotel|x", "(?x) r e d", "(?i:red) ring", "ab", "", "(((((red)))))ring", r"\Qa.b\E", "red{", "a|", "|{1,2}mall", "|?red", "zz(", "abc[]]def", r"a\\bc"])


def test_regex_hits_against_every_name(spark):
    """Patterns made at random of regex parts: the same rows as each pattern tried on each name."""
    import random
    rng = random.Random(5)
    parts = ["red", "ring", " ", "s", "mall", ".", ".*", "+", "?", "*", "|", "(", ")", "[", "]", "a-s", "{1,2}", "\\", "b", "d", "^", "$", "gear", "RING", "é", "(?"]
    patterns = sorted({"".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(700)} | set(PATTERNS))
    texts = ["red ring", "small red ring", "rring", "Hotel", "hoteel", "ringgs", "gear s", "GEAR.S", "élan", "a\\bc", "abc]def", "(abc", "reed rings", "ss", "", "small ing", "redring\\", "mall", "hot[ring]", "rimgs"]
    names = spark.createDataFrame([(f"{k:04d}", t) for k, t in enumerate(texts)] + [("0001", "second ring")], "EnterpriseNumber string, name string")
    q = spark.createDataFrame(list(enumerate(patterns)), "query_id int, qt string")
    ok = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.concat(F.lit("(?i)"), F.col("qt"))).isNotNull()
    want = q.filter(ok).join(names, F.regexp_like("name", F.concat(F.lit("(?i)"), F.col("qt")))).select("query_id", "EnterpriseNumber").distinct()
    got = SE.regex_hits(names, q)
    assert sorted(tuple(r) for r in got.select("query_id", "EnterpriseNumber").collect()) == sorted(tuple(r) for r in want.collect())
    planned, other = SE.split_by_grams(q)
    assert planned.count() > 100 and other.count() > 100


def joined_rows(plan) -> int:
    """The most rows that a join of an executed plan made."""
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan.plan() if "QueryStage" in plan.nodeName() else plan
    kids = plan.children()
    own = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() else 0
    return max([own, *(joined_rows(kids.apply(k)) for k in range(kids.size()))])


def test_regex_candidates_come_from_the_rarest_gram(spark):
    """Grams that every name has propose none: 40 queries and 200 names share five."""
    names = spark.createDataFrame([(f"c{k:03d}", f"kind{k} Brand#{k}") for k in range(200)], "EnterpriseNumber string, name string")
    q = spark.createDataFrame([(k, f"d{k} Brand#{k}") for k in range(40)] + [(90, '"kind7 Brand#7" -"hot"'), (7, "nd#199|kind3 ")], "query_id int, qt string")
    got = SE.regex_hits(names, q)
    rows = sorted((r["query_id"], r["EnterpriseNumber"]) for r in got.collect())
    want = q.join(names, F.regexp_like("name", F.concat(F.lit("(?i)"), F.col("qt")))).select("query_id", "EnterpriseNumber").distinct()
    assert rows == sorted(map(tuple, want.collect())) and len(rows) >= 42
    assert joined_rows(got._jdf.queryExecution().executedPlan()) < 42 * 200 / 2
