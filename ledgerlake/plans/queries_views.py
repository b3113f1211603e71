"""Registered queries of the views (J7, G1, A8, X21, X24-X29, W3, O1, O2,
O6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import gold as G
from ..operators import views as V
from . import adapters as AD
from . import oracle as O
from .queries_gold import AS_OF_SQL, RESTORED_CTE, _numbered_accounts
from .registry import register
from .silver_run import build_silver


def gold_table(spark, sf_dir):
    """Nested gold rows of all companies of the test tables."""
    return _numbered_accounts(spark, sf_dir)


GOLD_W = O.FACTS_WITH + "," + RESTORED_CTE

PROFILE_SQL = "WITH " + O.REGISTER_CTE + ",\n" + GOLD_W[len("WITH "):] + f""",
g AS (SELECT enterprise_number, count(*) AS n FROM f GROUP BY enterprise_number)
SELECT e.EnterpriseNumber, coalesce(g1.n, g2.n) IS NOT NULL AS has_gold,
       CAST(coalesce(g1.n, g2.n) AS INTEGER) AS n_years,
       CASE WHEN coalesce(g1.n, g2.n) IS NOT NULL THEN {AS_OF_SQL} END AS last_updated
FROM enterprise e
LEFT JOIN g g1 ON g1.enterprise_number = e.EnterpriseNumber
LEFT JOIN g g2 ON g2.enterprise_number = replace(e.EnterpriseNumber, '.', '')"""


def _profile_out(p):
    gd = F.col("gold_data")
    return p.select("EnterpriseNumber", gd.isNotNull().alias("has_gold"),
                    F.when(gd.isNotNull(), F.size(gd["years"])).alias("n_years"),
                    gd["last_updated"].alias("last_updated"))


@register("company_profile", PROFILE_SQL)
def q_company_profile(spark, sf_dir):
    silver = build_silver(AD.register_tables(spark, sf_dir))
    return _profile_out(V.company_profile(silver, gold_table(spark, sf_dir)))


LOOKUP_SQL = PROFILE_SQL + """
WHERE e.EnterpriseNumber IN (
  SELECT DISTINCT substr(k, 1, 4) || '.' || substr(k, 5, 3) || '.' || substr(k, 8, 3)
  FROM (SELECT '0' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS k FROM orders WHERE o_orderpriority = '1-URGENT'))"""


@register("company_lookup", LOOKUP_SQL)
def q_company_lookup(spark, sf_dir):
    """J7 for a batch of requested numbers written with 9 digits."""
    silver = build_silver(AD.register_tables(spark, sf_dir))
    numbers = (AD.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
               .select(F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("q")))
    return _profile_out(V.company_profile(silver, gold_table(spark, sf_dir), numbers))


EDGES_CTE = """
fy AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY enterprise_number, year ORDER BY filing_ref) = 1),
b0 AS (SELECT enterprise_number, year, greatest(0.0, ca) AS c, greatest(0.0, marge_brute) AS mb, ebit AS eb,
              resultat_net AS rn FROM fy),
b1 AS (SELECT *, greatest(0.0, c - mb) AS cost, greatest(0.0, eb) AS ep, greatest(0.0, rn) AS np,
              CASE WHEN rn < 0 THEN -rn ELSE 0.0 END AS loss FROM b0),
b2 AS (SELECT *, greatest(0.0, mb - ep) AS opex, greatest(0.0, ep - np - loss) AS tax FROM b1),
edges AS (
  SELECT enterprise_number, year, 0 AS source, 1 AS target, mb AS value FROM b2 WHERE mb > 0
  UNION ALL SELECT enterprise_number, year, 0, 2, cost FROM b2 WHERE cost > 0
  UNION ALL SELECT enterprise_number, year, 1, 3, ep FROM b2 WHERE ep > 0
  UNION ALL SELECT enterprise_number, year, 1, 4, opex FROM b2 WHERE opex > 0
  UNION ALL SELECT enterprise_number, year, 3, 5, np FROM b2 WHERE np > 0
  UNION ALL SELECT enterprise_number, year, 3, 6, tax FROM b2 WHERE tax > 0
  UNION ALL SELECT enterprise_number, year, CASE WHEN ep > 0 THEN 3 ELSE 1 END, 7, loss FROM b2 WHERE loss > 0)"""


@register("pnl_flows", GOLD_W + "," + EDGES_CTE + "\nSELECT * FROM edges")
def q_pnl_flows(spark, sf_dir):
    return V.pnl_flows(gold_table(spark, sf_dir))


NODE_SQL = GOLD_W + "," + EDGES_CTE + """,
nodes AS (SELECT enterprise_number, year, c, unnest(range(0, 8)) AS node FROM b2),
inc AS (SELECT enterprise_number, year, target AS node, sum(value) AS s FROM edges GROUP BY ALL),
outg AS (SELECT enterprise_number, year, source AS node, sum(value) AS s FROM edges GROUP BY ALL)
SELECT n.enterprise_number, n.year, CAST(n.node AS INTEGER) AS node,
       round(CASE WHEN n.node = 0 THEN c WHEN coalesce(i.s, 0.0) <> 0 THEN i.s ELSE coalesce(o.s, 0.0) END, 2) AS total
FROM nodes n LEFT JOIN inc i USING (enterprise_number, year, node) LEFT JOIN outg o USING (enterprise_number, year, node)"""


@register("flow_node_totals", NODE_SQL)
def q_flow_node_totals(spark, sf_dir):
    years = V.first_filing_per_year(V.year_rows(gold_table(spark, sf_dir)))
    t = V.flow_node_totals(years)
    return t.select("enterprise_number", "year", "node", F.round("total", 2).alias("total"))


RATIO_SERIES_SQL = GOLD_W + """
SELECT enterprise_number, year, filing_ref, round(coalesce(roe, 0.0), 2) AS roe,
       round(coalesce(marge_brute, 0.0), 2) AS marge_brute, round(coalesce(marge_nette, 0.0), 2) AS marge_nette,
       round(coalesce(endettement, 0.0), 2) AS endettement, round(coalesce(liquidite, 0.0), 2) AS liquidite
FROM f"""


@register("ratio_series", RATIO_SERIES_SQL)
def q_ratio_series(spark, sf_dir):
    return V.ratio_series(gold_table(spark, sf_dir))


@register("year_picks", GOLD_W + """
SELECT enterprise_number, max(year) AS latest_year, arg_max(filing_ref, year::VARCHAR || '|' || filing_ref) AS desc_first_ref,
       min(year) AS first_year
FROM f GROUP BY enterprise_number""")
def q_year_picks(spark, sf_dir):
    g = gold_table(spark, sf_dir)
    return g.select("enterprise_number", G.latest_year(F.col("years")).alias("latest_year"),
                    X.first_element(G.years_desc(F.col("years")))["filing_ref"].alias("desc_first_ref"),
                    X.first_element("years")["year"].alias("first_year"))


NONFINITE_SQL = """
WITH x AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'NaN'::DOUBLE ELSE l_quantity END AS q,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'inf'::DOUBLE
         WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '-inf'::DOUBLE ELSE l_tax END AS t,
    l_discount AS d
  FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(q) THEN q END AS q, CASE WHEN isfinite(t) THEN t END AS t,
       CASE WHEN isfinite(q) THEN q END AS sq, d AS sd, CASE WHEN isfinite(t) THEN t END AS a0,
       CASE WHEN isfinite(q) THEN q END AS a1
FROM x"""


@register("null_nonfinite", NONFINITE_SQL)
def q_null_nonfinite(spark, sf_dir):
    li = AD.table(spark, sf_dir, "lineitem")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    q = F.when((rf == "R") & (ls == "F"), F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    t = (F.when((rf == "A") & (ls == "F"), F.lit(float("inf")))
         .when((rf == "N") & (ls == "O"), F.lit(float("-inf"))).otherwise(F.col("l_tax")))
    df = li.select("l_orderkey", "l_linenumber", q.alias("q"), t.alias("t"),
                   F.struct(q.alias("q2"), F.col("l_discount").alias("d")).alias("s"), F.array(t, q).alias("arr"))
    c = V.null_nonfinite(df)
    return c.select("l_orderkey", "l_linenumber", "q", "t", F.col("s.q2").alias("sq"), F.col("s.d").alias("sd"),
                    F.col("arr")[0].alias("a0"), F.col("arr")[1].alias("a1"))


DISPLAY_SQL = "WITH " + O.REGISTER_CTE + f""",
den AS (SELECT EntityNumber, count(*) AS n, arg_min(Denomination,
          (CASE WHEN coalesce(ltrim(trim(TypeOfDenomination), '0'), 'None') = '1' THEN 0 ELSE 1 END) * 1000000000000 + _seq) AS nm
        FROM denomination GROUP BY EntityNumber),
adr AS (SELECT * FROM address WHERE coalesce(trim(TypeOfAddress), 'None') = 'REGO'
        QUALIFY row_number() OVER (PARTITION BY EntityNumber ORDER BY _seq) = 1)
SELECT e.EnterpriseNumber,
  CASE WHEN den.n > 0 THEN den.nm ELSE 'Entreprise sans dénomination' END AS name_text,
  CASE WHEN adr.EntityNumber IS NULL THEN 'Adresse non renseignée' ELSE trim(
    coalesce(nullif(adr.StreetFR, ''), nullif(adr.StreetNL, ''), '') || ' ' || coalesce(nullif(adr.HouseNumber, ''), '')
    || ', ' || coalesce(nullif(adr.Zipcode, ''), '') || ' ' ||
    coalesce(nullif(adr.MunicipalityFR, ''), nullif(adr.MunicipalityNL, ''), '')) END AS address_text,
  coalesce(e.StatusLabel = 'Actif', false) AS is_active,
  coalesce(nullif(e.StatusLabel, ''), 'Actif') AS status_text,
  coalesce(nullif(e.StatusLabel, ''), 'Inconnu') AS status_list_text,
  coalesce(nullif(e.JuridicalFormLabel, ''), 'Société') AS form_text,
  coalesce(nullif({O.flip_sql('e.StartDate')}, ''), 'N/C') AS start_text
FROM enterprise_l e LEFT JOIN den ON den.EntityNumber = e.EnterpriseNumber
LEFT JOIN adr ON adr.EntityNumber = e.EnterpriseNumber"""


@register("display_texts", DISPLAY_SQL)
def q_display_texts(spark, sf_dir):
    s = V.display_defaults(build_silver(AD.register_tables(spark, sf_dir)))
    return s.select("EnterpriseNumber", V.display_name(F.col("denominations")).alias("name_text"),
                    V.display_address(F.col("addresses")).alias("address_text"),
                    "is_active", "status_text", "status_list_text", "form_text", "start_text")


# Both sides print from the same exact decimal expansion of the double; ties at
# the last digit are rounded up (away from zero).
def _fixed(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE))"


def _ratio_text_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 THEN 'N/C' ELSE {_fixed(x, 1)} || ' %' END AS {x}_text"


RATIO_TEXTS_SQL = GOLD_W + f"""
SELECT enterprise_number, year, filing_ref, {_ratio_text_sql('roe')}, {_ratio_text_sql('marge_brute')}, {_ratio_text_sql('marge_nette')},
       {_ratio_text_sql('endettement')},
       CASE WHEN liquidite IS NULL OR isnan(liquidite) OR liquidite = 0 THEN 'N/C' ELSE {_fixed('liquidite', 2)} END AS liquidite_text
FROM f"""


@register("ratio_texts", RATIO_TEXTS_SQL)
def q_ratio_texts(spark, sf_dir):
    return V.ratio_texts(V.year_rows(gold_table(spark, sf_dir)))


_AMOUNTS = ("ca", "marge_brute", "ebit", "resultat_net", "tresorerie", "dettes_financieres", "fonds_propres", "capital_souscrit")
AMOUNT_TEXTS_SQL = GOLD_W + "\nSELECT enterprise_number, year, filing_ref, " + ", ".join(
    f"CASE WHEN {a} IS NULL THEN 'N/C' ELSE regexp_replace(format('{{:,.3f}}', {a}), '(\\.[0-9]*[1-9])0+$|\\.0+$', '\\1') || ' €' END AS {a}_text"
    for a in _AMOUNTS) + "\nFROM f"


@register("amount_texts", AMOUNT_TEXTS_SQL)
def q_amount_texts(spark, sf_dir):
    return V.amount_texts(V.year_rows(gold_table(spark, sf_dir)))
