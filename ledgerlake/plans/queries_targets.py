"""Registered queries of target selection and progress state (F1-F5, J4,
J9, W1, E3, E4, U2, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import targets as T
from . import adapters as AD
from . import oracle as O
from .registry import register

# Parameters of the test adapters: two priorities play the sector codes,
# finished orders ('F') the main classification, MACHINERY an excluded form,
# FURNITURE a form without deeds.
SECTOR = ("1-URGENT", "2-HIGH")
EXCLUDED = ("MACHINERY",)
MAIN = "F"
NO_DEED = ("FURNITURE",)
SINCE = "1998-01-01"

_NUM = O.number_sql("c_custkey")
_ONUM = O.number_sql("o_custkey")

TARGETS_CTE = O.REGISTER_CTE + """,
tgt AS (
  SELECT EnterpriseNumber, JuridicalForm FROM enterprise e
  WHERE Status = 'AC' AND TypeOfEnterprise = '2' AND (JuridicalForm IS NULL OR JuridicalForm NOT IN ('MACHINERY'))
    AND EXISTS (SELECT 1 FROM activity a WHERE a.EntityNumber = e.EnterpriseNumber
                AND a.Classification = 'F' AND a.NaceCode IN ('1-URGENT', '2-HIGH')))"""

DEPOSITS_CTE = f"""
deposits AS (
  SELECT {_ONUM} AS company, CAST(o_orderkey AS VARCHAR) AS reference, year(o_orderdate) AS periodEndDateYear,
         'd' || CAST(o_orderkey AS VARCHAR) AS id,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS migration,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END
           AS periodEndDate,
         strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER), '%Y-%m-%d') AS depositDate
  FROM orders),
ds AS (
  SELECT {_NUM} AS _id, CASE WHEN c_acctbal >= 0 THEN 'done' ELSE 'pending' END AS status,
    CAST((SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O'
          AND o_orderpriority IN ('1-URGENT', '2-HIGH')) AS INTEGER) AS filings_count,
    CAST((SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
          AND o_orderpriority = '5-LOW') AS INTEGER) AS n_migrated,
    c_custkey, c_mktsegment
  FROM customer),
known AS (
  SELECT {_ONUM} AS company, CAST(o_orderkey AS VARCHAR) AS reference FROM orders
  WHERE (o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
     OR (o_orderstatus = 'F' AND o_orderpriority = '5-LOW'))"""


@register("target_companies", "WITH " + TARGETS_CTE + "\nSELECT * FROM tgt")
def q_target_companies(spark, sf_dir):
    return T.target_companies(AD.companies(spark, sf_dir), sector_codes=SECTOR, excluded_forms=EXCLUDED, main=MAIN)


@register("target_companies_flat", "WITH " + TARGETS_CTE + "\nSELECT * FROM tgt")
def q_target_companies_flat(spark, sf_dir):
    t = AD.register_tables(spark, sf_dir)
    return T.target_companies_flat(t["enterprise"], t["activity"], sector_codes=SECTOR, excluded_forms=EXCLUDED,
                                   main=MAIN)


@register("not_in_nullsafe", "WITH " + O.REGISTER_CTE + """
SELECT EnterpriseNumber, JuridicalForm FROM enterprise WHERE JuridicalForm IS NULL OR JuridicalForm NOT IN ('MACHINERY')""")
def q_not_in_nullsafe(spark, sf_dir):
    e = AD.register_tables(spark, sf_dir)["enterprise"]
    return e.filter(X.not_in_nullsafe(F.col("JuridicalForm"), EXCLUDED)).select("EnterpriseNumber", "JuridicalForm")


@register("deed_targets", "WITH " + TARGETS_CTE + """
SELECT * FROM tgt WHERE coalesce(trim(JuridicalForm), 'None') NOT IN ('FURNITURE')
  AND EnterpriseNumber IS NOT NULL AND EnterpriseNumber <> ''""")
def q_deed_targets(spark, sf_dir):
    tg = T.target_companies(AD.companies(spark, sf_dir), sector_codes=SECTOR, excluded_forms=EXCLUDED, main=MAIN)
    return T.deed_targets(tg, NO_DEED)


@register("seed_state", "WITH " + TARGETS_CTE + "," + DEPOSITS_CTE + """,
ex AS (SELECT _id, status, filings_count FROM ds WHERE filings_count > 0)
SELECT _id, status, filings_count, false AS _seeded FROM ex
UNION ALL
SELECT EnterpriseNumber, 'pending', 0, true FROM tgt WHERE EnterpriseNumber NOT IN (SELECT _id FROM ex)""")
def q_seed_state(spark, sf_dir):
    state = AD.deposit_state(spark, sf_dir).filter(F.col("filings_count") > 0)
    tg = T.target_companies(AD.companies(spark, sf_dir), sector_codes=SECTOR, excluded_forms=EXCLUDED, main=MAIN)
    return T.seed_state(state, tg).select("_id", "status", "filings_count", "_seeded")


def _w1_sql(n: int) -> str:
    return f"""
listing AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY company ORDER BY periodEndDate DESC NULLS LAST,
                                    depositDate DESC NULLS LAST, reference ASC NULLS LAST) AS INTEGER) AS listing_pos
  FROM deposits QUALIFY listing_pos <= {n})"""


@register("latest_deposits", "WITH " + DEPOSITS_CTE + "," + _w1_sql(5)
          + "\nSELECT company, reference, listing_pos FROM listing")
def q_latest_deposits(spark, sf_dir):
    return T.latest_deposits(AD.deposits(spark, sf_dir), 5).select("company", "reference", "listing_pos")


@register("eligible_deposits", "WITH " + DEPOSITS_CTE + "," + _w1_sql(20) + f"""
SELECT company, reference, listing_pos, CASE WHEN coalesce(migration, false) THEN 'migrated' ELSE 'fetch' END AS route
FROM listing l
WHERE periodEndDate IS NOT NULL AND periodEndDate <> '' AND periodEndDate >= '{SINCE}'
  AND NOT EXISTS (SELECT 1 FROM known k WHERE k.company = l.company AND k.reference = l.reference)""")
def q_eligible_deposits(spark, sf_dir):
    listing = T.latest_deposits(AD.deposits(spark, sf_dir), 20)
    return T.eligible_deposits(listing, AD.deposit_state(spark, sf_dir), SINCE).select(
        "company", "reference", "listing_pos", "route")


def _outcomes(spark, sf_dir):
    cust = AD.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    o = AD.table(spark, sf_dir, "orders")
    ref = F.col("o_orderkey").cast("string")
    lists = o.groupBy("o_custkey").agg(
        F.collect_list(F.when(F.col("o_orderstatus") == "P", ref)).alias("new_done"),
        F.collect_list(F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "4-NOT SPECIFIED"),
                              ref)).alias("new_migrated"))
    empty = F.array().cast("array<string>")
    return (cust.join(lists, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(AD.number_of(F.col("c_custkey")).alias("_id"),
                    F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("failure"))
                    .when(F.col("c_mktsegment") == "BUILDING", F.lit("rate_limited"))
                    .otherwise(F.lit("success")).alias("result"),
                    F.coalesce("new_done", empty).alias("new_done"),
                    F.coalesce("new_migrated", empty).alias("new_migrated")))


def _refs_sql(condition: str) -> str:
    """A customer's orders that meet a condition, as sorted text."""
    return f"coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) FILTER (WHERE {condition}), '')"


_DONE = "(o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))"
_MIGRATED = "(o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"
_STAYS = "c_mktsegment IN ('AUTOMOBILE', 'BUILDING')"


@register("state_apply", "WITH " + DEPOSITS_CTE + f""",
refs AS (SELECT c_custkey,
  {_refs_sql(f"{_DONE} OR (NOT {_STAYS} AND o_orderstatus = 'P')")} AS filings_done,
  {_refs_sql(f"{_MIGRATED} OR (NOT {_STAYS} AND o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED')")} AS filings_migrated
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey),""" + """
nw AS (SELECT c_custkey,
  CAST((SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS INTEGER) AS n_new,
  CAST((SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
        AND o_orderpriority = '4-NOT SPECIFIED') AS INTEGER) AS n_new_mig
  FROM customer)
SELECT _id,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'pending' ELSE 'done' END AS status,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN filings_count ELSE filings_count + n_new END AS filings_count,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN n_migrated ELSE n_migrated + n_new_mig END AS n_migrated,
  filings_done, filings_migrated
FROM ds JOIN nw USING (c_custkey) JOIN refs USING (c_custkey)""")
def q_state_apply(spark, sf_dir):
    new = T.state_apply(AD.deposit_state(spark, sf_dir), _outcomes(spark, sf_dir))
    return new.select("_id", "status", "filings_count", F.size("filings_migrated").alias("n_migrated"),
                      *[F.array_join(F.array_sort(c), ",").alias(c) for c in ("filings_done", "filings_migrated")])


@register("state_claim", "WITH " + DEPOSITS_CTE + """,
picked AS (SELECT _id FROM ds WHERE status = 'pending' ORDER BY _id LIMIT 100)
SELECT _id, CASE WHEN _id IN (SELECT _id FROM picked) THEN 'in_progress' ELSE status END AS status FROM ds""")
def q_state_claim(spark, sf_dir):
    return T.state_claim(AD.deposit_state(spark, sf_dir), 100).select("_id", "status")


@register("done_with_filings", f"""
SELECT {_NUM} AS _id, CAST((SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS INTEGER) AS filings_count
FROM customer WHERE c_acctbal >= 0 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def q_done_with_filings(spark, sf_dir):
    return T.done_with_filings(AD.download_state(spark, sf_dir)).select("_id", "filings_count")


@register("refs_difference", "WITH " + DEPOSITS_CTE + f""",
refs AS (SELECT c_custkey, {_refs_sql(f"NOT {_DONE}")} AS difference, {_refs_sql(_DONE)} AS done, {_refs_sql(_MIGRATED)} AS migrated
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)""" + """
SELECT _id,
  CAST((SELECT count(*) FROM orders WHERE o_custkey = c_custkey) - filings_count AS INTEGER) AS n_diff,
  CAST(filings_count + n_migrated AS INTEGER) AS n_append,
  difference, concat_ws(',', nullif(done, ''), nullif(migrated, '')) AS appended
FROM ds JOIN refs USING (c_custkey)""")
def q_refs_difference(spark, sf_dir):
    every = AD.download_state(spark, sf_dir).select("_id", F.col("filings_done").alias("all_refs"))
    st = AD.deposit_state(spark, sf_dir).join(every, "_id")
    lacking, appended = X.refs_difference("all_refs", "filings_done"), X.append_refs("filings_done", "filings_migrated")
    return st.select("_id", F.size(lacking).alias("n_diff"), F.size(appended).alias("n_append"),
                     F.array_join(F.array_sort(lacking), ",").alias("difference"), F.array_join(appended, ",").alias("appended"))
