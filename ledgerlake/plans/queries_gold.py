"""Registered queries of the accounts chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import AMOUNT_CODES
from ..operators import accounts as A
from . import adapters as AD
from . import oracle as O
from .registry import register

_LAYOUT_SQL = ("CASE WHEN model_code IS NULL THEN NULL WHEN regexp_matches(model_code, '(?i)f') THEN 0 "
               "WHEN regexp_matches(model_code, '(?i)[av]') THEN 1 "
               "WHEN regexp_matches(model_code, '(?i)m') THEN 2 ELSE 0 END")

PIVOT_SQL = ("WITH " + O.FILING_LINES_CTE + "," + O.WIDE_CTE + "\n"
             "SELECT enterprise_key, filing_ref, file_path, CAST(period_end_ts AS DATE) AS period_end_date, "
             f"CAST({_LAYOUT_SQL} AS INTEGER) AS layout, "
             + ", ".join(O.amount_column(c) for c in AMOUNT_CODES) + " FROM wide")


@register("pivot_accounts", PIVOT_SQL)
def q_pivot_accounts(spark, sf_dir):
    return A.pivot_accounts(AD.filing_lines(spark, sf_dir))


FACTS_SQL = O.FACTS_WITH + "\nSELECT * FROM facts"


@register("financial_facts", FACTS_SQL)
def q_financial_facts(spark, sf_dir):
    return A.facts_from_lines(AD.filing_lines(spark, sf_dir))


VALID_PERIOD_SQL = f"""
WITH {O.FILING_LINES_CTE}
SELECT enterprise_key, filing_ref, value AS period_end_text,
       CAST(year(TRY_STRPTIME(value, '%Y-%m-%d')) AS INTEGER) AS year
FROM lines WHERE code = 'Accounting period end date' AND TRY_STRPTIME(value, '%Y-%m-%d') IS NOT NULL"""


@register("valid_period", VALID_PERIOD_SQL)
def q_valid_period(spark, sf_dir):
    lines = AD.filing_lines(spark, sf_dir)
    dates = lines.filter(F.col("code") == "Accounting period end date").select(
        "enterprise_key", "filing_ref", F.col("value").alias("period_end_text"))
    return A.valid_period(dates, "period_end_text")


# ------------------------------------------------------------------ gold
from ..operators import gold as G  # noqa: E402
from ..sources import sinks  # noqa: E402
from .gold_run import recompute_gold  # noqa: E402

_NUM = O.number_sql("c_custkey")
_KEY = O.key_sql("c_custkey")
AS_OF_SQL = f"TIMESTAMP '{AD.AS_OF}'"

RESTORED_CTE = f"""
done_numbers AS (SELECT {_NUM} AS _id, {_KEY} AS enterprise_key FROM customer WHERE c_acctbal >= 0),
f AS (SELECT facts.*, coalesce(d._id, facts.enterprise_key) AS enterprise_number
      FROM facts LEFT JOIN done_numbers d ON d.enterprise_key = facts.enterprise_key)"""

TARGETS_CTE = f"""
targets AS (
  SELECT {_NUM} AS _id, {_KEY} AS enterprise_key,
         CAST((SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS INTEGER) AS filings_count
  FROM customer
  WHERE c_acctbal >= 0 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
    AND (c_mktsegment = 'BUILDING'
         OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')))"""


# Every amount of a year entry, in cents ('-' for null).
_ENTRY = ("ca", "marge_brute", "ebit", "resultat_net", "tresorerie", "dettes_financieres", "fonds_propres", "capital_souscrit")
_cents_sql = ", ".join(f"coalesce(CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR), '-')" for c in _ENTRY)


def _accounts_flat_sql(where: str = "") -> str:
    return (O.FACTS_WITH + "," + RESTORED_CTE + "," + TARGETS_CTE + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY enterprise_number ORDER BY year, filing_ref) AS rn,
             first_value(schema_type) OVER (PARTITION BY enterprise_number ORDER BY year DESC, filing_ref ASC
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS st
      FROM f {where})
SELECT enterprise_number, any_value(st) AS schema_type, {AS_OF_SQL} AS last_updated,
       CAST(count(*) AS INTEGER) AS n_years, min(year) AS first_year, max(year) AS last_year,
       arg_min(filing_ref, rn) AS first_ref, arg_max(filing_ref, rn) AS last_ref,
       max(ca) AS max_ca, min(ratio_roe) AS min_roe,
       string_agg(concat_ws(':', year, filing_ref, {_cents_sql}), ',' ORDER BY rn) AS entries
FROM (SELECT *, roe AS ratio_roe FROM r) GROUP BY enterprise_number""")


def flat_accounts(acc):
    """Nested gold rows -> one checkable row per company."""
    y = F.col("years")
    return acc.select(
        "enterprise_number", "schema_type", "last_updated",
        F.size(y).alias("n_years"),
        y[0]["year"].alias("first_year"),
        G.latest_year(y).alias("last_year"),
        y[0]["filing_ref"].alias("first_ref"),
        F.element_at(y, -1)["filing_ref"].alias("last_ref"),
        F.array_max(F.transform(y, lambda e: e["ca"])).alias("max_ca"),
        F.array_min(F.filter(F.transform(y, lambda e: e["ratios"]["roe"]), lambda r: r.isNotNull()))
        .alias("min_roe"),
        F.array_join(F.transform(y, lambda e: F.concat_ws(":", e["year"], e["filing_ref"], *[
            F.coalesce(F.round(e[c] * 100).cast("bigint").cast("string"), F.lit("-")) for c in _ENTRY])), ",").alias("entries"),
    )


def _numbered_accounts(spark, sf_dir):
    ds = AD.download_state(spark, sf_dir).filter(F.col("status") == "done")
    return G.numbered_accounts(A.facts_from_lines(AD.filing_lines(spark, sf_dir)), ds, AD.as_of())


def _restored_facts(spark, sf_dir):
    facts = A.facts_from_lines(AD.filing_lines(spark, sf_dir))
    ds = AD.download_state(spark, sf_dir).filter(F.col("status") == "done")
    return G.restore_company_number(facts, ds)


RESTORE_SQL = (O.FACTS_WITH + "," + RESTORED_CTE
               + "\nSELECT enterprise_key, filing_ref, enterprise_number FROM f")


@register("restore_company_number", RESTORE_SQL)
def q_restore_company_number(spark, sf_dir):
    return _restored_facts(spark, sf_dir).select("enterprise_key", "filing_ref", "enterprise_number")


COMPANY_YEARS_SQL = (O.FACTS_WITH + "," + RESTORED_CTE + """
SELECT enterprise_number, year, filing_ref,
       CAST(row_number() OVER (PARTITION BY enterprise_number ORDER BY year, filing_ref) AS INTEGER) AS pos,
       ca, marge_brute, resultat_net, roe
FROM f""")


@register("company_years", COMPANY_YEARS_SQL)
def q_company_years(spark, sf_dir):
    return G.company_years(_restored_facts(spark, sf_dir)).select(
        "enterprise_number", "year", "filing_ref", "pos", "ca", "marge_brute", "resultat_net", "roe")


@register("company_accounts", _accounts_flat_sql())
def q_company_accounts(spark, sf_dir):
    return flat_accounts(_numbered_accounts(spark, sf_dir))


LATEST_SCHEMA_SQL = (O.FACTS_WITH + "," + RESTORED_CTE + """
SELECT DISTINCT enterprise_number,
  first_value(schema_type) OVER (PARTITION BY enterprise_number ORDER BY year DESC, filing_ref ASC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS schema_type
FROM f""")


@register("latest_schema", LATEST_SCHEMA_SQL)
def q_latest_schema(spark, sf_dir):
    return _numbered_accounts(spark, sf_dir).select("enterprise_number", "schema_type")


INCREMENTAL_TARGETS_SQL = "WITH " + TARGETS_CTE + "\nSELECT _id, filings_count FROM targets"


@register("incremental_targets", INCREMENTAL_TARGETS_SQL)
def q_incremental_targets(spark, sf_dir):
    return G.incremental_targets(AD.download_state(spark, sf_dir), AD.gold_state(spark, sf_dir)).select(
        "_id", "filings_count")


UPSERT_GOLD_STATE_SQL = "WITH " + TARGETS_CTE + f""",
gs AS (SELECT {_NUM} AS _id,
              (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'O') AS n,
              coalesce((SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) FROM orders
                        WHERE o_custkey = c_custkey AND o_orderstatus <> 'O'), '') AS refs
       FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT _id, CAST(n AS INTEGER) AS n_processed, TIMESTAMP '2024-01-01 00:00:00' AS last_processed, refs
FROM gs WHERE _id NOT IN (SELECT _id FROM targets)
UNION ALL
SELECT _id, filings_count, {AS_OF_SQL},
       (SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) FROM orders WHERE {_NUM.replace('c_custkey', 'o_custkey')} = _id)
FROM targets"""


@register("upsert_gold_state", UPSERT_GOLD_STATE_SQL)
def q_upsert_gold_state(spark, sf_dir):
    ds, gs = AD.download_state(spark, sf_dir), AD.gold_state(spark, sf_dir)
    targets = G.incremental_targets(ds, gs)
    new_state = sinks.upsert(gs, G.gold_state_updates(targets, AD.as_of()), "_id")
    return new_state.select("_id", F.size("processed_filings").alias("n_processed"), "last_processed",
                            F.array_join(F.array_sort("processed_filings"), ",").alias("refs"))


@register("incremental_gold", _accounts_flat_sql("WHERE enterprise_key IN (SELECT enterprise_key FROM targets)"))
def q_incremental_gold(spark, sf_dir):
    new_gold, _, _ = recompute_gold(AD.filing_lines(spark, sf_dir), AD.download_state(spark, sf_dir),
                                    AD.gold_state(spark, sf_dir), None, AD.as_of())
    return flat_accounts(new_gold)


UPSERT_SQL = """
WITH changes AS (
  SELECT c_custkey, upper(c_name) AS c_name, c_acctbal + 100.0 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_acctbal, 'NEW' FROM supplier)
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM changes)
UNION ALL SELECT * FROM changes"""


@register("upsert_gold", UPSERT_SQL)
def q_upsert(spark, sf_dir):
    cust = AD.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    changed = cust.filter(F.col("c_mktsegment") == "MACHINERY").select(
        "c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 100.0).alias("c_acctbal"),
        "c_mktsegment")
    new = AD.table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit("NEW").alias("c_mktsegment"))
    return sinks.upsert(cust, changed.unionByName(new), "c_custkey")
