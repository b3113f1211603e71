"""Registered queries of single column expressions and small sinks (X1,
X2, X4, X31, S5, S6, X33, S9, A7) and the three search paths apart (J11,
J12, J13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import search as SE
from ..sources import filings as S
from ..sources import register as R
from ..sources import sinks
from . import adapters as AD
from . import oracle as O
from .queries_search import LIMIT, SEARCH_SQL, SECTOR, query_batch
from .queries_silver import _scratch
from .registry import register

WS = X.PY_WHITESPACE


@register("normalize_company_number", """
WITH k AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), w, '0') AS raw
           FROM customer, (VALUES (8), (9), (10)) t(w)),
n AS (SELECT c_custkey, raw,
        CASE WHEN length(regexp_replace(raw, '[^0-9]', '', 'g')) IN (9, 10) THEN
          substr(lpad(regexp_replace(raw, '[^0-9]', '', 'g'), 10, '0'), 1, 4) || '.' ||
          substr(lpad(regexp_replace(raw, '[^0-9]', '', 'g'), 10, '0'), 5, 3) || '.' ||
          substr(lpad(regexp_replace(raw, '[^0-9]', '', 'g'), 10, '0'), 8, 3)
        ELSE raw END AS number FROM k)
SELECT c_custkey, raw, number, replace(number, '.', '') AS company_key FROM n""")
def q_normalize_company_number(spark, sf_dir):
    """X2 on numbers written with 8, 9 and 10 digits, then X1 back."""
    c = AD.table(spark, sf_dir, "customer").select("c_custkey")
    w = c.select("c_custkey", F.explode(F.array(F.lit(8), F.lit(9), F.lit(10))).alias("w"))
    raw = w.select("c_custkey", F.expr("lpad(CAST(c_custkey AS STRING), w, '0')").alias("raw"))
    n = raw.withColumn("number", X.normalize_company_number(F.col("raw")))
    return n.withColumn("company_key", X.company_key(F.col("number")))


@register("collapse_spaces", f"""
SELECT doc_id,
  regexp_replace(regexp_replace(text, '{WS}+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g') AS collapsed,
  regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS stripped
FROM documents""")
def q_collapse_spaces(spark, sf_dir):
    """X31 and X4 (Python-style strip) over the whole document texts."""
    d = AD.table(spark, sf_dir, "documents")
    return d.select("doc_id", X.collapse_spaces(F.col("text")).alias("collapsed"),
                    X.clean_code(F.col("text")).alias("stripped"))


@register("filing_path", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS filing_ref, CAST(o_orderkey AS VARCHAR) || '.csv' AS filename,
       '/' || {O.key_sql('o_custkey')} || '/hbb/' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_path,
       {O.key_sql('o_custkey')} AS enterprise_key, CAST(o_orderkey AS VARCHAR) AS parsed_ref
FROM orders""")
def q_filing_path(spark, sf_dir):
    """S6 + X33 build the path; S5 reads company and ref back from it."""
    o = AD.table(spark, sf_dir, "orders")
    key, ref = AD.key_of(F.col("o_custkey")), F.col("o_orderkey").cast("string")
    p = o.select(ref.alias("filing_ref"), X.csv_ref(ref).alias("filename"), X.filing_path(key, ref).alias("file_path"))
    return S.with_provenance(p.withColumnRenamed("filing_ref", "_r")).select(
        F.col("_r").alias("filing_ref"), "filename", "file_path", "enterprise_key",
        F.col("filing_ref").alias("parsed_ref"))


@register("write_replace", "SELECT c_custkey, c_mktsegment FROM customer")
def q_write_replace(spark, sf_dir):
    """A table written twice; readers see the second full content."""
    t = _scratch(spark)
    c = AD.table(spark, sf_dir, "customer")
    sinks.write_replace(c.select("c_custkey", F.lit("old").alias("c_mktsegment")), t)
    sinks.write_replace(c.select("c_custkey", "c_mktsegment"), t)
    return sinks.read_table(spark, t)


_COUNT_SQL = "WITH " + O.REGISTER_CTE + "\n" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS rows FROM {t}"
    for t in ("enterprise", "activity", "address", "branch", "contact", "denomination", "establishment", "code"))


@register("table_counts", _COUNT_SQL)
def q_table_counts(spark, sf_dir):
    """Rows per register table."""
    return R.table_counts(AD.register_tables(spark, sf_dir))


def _search_parts(spark, sf_dir):
    cands = AD.search_companies(spark, sf_dir).filter(SE.has_sector(F.col("activities"), SECTOR))
    q = SE.classify(query_batch(spark))
    return cands, q, SE._names(cands)


_SQL_HEAD = SEARCH_SQL.split("allh AS")[0].rstrip().rstrip(",")


def _ranked(src: str) -> str:
    return (_SQL_HEAD + f"""
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY EnterpriseNumber) AS INTEGER) AS rank,
       EnterpriseNumber FROM {src} QUALIFY rank <= 50""")


@register("search_by_name", _ranked("tokhits"))
def q_search_by_name(spark, sf_dir):
    cands, q, names = _search_parts(spark, sf_dir)
    return SE.rank_limit(SE.token_hits(names, q, LIMIT), LIMIT).select("query_id", "rank", "EnterpriseNumber")


@register("search_by_number", _ranked("numhits"))
def q_search_by_number(spark, sf_dir):
    cands, q, names = _search_parts(spark, sf_dir)
    return SE.rank_limit(SE.number_hits(cands, q), LIMIT).select("query_id", "rank", "EnterpriseNumber")


@register("search_fallback_regex", _SQL_HEAD.replace(
    "AND query_id NOT IN (SELECT query_id FROM tokhits)", "") + """
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY EnterpriseNumber) AS INTEGER) AS rank,
       EnterpriseNumber FROM rxhits QUALIFY rank <= 50""")
def q_search_fallback_regex(spark, sf_dir):
    """J12 for every name query (not only those without token hits)."""
    cands, q, names = _search_parts(spark, sf_dir)
    return SE.rank_limit(SE.regex_hits(names, q.filter(F.col("kind") == "name")), LIMIT).select(
        "query_id", "rank", "EnterpriseNumber")
