"""Registered queries of the register -> silver chain (S1-S3, A5-A7, F7, F9,
J1-J3, O3, O5, X3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import silver as S
from ..session import checkpoint_dir
from ..sources import register as R
from ..sources import sinks
from . import adapters as AD
from . import oracle as O
from .registry import register
from .silver_run import LABEL_FIELDS, build_silver

W = "WITH " + O.REGISTER_CTE + "\n"


def _dict(spark, sf_dir):
    return S.code_dictionary(AD.register_tables(spark, sf_dir)["code"])


@register("code_dictionary", W + "SELECT category, code, label FROM dict")
def q_code_dictionary(spark, sf_dir):
    return _dict(spark, sf_dir)


@register("code_labels", W + "SELECT EnterpriseNumber, JuridicalForm, Status, JuridicalFormLabel, StatusLabel "
                             "FROM enterprise_l")
def q_code_labels(spark, sf_dir):
    t = AD.register_tables(spark, sf_dir)
    return S.with_code_labels(t["enterprise"], S.code_dictionary(t["code"]), LABEL_FIELDS).select(
        "EnterpriseNumber", "JuridicalForm", "Status", "JuridicalFormLabel", "StatusLabel")


@register("activity_labels", W + "SELECT EntityNumber, _seq, NaceVersion, NaceCode, NaceLabel FROM activity_l")
def q_activity_labels(spark, sf_dir):
    t = AD.register_tables(spark, sf_dir)
    return S.with_activity_labels(t["activity"], S.code_dictionary(t["code"])).select(
        "EntityNumber", "_seq", "NaceVersion", "NaceCode", "NaceLabel")


@register("dedup_activities", W + "SELECT EntityNumber, NaceCode, Classification, _seq FROM activity_d")
def q_dedup_activities(spark, sf_dir):
    t = AD.register_tables(spark, sf_dir)
    return S.dedup_activities(t["activity"]).select("EntityNumber", "NaceCode", "Classification", "_seq")


@register("first_per_key", """
SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def q_first_per_key(spark, sf_dir):
    o = AD.table(spark, sf_dir, "orders")
    return S.first_per_key(o, ["o_custkey", "o_orderpriority", "o_orderstatus"],
                           [F.col("o_orderdate").desc(), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey")


@register("registered_address", W + "SELECT EntityNumber, _seq, Zipcode FROM address "
                                     "WHERE coalesce(trim(TypeOfAddress), 'None') = 'REGO'")
def q_registered_address(spark, sf_dir):
    return S.registered_address(AD.register_tables(spark, sf_dir)["address"]).select("EntityNumber", "_seq", "Zipcode")


@register("official_name_first", W + """
SELECT EntityNumber AS EnterpriseNumber, Denomination, TypeOfDenomination,
       CAST(row_number() OVER (PARTITION BY EntityNumber
            ORDER BY CASE WHEN coalesce(ltrim(trim(TypeOfDenomination), '0'), 'None') = '1' THEN 0 ELSE 1 END, _seq) AS INTEGER) AS pos
FROM denomination""")
def q_official_name_first(spark, sf_dir):
    t = AD.register_tables(spark, sf_dir)
    nested = S.nest_children(t["enterprise"].select("EnterpriseNumber"),
                             {"denominations": (t["denomination"], "EntityNumber")})
    nested = nested.withColumn("denominations", S.official_name_first(F.col("denominations")))
    return nested.select("EnterpriseNumber", F.posexplode("denominations").alias("p", "d")).select(
        "EnterpriseNumber", F.col("d.Denomination").alias("Denomination"),
        F.col("d.TypeOfDenomination").alias("TypeOfDenomination"), (F.col("p") + 1).alias("pos"))


FLIP_SQL = W + f"""
SELECT 'enterprise' AS source, EnterpriseNumber AS id, _seq, StartDate AS start_raw, {O.flip_sql('StartDate')} AS start_date
FROM enterprise
UNION ALL SELECT 'branch', EnterpriseNumber, _seq, StartDate, {O.flip_sql('StartDate')} FROM branch
UNION ALL SELECT 'establishment', EnterpriseNumber, _seq, StartDate, {O.flip_sql('StartDate')} FROM establishment"""


@register("flip_date", FLIP_SQL)
def q_flip_date(spark, sf_dir):
    t = AD.register_tables(spark, sf_dir)
    parts = [t[name].select(F.lit(src).alias("source"), F.col("EnterpriseNumber").alias("id"), "_seq",
                            F.col("StartDate").alias("start_raw"), X.flip_date(F.col("StartDate")).alias("start_date"))
             for name, src in (("enterprise", "enterprise"), ("branch", "branch"),
                               ("establishment", "establishment"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


NEST_SQL = W + """
SELECT e.EnterpriseNumber,
       CAST(coalesce(a.n, 0) AS INTEGER) AS n_activities, a.first_code, a.last_seq,
       CAST(coalesce(d.n, 0) AS INTEGER) AS n_denominations, d.first_name,
       coalesce(a.items, '') AS activity_items, coalesce(d.items, '') AS denomination_items
FROM enterprise e
LEFT JOIN (SELECT EntityNumber, count(*) AS n, arg_min(NaceCode, _seq) AS first_code, max(_seq) AS last_seq,
                  string_agg(concat_ws('|', NaceVersion, NaceCode, Classification, _seq), ';' ORDER BY _seq) AS items
           FROM activity GROUP BY EntityNumber) a ON a.EntityNumber = e.EnterpriseNumber
LEFT JOIN (SELECT EntityNumber, count(*) AS n, arg_min(Denomination, _seq) AS first_name,
                  string_agg(concat_ws('|', TypeOfDenomination, Denomination, _seq), ';' ORDER BY _seq) AS items
           FROM denomination GROUP BY EntityNumber) d ON d.EntityNumber = e.EnterpriseNumber"""


@register("nest_children", NEST_SQL)
def q_nest_children(spark, sf_dir):
    t = AD.register_tables(spark, sf_dir)
    n = S.nest_children(t["enterprise"].select("EnterpriseNumber"),
                        {"activities": (t["activity"], "EntityNumber"),
                         "denominations": (t["denomination"], "EntityNumber")})
    return n.select("EnterpriseNumber", F.size("activities").alias("n_activities"),
                    X.first_element("activities")["NaceCode"].alias("first_code"),
                    F.try_element_at("activities", F.lit(-1))["_seq"].alias("last_seq"),
                    F.size("denominations").alias("n_denominations"),
                    X.first_element("denominations")["Denomination"].alias("first_name"),
                    F.array_join(F.transform("activities", lambda a: F.concat_ws("|", a["NaceVersion"], a["NaceCode"], a["Classification"], a["_seq"])), ";")
                    .alias("activity_items"),
                    F.array_join(F.transform("denominations", lambda d: F.concat_ws("|", d["TypeOfDenomination"], d["Denomination"], d["_seq"])), ";")
                    .alias("denomination_items"))


SILVER_SQL = W + f"""
SELECT e.EnterpriseNumber, {O.flip_sql('e.StartDate')} AS StartDate, e.StatusLabel, e.JuridicalFormLabel,
  CAST(coalesce(a.n, 0) AS INTEGER) AS n_activities, a.first_label, a.main_codes,
  CAST(coalesce(ad.n, 0) AS INTEGER) AS n_addresses, ad.first_zip,
  CAST(coalesce(b.n, 0) AS INTEGER) AS n_branches, b.first_start AS first_branch_start,
  CAST(coalesce(es.n, 0) AS INTEGER) AS n_establishments,
  CAST(coalesce(c.n, 0) AS INTEGER) AS n_contacts,
  d.first_name
FROM enterprise_l e
LEFT JOIN (SELECT EntityNumber, count(*) AS n, arg_min(NaceLabel, _seq) AS first_label,
                  coalesce(array_to_string(list_sort(list_distinct(list(NaceCode) FILTER (WHERE Classification = 'MAIN'))), ','), '') AS main_codes
           FROM activity_d GROUP BY EntityNumber) a ON a.EntityNumber = e.EnterpriseNumber
LEFT JOIN (SELECT EntityNumber, count(*) AS n, arg_min(Zipcode, _seq) AS first_zip FROM address
           WHERE coalesce(trim(TypeOfAddress), 'None') = 'REGO' GROUP BY EntityNumber) ad ON ad.EntityNumber = e.EnterpriseNumber
LEFT JOIN (SELECT EnterpriseNumber, count(*) AS n, arg_min({O.flip_sql('StartDate')}, _seq) AS first_start
           FROM branch GROUP BY EnterpriseNumber) b ON b.EnterpriseNumber = e.EnterpriseNumber
LEFT JOIN (SELECT EnterpriseNumber, count(*) AS n FROM establishment GROUP BY EnterpriseNumber) es
       ON es.EnterpriseNumber = e.EnterpriseNumber
LEFT JOIN (SELECT EntityNumber, count(*) AS n FROM contact GROUP BY EntityNumber) c ON c.EntityNumber = e.EnterpriseNumber
LEFT JOIN (SELECT EntityNumber, arg_min(Denomination,
                  (CASE WHEN coalesce(ltrim(trim(TypeOfDenomination), '0'), 'None') = '1' THEN 0 ELSE 1 END) * 1000000000000 + _seq) AS first_name
           FROM denomination GROUP BY EntityNumber) d ON d.EntityNumber = e.EnterpriseNumber"""


def flat_silver(silver):
    first = X.first_element
    return silver.select(
        "EnterpriseNumber", "StartDate", "StatusLabel", "JuridicalFormLabel",
        F.size("activities").alias("n_activities"), first("activities")["NaceLabel"].alias("first_label"),
        F.array_join(F.sort_array("main_sector_codes"), ",").alias("main_codes"),
        F.size("addresses").alias("n_addresses"), first("addresses")["Zipcode"].alias("first_zip"),
        F.size("branches").alias("n_branches"), first("branches")["StartDate"].alias("first_branch_start"),
        F.size("establishments").alias("n_establishments"), F.size("contacts").alias("n_contacts"),
        first("denominations")["Denomination"].alias("first_name"))


@register("silver_companies", SILVER_SQL)
def q_silver_companies(spark, sf_dir):
    return flat_silver(build_silver(AD.register_tables(spark, sf_dir)))


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"


def _write_register_csv(spark, sf_dir, folder):
    """Customer and orders written as register-style CSV folders."""
    for name in ("customer", "orders"):
        (AD.table(spark, sf_dir, name).write.option("header", "true")
         .option("quote", '"').option("escape", '"').csv(f"{folder}/{name}.csv"))


LOAD_SQL = """
SELECT 'customer' AS name, count(*) AS rows FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders"""


@register("load_register", LOAD_SQL)
def q_load_register(spark, sf_dir):
    folder = _scratch(spark)
    _write_register_csv(spark, sf_dir, folder)
    return R.table_counts(R.load_register(spark, folder))


def _write_texts_csv(docs, folder):
    """A register CSV folder of quoted texts, a file a task."""
    (docs.write.option("header", "true").option("quoteAll", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(folder))


@register("load_register_texts", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(nullif(text, '')) AS text_md5, CAST(length(nullif(text, '')) AS INT) AS chars, nullif(lang, '') AS lang FROM documents""")
def q_load_register_texts(spark, sf_dir):
    """S1 on a table whose quoted values are whole texts with line breaks: every
    value, read from files in many splits."""
    folder = _scratch(spark)
    _write_texts_csv(AD.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), f"{folder}/documents.csv")
    got = R.load_register(spark, folder, null_tokens=("",))["documents"]
    return got.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").alias("chars"), "lang")


NULL_TOKENS_SQL = """
SELECT CAST(count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> 'HOUSEHOLD') AS BIGINT) AS n_segment,
       CAST(count(*) AS BIGINT) AS n_rows FROM customer"""


@register("null_tokens", NULL_TOKENS_SQL)
def q_null_tokens(spark, sf_dir):
    """S3 with a custom token set: the segment HOUSEHOLD reads as null."""
    folder = _scratch(spark)
    _write_register_csv(spark, sf_dir, folder)
    tokens = ("", "HOUSEHOLD")
    cust = R.load_register(spark, folder, null_tokens=tokens)["customer"]
    return cust.agg(F.count("c_mktsegment").alias("n_segment"), F.count(F.lit(1)).alias("n_rows"))


@register("skip_if_loaded", "SELECT 'customer' AS name, 'kept' AS status UNION ALL SELECT 'orders', 'loaded'")
def q_skip_if_loaded(spark, sf_dir):
    folder = _scratch(spark)
    bronze = _scratch(spark)
    _write_register_csv(spark, sf_dir, folder)
    sinks.write_replace(AD.table(spark, sf_dir, "customer"), f"{bronze}/customer")
    status = R.load_missing(spark, folder, bronze)
    return spark.createDataFrame(sorted(status.items()), "name string, status string")
