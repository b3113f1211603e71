"""Registered queries of deeds, listings and progress events (S8, S12-S14,
F8, X22, X23, J9, J14, A9, A10, E1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import deeds as D
from ..sources import listings as L
from ..streaming import deed_status as DS
from . import adapters as AD
from . import oracle as O
from .filing_tree import write_listings
from .queries_silver import _scratch
from .registry import register

_OKEY = O.key_sql("o_custkey")
_CNUM = O.number_sql("c_custkey")

EV_CTE = """
ev AS (
  SELECT CASE event_type WHEN 'view' THEN 'downloading' WHEN 'purchase' THEN 'downloaded'
              WHEN 'error' THEN 'download_failed' WHEN 'click' THEN 'statutes_count'
              WHEN 'signup' THEN CASE WHEN value > 40 THEN 'error' ELSE 'done' END END AS event,
    CASE WHEN event_type IN ('view', 'purchase', 'error') THEN CAST(user_id AS VARCHAR) END AS documentId,
    CASE WHEN event_type IN ('view', 'purchase', 'error') THEN strftime(ts, '%Y-%m-%d') END AS deedDate,
    CASE WHEN event_type = 'view' THEN 'deed k' || CAST(CAST(props::JSON->>'k' AS INTEGER) AS VARCHAR) END AS description,
    CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') || '_'
         || CAST(event_id AS VARCHAR) || '.pdf' END AS filename,
    CASE WHEN event_type = 'purchase' THEN CAST(round(value * 1000) AS BIGINT) END AS sizeBytes,
    CASE WHEN event_type = 'signup' AND value <= 40 THEN CAST(floor(value) AS BIGINT) END AS total,
    CASE WHEN event_type = 'signup' AND value <= 40 THEN CAST(CAST(props::JSON->>'k' AS INTEGER) AS BIGINT) END AS downloaded,
    CASE WHEN event_type = 'signup' AND value > 40 THEN 'failed ' || CAST(user_id AS VARCHAR) END AS message,
    strftime(ts, '%Y-%m-%d') AS run, event_id AS seq
  FROM events),
ds AS (
  SELECT run, documentId,
    CASE WHEN max(CASE WHEN event = 'downloaded' THEN 1 ELSE 0 END) = 1 THEN 'downloaded' ELSE 'downloading' END AS status,
    arg_min_null(deedDate, seq) AS deedDate,
    coalesce(arg_min_null(description, seq), '') AS description,
    coalesce(arg_max_null(filename, seq) FILTER (WHERE event = 'downloaded'), '') AS filename,
    coalesce(arg_max_null(sizeBytes, seq) FILTER (WHERE event = 'downloaded'), 0) AS sizeBytes
  FROM ev WHERE event IN ('downloading', 'downloaded') AND documentId IS NOT NULL GROUP BY run, documentId)"""

DEED_STATUS_SQL = "WITH " + EV_CTE + "\nSELECT * FROM ds"


@register("deed_status", DEED_STATUS_SQL)
def q_deed_status(spark, sf_dir):
    return D.deed_status(AD.progress_events(spark, sf_dir))


@register("deed_status_stream", DEED_STATUS_SQL)
def q_deed_status_stream(spark, sf_dir):
    """Events written as JSON-lines files in random order, folded by a
    streaming query three files per micro-batch."""
    folder, table, ckpt = _scratch(spark), _scratch(spark), _scratch(spark)
    AD.progress_events(spark, sf_dir).repartition(6).write.json(folder)
    return DS.run_to_end(spark, folder, table, ckpt, max_files_per_trigger=3)


# A fifth of the runs have lost their name, another fifth has an empty one.
_ODD_RUNS = DEED_STATUS_SQL.replace("strftime(ts, '%Y-%m-%d') AS run", """CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 5 = 1 THEN ''
         ELSE strftime(ts, '%Y-%m-%d') END AS run""")


@register("deed_status_stream_odd_runs", _ODD_RUNS)
def q_deed_status_stream_odd_runs(spark, sf_dir):
    """E1 with null and empty runs, whose documents come in many micro-batches."""
    folder, table, ckpt = _scratch(spark), _scratch(spark), _scratch(spark)
    user = AD.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), (F.col("user_id") % 5).alias("fifth"))
    run = F.when(F.col("fifth") == 0, F.lit(None)).when(F.col("fifth") == 1, F.lit("")).otherwise(F.col("run"))
    AD.progress_events(spark, sf_dir).join(user, "seq").withColumn("run", run).drop("fifth").repartition(6).write.json(folder)
    return DS.run_to_end(spark, folder, table, ckpt, max_files_per_trigger=2)


@register("run_summary", "WITH " + EV_CTE + """,
r AS (SELECT run,
        arg_max_null(event, seq) FILTER (WHERE event IN ('done', 'error')) AS final,
        arg_max_null(total, seq) FILTER (WHERE event = 'done') AS total,
        arg_max_null(downloaded, seq) FILTER (WHERE event = 'done') AS downloaded,
        arg_max_null(message, seq) FILTER (WHERE event = 'error') AS error
      FROM ev GROUP BY run),
d AS (SELECT run, count(*) AS n_documents, count(*) FILTER (WHERE status = 'downloaded') AS n_downloaded
      FROM ds GROUP BY run)
SELECT r.run, coalesce(final, 'running') AS final, total, downloaded, error,
       coalesce(n_documents, 0) AS n_documents, coalesce(n_downloaded, 0) AS n_downloaded
FROM r LEFT JOIN d USING (run)""")
def q_run_summary(spark, sf_dir):
    return D.run_summary(AD.progress_events(spark, sf_dir))


@register("read_progress_events", "WITH " + EV_CTE + """
SELECT seq, event, documentId, run, sizeBytes FROM ev""")
def q_read_progress_events(spark, sf_dir):
    folder = _scratch(spark)
    AD.progress_events(spark, sf_dir).write.json(folder)
    return L.read_progress_events(spark, folder).select("seq", "event", "documentId", "run", "sizeBytes")


DEEDS_CTE = f"""
dd AS (
  SELECT {_OKEY} AS company_key, 'doc' || CAST(o_orderkey AS VARCHAR) AS documentId,
         CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') END AS deedDate,
         o_orderpriority AS deedNatureDecoded,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 'DONE' ELSE 'PENDING' END AS documentStatus,
         o_orderstatus, o_orderpriority, o_totalprice, o_custkey, o_orderkey
  FROM orders),
dn AS (
  SELECT *, company_key || '_' || coalesce(replace(deedDate, '-', ''), 'unknown') || '_' || documentId || '.pdf'
            AS filename FROM dd),
files AS (SELECT filename, CAST(floor(o_totalprice) AS BIGINT) AS size, company_key,
                 coalesce(replace(deedDate, '-', ''), 'unknown') AS deed_date, documentId AS doc_id
          FROM dn WHERE o_orderstatus = 'F'),
ns AS (SELECT {_CNUM} AS _id, {O.key_sql('c_custkey')} AS company_key,
              CASE WHEN c_acctbal >= 0 THEN 'done' ELSE 'pending' END AS status, c_custkey FROM customer)"""


@register("published_deeds", "WITH " + DEEDS_CTE + "\nSELECT company_key, documentId FROM dd WHERE documentStatus = 'DONE'")
def q_published_deeds(spark, sf_dir):
    return D.published_deeds(AD.deeds(spark, sf_dir)).select("company_key", "documentId")


@register("deed_filename", "WITH " + DEEDS_CTE + """
SELECT documentId, filename, split_part(replace(filename, '.pdf', ''), '_', 1) AS p_key,
       split_part(replace(filename, '.pdf', ''), '_', 2) AS p_date, split_part(replace(filename, '.pdf', ''), '_', 3) AS p_doc
FROM dn""")
def q_deed_filename(spark, sf_dir):
    d = D.with_deed_filename(AD.deeds(spark, sf_dir))
    p = X.parse_deed_filename(F.col("filename"))
    return d.select("documentId", "filename", p["company_key"].alias("p_key"), p["deed_date"].alias("p_date"),
                    p["doc_id"].alias("p_doc"))


@register("deed_manifest", "WITH " + DEEDS_CTE + "\nSELECT company_key, deed_date, doc_id, filename, size FROM files")
def q_deed_manifest(spark, sf_dir):
    return L.deed_manifest(AD.deed_files(spark, sf_dir))


@register("deeds_to_fetch", "WITH " + DEEDS_CTE + """
SELECT company_key, documentId, CASE WHEN o_orderstatus = 'F' THEN 'have_file' ELSE 'fetch' END AS route
FROM dn WHERE documentStatus = 'DONE' AND NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""")
def q_deeds_to_fetch(spark, sf_dir):
    r = D.deeds_to_fetch(AD.deeds(spark, sf_dir), AD.deed_state(spark, sf_dir),
                         L.deed_manifest(AD.deed_files(spark, sf_dir)))
    return r.select("company_key", "documentId", "route")


@register("cached_deeds", "WITH " + DEEDS_CTE + """,
c AS (SELECT ns._id, f.filename FROM ns JOIN files f ON f.company_key = ns.company_key WHERE ns.status = 'done')
SELECT _id, filename, count(*) OVER (PARTITION BY _id) AS files_count FROM c""")
def q_cached_deeds(spark, sf_dir):
    cached, _ = D.cached_deeds(AD.deed_state(spark, sf_dir), L.deed_manifest(AD.deed_files(spark, sf_dir)))
    return cached.select("_id", "filename", "files_count")


@register("deeds_left_to_fetch", "WITH " + DEEDS_CTE + "\nSELECT _id, company_key FROM ns WHERE status <> 'done'")
def q_deeds_left_to_fetch(spark, sf_dir):
    _, rest = D.cached_deeds(AD.deed_state(spark, sf_dir), L.deed_manifest(AD.deed_files(spark, sf_dir)))
    return rest


@register("read_deeds", "WITH " + DEEDS_CTE + """
SELECT company_key, documentId, deedDate, documentStatus FROM dd""")
def q_read_deeds(spark, sf_dir):
    """Listings written as JSON pages (one page per company and deed
    nature), read back and exploded."""
    folder = _scratch(spark)
    d = AD.deeds(spark, sf_dir)
    pages = d.groupBy("company_key", "deedNatureDecoded").agg(
        F.collect_list(F.struct("documentId", "deedDate", "deedNatureDecoded", "documentStatus")).alias("statutes"))
    totals = d.groupBy("company_key").agg(F.count(F.lit(1)).cast("int").alias("totalItems"))
    write_listings(pages.join(totals, "company_key").select("company_key", "statutes", "totalItems"), folder)
    return L.read_deeds(spark, folder).select("company_key", "documentId", "deedDate", "documentStatus")


@register("read_deposits", f"""
SELECT {_OKEY} AS company_key, CAST(o_orderkey AS VARCHAR) AS reference,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END
         AS periodEndDate,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS migration
FROM orders""")
def q_read_deposits(spark, sf_dir):
    """One listing document per company written as JSON, read back."""
    folder = _scratch(spark)
    dep = AD.deposits(spark, sf_dir).withColumn("company_key", F.translate("company", ".", ""))
    write_listings(dep.groupBy("company_key").agg(F.collect_list(F.struct(
        "reference", "periodEndDateYear", "id", "migration", "periodEndDate", "depositDate")).alias("content")), folder)
    return L.read_deposits(spark, folder).select("company_key", "reference", "periodEndDate", "migration")
