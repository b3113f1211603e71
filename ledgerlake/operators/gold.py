"""Gold: per-company accounts (A3, A4, J5, J6) and their progress state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X

YEAR_FIELDS = ("year", "filing_ref", "ca", "marge_brute", "ebit", "resultat_net", "tresorerie",
               "dettes_financieres", "fonds_propres", "capital_souscrit")
RATIO_FIELDS = ("marge_brute", "marge_nette", "roe", "liquidite", "endettement")

def _empty_refs():
    return F.array().cast("array<string>")


def company_numbers(state: DataFrame, id_col: str = "_id") -> DataFrame:
    """State table reduced to one written number per digits-only key.
    Several numbers with the same key: the smallest wins (stated
    tie-break).  Output: enterprise_key, enterprise_number."""
    return (state.select(X.company_key(F.col(id_col)).alias("enterprise_key"), F.col(id_col).alias("n"))
            .groupBy("enterprise_key").agg(F.min("n").alias("enterprise_number")))


def restore_company_number(df: DataFrame, state: DataFrame, id_col: str = "_id") -> DataFrame:
    """Add ``enterprise_number``: the number as written in the state
    table for the row's digits-only key, or the key itself when unmatched."""
    nums = company_numbers(state, id_col)
    return (df.join(nums, "enterprise_key", "left")
            .withColumn("enterprise_number", F.coalesce("enterprise_number", "enterprise_key")))


def year_struct() -> Column:
    """One element of ``years``: amounts + ratios struct (the stored shape)."""
    ratios = F.struct(*[F.col(c).alias(c) for c in RATIO_FIELDS])
    return F.struct(*[F.col(c) for c in YEAR_FIELDS], ratios.alias("ratios"))


def company_years(facts: DataFrame) -> DataFrame:
    """A3 (flat form): one row per filing with its position ``pos`` in the
    company's ascending year list (ties by filing_ref)."""
    from pyspark.sql import Window
    w = Window.partitionBy("enterprise_number").orderBy("year", "filing_ref")
    return facts.withColumn("pos", F.row_number().over(w))


def company_accounts(facts: DataFrame, as_of: Column, key: str = "enterprise_number") -> DataFrame:
    """A3 + A4 + O1: nested gold rows.

    enterprise_number, schema_type (layout of the latest year; ties take the
    smallest filing_ref), last_updated, years (ascending by year, then
    filing_ref; several filings of one year all stay).  ``facts`` must carry
    ``key``: the number as written (see restore_company_number), or the
    digits-only ``enterprise_key``, which the result then has in its place
    (one number a key, so the groups are the same; see numbered_accounts).

    One collect aggregate per company; the latest layout is read from the
    sorted array (first element of the greatest year), so no second
    (sort-based) aggregate over string values is needed.
    """
    ratios = F.struct(*[F.col(c).alias(c) for c in RATIO_FIELDS])
    elem = F.struct(*[F.col(c) for c in YEAR_FIELDS], ratios.alias("ratios"), F.col("schema_type").alias("_st"))
    agg = facts.groupBy(key).agg(F.array_sort(F.collect_list(elem)).alias("_y"))
    last_year = F.array_max(F.transform("_y", lambda y: y["year"]))
    latest = F.try_element_at(F.filter("_y", lambda y: y["year"] == last_year), F.lit(1))
    return agg.select(key, latest["_st"].alias("schema_type"),
                      as_of.cast("timestamp").alias("last_updated"),
                      F.transform("_y", lambda y: y.dropFields("_st")).alias("years"))


def numbered_accounts(facts: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """A3 + A4 + J6: nested gold rows of facts keyed by ``enterprise_key``.  The
    written number is joined to one row a company, not to every filing, and
    the join reuses the aggregation's partitioning."""
    accounts = restore_company_number(company_accounts(facts, as_of, "enterprise_key"), state)
    return accounts.select("enterprise_number", "schema_type", "last_updated", "years")


def incremental_targets(download_state: DataFrame, gold_state: DataFrame) -> DataFrame:
    """J5 (+F5): companies whose download is done with a non-empty list of
    filings and that have no gold state, or a done ref not yet processed.
    Output keeps the download-state columns."""
    done = download_state.filter((F.col("status") == "done")
                                 & (F.coalesce(F.size("filings_done"), F.lit(0)) > 0))
    gs = gold_state.select(F.col("_id"), F.col("processed_filings"), F.lit(True).alias("_has_gold"))
    joined = done.join(gs, "_id", "left")
    new_refs = F.size(X.refs_difference("filings_done", "processed_filings"))
    return (joined.filter(F.col("_has_gold").isNull() | (new_refs > 0))
            .drop("processed_filings", "_has_gold"))


def wanted_filings(targets: DataFrame) -> DataFrame:
    """enterprise_key, filing_ref of every done filing of the selected companies."""
    return targets.select(X.company_key(F.col("_id")).alias("enterprise_key"),
                          F.explode("filings_done").alias("filing_ref")).filter("filing_ref IS NOT NULL").distinct()


def gold_state_updates(targets: DataFrame, as_of: Column, seen: DataFrame | None = None) -> DataFrame:
    """New gold-state rows for every selected company (also those whose
    files gave no valid filing).

    ``seen`` (enterprise_key, filing_ref): the filings that the run could read.
    Only these are marked as processed, so a filing whose file has not
    landed yet makes its company a target again; without it all done filings are."""
    refs = F.coalesce("filings_done", _empty_refs())
    if seen is not None:
        got = seen.groupBy("enterprise_key").agg(F.collect_set("filing_ref").alias("_seen"))
        targets = (targets.withColumn("enterprise_key", X.company_key(F.col("_id")))
                   .join(got, "enterprise_key", "left"))
        refs = F.filter(refs, lambda r: F.array_contains(F.coalesce("_seen", _empty_refs()), r))
    return targets.select("_id", refs.alias("processed_filings"),
                          as_of.cast("timestamp").alias("last_processed"))


def latest_year(years: Column) -> Column:
    """Greatest year of a years array (null when empty)."""
    return F.array_max(F.transform(years, lambda y: y["year"]))


def years_desc(years: Column) -> Column:
    """O2: years array in descending order."""
    return F.sort_array(years, asc=False)
