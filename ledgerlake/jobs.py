"""Batch and streaming jobs, one per stage of the pipeline.

    spark-submit -m ledgerlake.jobs <stage> --root <lake> [options]

Every table lives under the lake root as a snapshot table
(``sources.sinks``):

    bronze/<name>        register tables (S1-S3)
    silver/companies     cleaned companies with six child arrays
    state/download       deposit progress state (J4 seeded from F1 targets)
    state/gold           processed filings per company (S11)
    gold/accounts        per-company accounts (A3/A4)
    lines/compacted      filing lines as Parquet, bucketed by company
    deposits/todo        deposits that need work, with their route (W1, F4, J9)
    deposits/listed      companies that have a listing
    directors/cache      office holders per company (P1, J10)
    index/names          segments of postings of company names
    search/answers       answers to a batch of queries (J11-J13, O4)
    profiles             company profiles (J7)
    state/deeds          deed progress state (J4 seeded from F3 targets)
    deeds/todo           published deeds not yet done, with their route (F8, J9)
    deeds/listed         companies that have a listing of deeds
    deeds/cached, left   files of companies whose deeds are done (J14), and the other companies
    deeds/summary        outcome of each download run (A10)

A deposit run is: targets, deposits, claim, (the files land), apply, check,
then gold.  A deed run is: deed-targets, deeds, deeds-claim, (the files land), deeds-apply,
deeds-cached.  Stages only declare DataFrame plans and write them; no data goes through
the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .constants import EXCLUDED_FORMS, HOTEL_NACE_CODES, STATE_DONE, STATE_IN_PROGRESS, STATE_PENDING
from .functions import expr as X
from .operators import checks as C
from .operators import deeds as D
from .operators import gold as G
from .operators import name_index as NI
from .operators import pages as P
from .operators import search as SE
from .operators import targets as T
from .operators import views as V
from .plans.gold_run import run_gold
from .plans.silver_run import build_silver
from .session import build_session
from .sources import filings as S
from .sources import listings as L
from .sources import register as R
from .sources import sinks
from .streaming.deed_status import start_deed_status_stream
from .streaming.incremental_gold import start_incremental_gold

STATE_SCHEMA = ("_id string, status string, filings_count int, filings_done array<string>, "
                "filings_migrated array<string>")
DEED_STATE_SCHEMA = "_id string, status string, acts_count int, acts_done array<string>"
TODO_SCHEMA = "company string, reference string, route string"
DIRECTORS_CACHE_SCHEMA = "_id string, directors array<struct<role:string,name:string,start_date:string>>, scraped_at timestamp"
REGISTER_CHILDREN = ("activity", "address", "branch", "code", "contact", "denomination", "enterprise",
                     "establishment")


def table(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def bronze(spark: SparkSession, root: str, register_dir: str) -> dict:
    """Load every register CSV not loaded yet."""
    return R.load_missing(spark, register_dir, table(root, "bronze"))


def silver(spark: SparkSession, root: str) -> str:
    """Bronze register tables -> silver companies (full rewrite, S9)."""
    tables = {name: sinks.read_table(spark, table(root, "bronze", name)) for name in REGISTER_CHILDREN}
    missing = [n for n, df in tables.items() if df is None]
    if missing:
        raise RuntimeError(f"bronze tables missing: {missing}")
    return sinks.write_replace(build_silver(tables), table(root, "silver", "companies"))


def targets(spark: SparkSession, root: str, sector_codes=HOTEL_NACE_CODES, excluded_forms=EXCLUDED_FORMS) -> str:
    """F1 + J4: seed the download state with new target companies."""
    companies = sinks.read_table(spark, table(root, "silver", "companies"))
    state = sinks.read_table(spark, table(root, "state", "download"), STATE_SCHEMA)
    tg = T.target_companies(companies, sector_codes=sector_codes, excluded_forms=excluded_forms)
    return sinks.write_replace(T.seed_state(state, tg).drop("_seeded"), table(root, "state", "download"))


def _state(spark: SparkSession, root: str):
    """The download state and the path of its current snapshot."""
    path = table(root, "state", "download")
    return sinks.current_snapshot(spark, path), sinks.read_table(spark, path, STATE_SCHEMA)


def deposits(spark: SparkSession, root: str, listings: str, per_company: int) -> str:
    """W1 + F4 + J9: of each company's ``per_company`` latest deposits those that
    need work.  ``listings`` holds a folder of JSON listings a company."""
    _, state = _state(spark, root)
    listed = L.read_deposits(spark, f"{listings}/*").withColumnRenamed("company_key", "enterprise_key")
    own = listed.join(G.company_numbers(state), "enterprise_key").withColumnRenamed("enterprise_number", "company")
    todo = T.eligible_deposits(T.latest_deposits(own, per_company), state, position="listing_pos")
    # companies that have a listing, be it an empty one: only these can be done
    sinks.write_replace(L.listed_companies(spark, f"{listings}/*"), table(root, "deposits", "listed"))
    return sinks.write_replace(todo.select("company", "reference", "route"), table(root, "deposits", "todo"))


def claim(spark: SparkSession, root: str, n: int) -> str:
    """The first ``n`` pending companies become in_progress; rows left so by
    an earlier run go back to pending first."""
    snapshot, state = _state(spark, root)
    return sinks.write_replace(T.state_claim(T.reset_stale(state), n), table(root, "state", "download"), expected=snapshot)


def apply(spark: SparkSession, root: str, landed: str) -> str:
    """Outcomes of the claimed companies.  A company succeeds when it has a
    listing and every deposit to fetch has landed; then its refs are done (or migrated)."""
    listed = sinks.read_table(spark, table(root, "deposits", "listed"))
    if listed is None:
        raise RuntimeError("no deposits/listed: run the deposits stage first")
    snapshot, state = _state(spark, root)
    claimed = state.filter(F.col("status") == STATE_IN_PROGRESS).select(F.col("_id"), X.company_key(F.col("_id")).alias("enterprise_key"))
    todo = sinks.read_table(spark, table(root, "deposits", "todo"), TODO_SCHEMA)
    files = S.list_landed_files(spark, landed, claimed).select("enterprise_key", "filename", F.lit(True).alias("_landed"))
    work = (claimed.join(todo, F.col("_id") == F.col("company")).withColumn("filename", X.csv_ref(F.col("reference")))
            .join(files.distinct(), ["enterprise_key", "filename"], "left"))
    fetch = F.col("route") == "fetch"
    found = work.groupBy("_id").agg(
        F.collect_list(F.when(fetch, F.col("reference"))).alias("new_done"),
        F.collect_list(F.when(~fetch, F.col("reference"))).alias("new_migrated"),
        F.max((fetch & F.col("_landed").isNull()).cast("int")).alias("_lacking"))
    none = F.array().cast("array<string>")
    listed = listed.select(F.col("company_key").alias("enterprise_key"), F.lit(True).alias("_listed"))
    outcomes = claimed.join(listed, "enterprise_key", "left").join(found, "_id", "left").select(
        "_id", F.when(F.col("_listed").isNull() | (F.coalesce("_lacking", F.lit(0)) > 0), F.lit("failure")).otherwise(F.lit("success")).alias("result"),
        F.coalesce("new_done", none).alias("new_done"), F.coalesce("new_migrated", none).alias("new_migrated"))
    return sinks.write_replace(T.state_apply(state, outcomes), table(root, "state", "download"), expected=snapshot)


def check(spark: SparkSession, root: str, landed: str) -> str:
    """Companies that lack files of done refs go back to pending, and
    those refs are no longer done, so that the next run fetches them."""
    snapshot, state = _state(spark, root)
    expected = state.filter(F.size("filings_done") > 0).select(X.company_key(F.col("_id")).alias("enterprise_key"))
    found = C.missing_files(state, S.list_landed_files(spark, landed, expected))
    lost = F.transform("missing", lambda f: F.regexp_replace(f, "[.]csv$", ""))
    kept = F.when(F.size("missing") > 0, F.array_except("filings_done", lost)).otherwise(F.col("filings_done"))
    out = found.withColumns({"status": F.col("status_after"), "filings_done": kept})
    return sinks.write_replace(out.select(*state.columns), table(root, "state", "download"), expected=snapshot)


def directors(spark: SparkSession, root: str, pages: str) -> str:
    """P1 + J10: captured pages ``{company key}.html`` of target companies not
    yet cached -> the directors cache."""
    _, state = _state(spark, root)
    path = table(root, "directors", "cache")
    cache = sinks.read_table(spark, path, DIRECTORS_CACHE_SCHEMA)
    todo = P.directors_to_fetch(state.select("_id"), cache).withColumn("enterprise_key", X.company_key(F.col("_id")))
    texts = spark.read.text(pages, wholetext=True, pathGlobFilter="*.html").select(
        F.regexp_extract("_metadata.file_name", "^(.+)[.]html$", 1).alias("enterprise_key"), F.col("value").alias("html"))
    captured = texts.join(todo, "enterprise_key").select(F.col("_id").alias("company"), "html")
    fetched = P.directors_cache_rows(P.extract_directors(captured), captured.select(F.col("company").alias("_id")), F.current_timestamp())
    return sinks.write_replace(P.update_directors_cache(cache, fetched), path)


def index(spark: SparkSession, root: str, buckets: int = 64, most_segments: int = 8) -> None:
    """The index of company names for the search stage: built once, then a segment of the companies whose names
    changed, and a merge when there are more than ``most_segments``."""
    companies, path = sinks.read_table(spark, table(root, "silver", "companies")), table(root, "index", "names")
    if not NI.live_segments(spark, path):
        NI.build_name_index(companies, path, buckets)
    elif NI.update_name_index(companies, path) and len(NI.live_segments(spark, path)) > most_segments:
        NI.merge_name_index(spark, path)


def search(spark: SparkSession, root: str, queries: str, limit: int = 50) -> str:
    """Answers to the JSON lines (query_id, q) under ``queries``, by the name index."""
    companies = sinks.read_table(spark, table(root, "silver", "companies"))
    batch = spark.read.schema("query_id long, q string").json(queries)
    return sinks.write_replace(SE.search_indexed(companies, table(root, "index", "names"), batch, limit=limit), table(root, "search", "answers"))


def profiles(spark: SparkSession, root: str) -> str:
    """Silver companies with their gold accounts, as a stored table."""
    companies, accounts = (sinks.read_table(spark, table(root, *t)) for t in (("silver", "companies"), ("gold", "accounts")))
    if companies is None or accounts is None:
        raise RuntimeError("profiles needs silver/companies and gold/accounts: run the silver and gold stages first")
    return sinks.write_replace(V.company_profile(companies, accounts), table(root, "profiles"))


def gold_stream(spark: SparkSession, root: str, landed: str, available_now: bool, buckets: int = 64):
    """E2 stream: landed files of companies whose download is done -> gold and
    gold state.  The download state is read in each micro-batch, and a change of it starts one."""
    path = table(root, "state", "download")
    return start_incremental_gold(spark, landed, lambda: T.done_with_filings(_state(spark, root)[1]), table(root, "gold", "stream"), table(root, "lines", "stream"),
                                  table(root, "gold", "_checkpoint"), available_now=available_now, buckets=buckets, done_only=True,
                                  gold_state_table=table(root, "state", "gold_stream"), state_table=path)


def compact(spark: SparkSession, root: str, landed: str, buckets: int = 64) -> None:
    """Landed CSV tree -> compacted Parquet lines (full rebuild)."""
    S.compact_filing_lines(spark, landed, table(root, "lines", "compacted"), buckets)


def gold(spark: SparkSession, root: str, landed: str, use_compacted: bool = False) -> dict:
    """E2 batch: recompute companies with new filings."""
    state = sinks.read_table(spark, table(root, "state", "download"), STATE_SCHEMA)
    return run_gold(spark, landed, state, table(root, "state", "gold"), table(root, "gold", "accounts"),
                    F.current_timestamp(), compacted=table(root, "lines", "compacted") if use_compacted else None)


def deed_targets(spark: SparkSession, root: str, sector_codes=HOTEL_NACE_CODES, excluded_forms=EXCLUDED_FORMS) -> str:
    """F3 + J4: seed the deed state with new target companies that may have deeds."""
    companies, path = sinks.read_table(spark, table(root, "silver", "companies")), table(root, "state", "deeds")
    tg = T.deed_targets(companies, sector_codes=sector_codes, excluded_forms=excluded_forms).withColumnRenamed("EnterpriseNumber", "_id")
    defaults = {"status": STATE_PENDING, "acts_count": 0, "acts_done": F.array().cast("array<string>")}
    return sinks.write_replace(sinks.seed_missing(sinks.read_table(spark, path, DEED_STATE_SCHEMA), tg, defaults), path)


def _deed_state(spark: SparkSession, root: str):
    path = table(root, "state", "deeds")
    return sinks.current_snapshot(spark, path), sinks.read_table(spark, path, DEED_STATE_SCHEMA)


def _manifest(spark: SparkSession, files: str):
    return L.deed_manifest(L.list_deed_files(spark, files))


def deeds(spark: SparkSession, root: str, listings: str, files: str) -> str:
    """F8 + J9: published deeds of the target companies that are not done, and whether their file is there
    already.  ``listings`` holds a folder of JSON pages a company, ``files`` the PDFs."""
    _, state = _deed_state(spark, root)
    own = L.read_deeds(spark, f"{listings}/*").join(state.select(X.company_key(F.col("_id")).alias("company_key")), "company_key", "left_semi")
    todo = D.deeds_to_fetch(own, state, _manifest(spark, files)).select("company_key", "documentId", "filename", "route").distinct()
    sinks.write_replace(L.listed_companies(spark, f"{listings}/*"), table(root, "deeds", "listed"))
    return sinks.write_replace(todo, table(root, "deeds", "todo"))


def deeds_claim(spark: SparkSession, root: str, n: int) -> str:
    """E4 for deeds: the first ``n`` pending companies become in_progress."""
    snapshot, state = _deed_state(spark, root)
    return sinks.write_replace(T.state_claim(T.reset_stale(state), n), table(root, "state", "deeds"), expected=snapshot)


def deeds_apply(spark: SparkSession, root: str, files: str) -> str:
    """Outcomes of the claimed companies: deeds whose file landed are done.  A company is done when it has a
    listing and lacks no file; otherwise it is pending again."""
    listed, todo = (sinks.read_table(spark, table(root, "deeds", x)) for x in ("listed", "todo"))
    if listed is None or todo is None:
        raise RuntimeError("no deeds/todo: run the deeds stage first")
    snapshot, state = _deed_state(spark, root)
    claimed = state.filter(F.col("status") == STATE_IN_PROGRESS).select("_id", X.company_key(F.col("_id")).alias("company_key"))
    landed = _manifest(spark, files).select("filename").distinct().withColumn("_landed", F.lit(True))
    found = claimed.join(todo, "company_key").join(landed, "filename", "left").groupBy("_id").agg(
        F.collect_set(F.when(F.col("_landed"), F.col("documentId"))).alias("_new"), F.bool_or(F.col("_landed").isNull()).alias("_lacking"))
    outcomes = (claimed.join(listed.withColumn("_listed", F.lit(True)), "company_key", "left").join(found, "_id", "left")
                .select("_id", "_new", (F.col("_listed").isNotNull() & ~F.coalesce("_lacking", F.lit(False))).alias("_complete")))
    done = F.array_union("acts_done", F.array_sort(F.coalesce("_new", F.array().cast("array<string>"))))
    status = F.when(F.col("_complete"), F.lit(STATE_DONE)).when(~F.col("_complete"), F.lit(STATE_PENDING)).otherwise(F.col("status"))
    out = state.join(outcomes, "_id", "left").withColumns({"status": status, "acts_done": done}).withColumn("acts_count", F.size("acts_done"))
    return sinks.write_replace(out.select(*state.columns), table(root, "state", "deeds"), expected=snapshot)


def deeds_cached(spark: SparkSession, root: str, files: str) -> str:
    """The files of companies whose deeds are done; the other companies are left to fetch."""
    cached, left = D.cached_deeds(_deed_state(spark, root)[1], _manifest(spark, files))
    sinks.write_replace(left, table(root, "deeds", "left"))
    return sinks.write_replace(cached, table(root, "deeds", "cached"))


def deeds_summary(spark: SparkSession, root: str, events: str) -> str:
    """A10: the outcome of each run of progress events."""
    return sinks.write_replace(D.run_summary(L.read_progress_events(spark, events)), table(root, "deeds", "summary"))


def deeds_stream(spark: SparkSession, root: str, events: str, available_now: bool):
    """Progress events -> running deed table."""
    return start_deed_status_stream(spark, events, table(root, "deeds", "status"),
                                    table(root, "deeds", "_checkpoint"), available_now)


#: Arguments that a stage cannot do without.
REQUIRED = {"bronze": ("register_dir",), "deposits": ("listings", "per_company"), "claim": ("claim",), "apply": ("landed",), "check": ("landed",),
            "compact": ("landed",), "gold": ("landed",), "gold-stream": ("landed",), "directors": ("pages",), "search": ("queries",), "deeds-stream": ("events",),
            "deeds": ("listings", "files"), "deeds-claim": ("claim",), "deeds-apply": ("files",), "deeds-cached": ("files",), "deeds-summary": ("events",)}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="ledgerlake.jobs")
    p.add_argument("stage", choices=["bronze", "silver", "targets", "deposits", "claim", "apply", "check", "compact", "gold", "gold-stream",
                                     "directors", "index", "search", "profiles", "deeds-stream",
                                     "deed-targets", "deeds", "deeds-claim", "deeds-apply", "deeds-cached", "deeds-summary"])
    p.add_argument("--root", required=True, help="lake root (a shared file system path)")
    p.add_argument("--register-dir", help="folder of register CSV files (bronze)")
    p.add_argument("--landed", help="root of the landed filing tree /{company}/hbb/{ref}.csv")
    p.add_argument("--listings", help="folder of deposit or deed listings (deposits, deeds)")
    p.add_argument("--files", help="folder of deed PDFs (deeds, deeds-apply, deeds-cached)")
    p.add_argument("--per-company", type=int, help="deposits: how many of the latest of a company count")
    p.add_argument("--claim", type=int, help="claim, deeds-claim: how many companies")
    p.add_argument("--pages", help="folder of captured pages {company key}.html (directors)")
    p.add_argument("--queries", help="search: folder of JSON lines (query_id, q)")
    p.add_argument("--events", help="folder of progress-event JSON lines (deeds-stream, deeds-summary)")
    p.add_argument("--compacted", action="store_true", help="gold: read lines from the compacted table")
    p.add_argument("--buckets", type=int, default=64, help="compact, index, gold-stream: hash buckets of the table (stored with it)")
    p.add_argument("--continuous", action="store_true", help="streams: keep running")
    a = p.parse_args(argv)
    lacking = [f"--{x.replace('_', '-')}" for x in REQUIRED.get(a.stage, ()) if getattr(a, x) is None]
    if lacking:
        p.error(f"{a.stage} needs {', '.join(lacking)}")
    if any(x is not None and x < 1 for x in (a.per_company, a.claim)):
        p.error("--per-company and --claim must be 1 or more")
    spark = build_session(app=f"ledgerlake-{a.stage}")
    stages = {
        "bronze": lambda: bronze(spark, a.root, a.register_dir),
        "silver": lambda: silver(spark, a.root),
        "targets": lambda: targets(spark, a.root),
        "deposits": lambda: deposits(spark, a.root, a.listings, a.per_company),
        "claim": lambda: claim(spark, a.root, a.claim),
        "apply": lambda: apply(spark, a.root, a.landed),
        "check": lambda: check(spark, a.root, a.landed),
        "compact": lambda: compact(spark, a.root, a.landed, a.buckets),
        "gold": lambda: gold(spark, a.root, a.landed, a.compacted),
        "gold-stream": lambda: gold_stream(spark, a.root, a.landed, not a.continuous, a.buckets).awaitTermination(),
        "directors": lambda: directors(spark, a.root, a.pages),
        "index": lambda: index(spark, a.root, a.buckets),
        "search": lambda: search(spark, a.root, a.queries),
        "profiles": lambda: profiles(spark, a.root),
        "deed-targets": lambda: deed_targets(spark, a.root),
        "deeds": lambda: deeds(spark, a.root, a.listings, a.files),
        "deeds-claim": lambda: deeds_claim(spark, a.root, a.claim),
        "deeds-apply": lambda: deeds_apply(spark, a.root, a.files),
        "deeds-cached": lambda: deeds_cached(spark, a.root, a.files),
        "deeds-summary": lambda: deeds_summary(spark, a.root, a.events),
        "deeds-stream": lambda: deeds_stream(spark, a.root, a.events, not a.continuous).awaitTermination(),
    }
    print(stages[a.stage]())


if __name__ == "__main__":
    main()
