"""

    python tools/measure.py [sf_dir]

Prints one line per measurement (seconds, best of two warm runs)."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.constants import AMOUNT_CODES, PIVOT_KEYS  # noqa: E402
from ledgerlake.operators import accounts as A  # noqa: E402
from ledgerlake.operators import gold as G  # noqa: E402
from ledgerlake.operators import search as SE  # noqa: E402
from ledgerlake.plans import adapters as AD  # noqa: E402
from ledgerlake.plans.gold_run import recompute_gold  # noqa: E402
from ledgerlake.plans.silver_run import build_silver  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402


def timed(df, runs=2):
    best = None
    for _ in range(runs):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        d = time.perf_counter() - t
        best = d if best is None else min(best, d)
    return round(best, 2)


def spark_pivot(lines):
    p = (lines.filter(F.col("code").isin(list(PIVOT_KEYS)))
         .groupBy("enterprise_key", "filing_ref", "file_path").pivot("code", list(PIVOT_KEYS)).agg(F.first("value")))
    return p.select("enterprise_key", "filing_ref", *[F.col(f"`{c}`").try_cast("double").alias(c) for c in AMOUNT_CODES])


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    out = {}
    lines = AD.filing_lines(spark, sf)
    # materialise the adapter once so both pivots read the same parquet
    tmp = tempfile.mkdtemp(prefix="measure-", dir="/tmp")
    lines.write.parquet(f"{tmp}/lines")
    lines = spark.read.parquet(f"{tmp}/lines")
    out["pivot: groupBy().agg(min_by)"] = timed(A.pivot_accounts(lines))
    out["pivot: .pivot().agg(first)"] = timed(spark_pivot(lines))

    ds = AD.download_state(spark, sf).filter(F.col("status") == "done")
    out["gold chain: plain"] = timed(G.company_accounts(G.restore_company_number(A.facts_from_lines(lines), ds),
                                                        AD.as_of()))
    rep = lines.repartition("enterprise_key")
    out["gold chain: repartition by company first"] = timed(
        G.company_accounts(G.restore_company_number(A.facts_from_lines(rep), ds), AD.as_of()))

    tables = AD.register_tables(spark, sf)
    out["nesting: plain"] = timed(build_silver(tables))
    spark.conf.set("spark.sql.sources.bucketing.enabled", "true")
    wh = f"{tmp}/wh"
    keys = {"enterprise": "EnterpriseNumber", "activity": "EntityNumber", "address": "EntityNumber",
            "branch": "EnterpriseNumber", "contact": "EntityNumber", "denomination": "EntityNumber",
            "establishment": "EnterpriseNumber"}
    bucketed = {}
    for name, df in tables.items():
        if name in keys:
            df.write.bucketBy(16, keys[name]).sortBy(keys[name]).option("path", f"{wh}/{name}") \
                .saveAsTable(f"bk_{name}")
            bucketed[name] = spark.table(f"bk_{name}")
        else:
            bucketed[name] = df
    out["nesting: bucketed by company"] = timed(build_silver(bucketed))

    words = (spark.read.parquet(f"{sf}/part.parquet").select(F.explode(F.split("p_name", " ")).alias("w"))
             .distinct().orderBy("w").limit(100))
    queries = words.select(F.monotonically_increasing_id().cast("int").alias("query_id"), F.col("w").alias("q"))
    companies = AD.search_companies(spark, sf)
    cands = companies.filter(SE.has_sector(F.col("activities"), ("ECONOMY", "LARGE", "PROMO", "STANDARD")))
    names = SE._names(cands)
    q = SE.classify(queries)
    out["name search x%d: token index" % queries.count()] = timed(SE.rank_limit(SE.token_hits(names, q, 50), 50))
    theta = (q.select("query_id", "qt").join(names, F.regexp_like(F.col("name"), F.concat(F.lit("(?i)"), F.col("qt"))))
             .select("query_id", "EnterpriseNumber").distinct())
    out["name search: regex theta join"] = timed(SE.rank_limit(theta, 50))
    out["name search: n-gram prefilter + regex"] = timed(SE.rank_limit(SE.regex_hits(names, q), 50))

    gs_all = (AD.download_state(spark, sf)
              .select("_id", F.col("filings_done").alias("processed_filings"),
                      F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("last_processed")))
    dsa = AD.download_state(spark, sf)
    g0, s0, _ = recompute_gold(lines, dsa, gs_all, None, AD.as_of())
    out["incremental: 0% new"] = timed(g0)
    ten = F.pmod(F.xxhash64("_id"), F.lit(10)) == 0
    gs_10 = gs_all.withColumn("processed_filings", F.when(ten, F.slice("processed_filings", 1, 1))
                              .otherwise(F.col("processed_filings")))
    g10, s10, _ = recompute_gold(lines, dsa, gs_10, None, AD.as_of())
    out["incremental: 10% new"] = timed(g10)
    g100, _, _ = recompute_gold(lines, dsa, gs_all.limit(0), None, AD.as_of())
    out["incremental: 100% (first run)"] = timed(g100)
    for k, v in out.items():
        print(f"MEASURE\t{k}\t{v}")
    spark.stop()


if __name__ == "__main__":
    main()
