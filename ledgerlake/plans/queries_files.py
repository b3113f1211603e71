"""Registered queries over a landed filing tree and captured pages (S4, S5,
S7, J8, E2 batch and stream, P1, J10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import accounts as A
from ..operators import checks as C
from ..operators import pages as P
from ..operators import targets as T
from ..sources import filings as S
from ..sources import sinks
from ..streaming.incremental_gold import start_incremental_gold
from . import adapters as AD
from . import oracle as O
from .filing_tree import materialize_tree, over_waves
from .gold_run import run_gold
from .queries_gold import FACTS_SQL, _accounts_flat_sql, flat_accounts
from .queries_silver import _scratch
from .registry import register

_KEY = O.key_sql("c_custkey")
_NUM = O.number_sql("c_custkey")


def _tree(spark, sf_dir):
    root = _scratch(spark)
    materialize_tree(AD.filing_lines(spark, sf_dir), root)
    return root


def _landed_waves(spark, sf_dir, run, *tables, keep=None):
    """``run(folder, lines, *tables)`` over waves of companies (``over_waves``): their filing lines (those of the filings
    ``keep``) and their rows of ``tables``, pairs of a table and its company key."""
    lines = AD.filing_lines(spark, sf_dir).drop("file_path")
    if keep is not None:
        lines = lines.join(keep, ["enterprise_key", "filing_ref"], "left_semi")
    filings = AD.table(spark, sf_dir, "orders").count()
    return over_waves(spark, _scratch(spark), filings, [(lines, F.col("enterprise_key")), *tables], run)


def _on_tree(spark, sf_dir, read, *tables, keep=None):
    """``read(root, *tables)`` of landed trees, a wave of companies each."""
    def run(folder, lines, *own):
        materialize_tree(lines, f"{folder}/tree")
        return read(f"{folder}/tree", *own)

    return _landed_waves(spark, sf_dir, run, *tables, keep=keep)


@register("filing_tree_facts", FACTS_SQL)
def q_filing_tree_facts(spark, sf_dir):
    """S4 + S5 + A1..X19 from real CSV files."""
    return _on_tree(spark, sf_dir, lambda root: A.facts_from_lines(S.read_filing_lines(spark, root)))


_LISTED = f"SELECT {O.key_sql('o_custkey')} AS enterprise_key, CAST(o_orderkey AS VARCHAR) || '.csv' AS filename FROM orders"


@register("list_landed_files", f"""
SELECT enterprise_key, count(*) AS n_files, string_agg(filename, ',' ORDER BY filename) AS filenames FROM ({_LISTED}) GROUP BY enterprise_key""")
def q_list_landed_files(spark, sf_dir):
    def read(root):
        files = S.list_landed_files(spark, root).groupBy("enterprise_key").agg(F.array_sort(F.collect_list("filename")).alias("names"))
        return files.select("enterprise_key", F.size("names").cast("long").alias("n_files"), F.array_join("names", ",").alias("filenames"))

    return _on_tree(spark, sf_dir, read)


def _every_third(spark, sf_dir):
    """Keys of every third company, and of some that have no folder."""
    cust = AD.table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 == 0)
    return cust.select(AD.key_of(F.col("c_custkey")).alias("enterprise_key")).union(cust.select(F.concat(F.lit("no-"), F.col("c_custkey"))))


_THIRD = f"enterprise_key IN (SELECT {_KEY} FROM customer WHERE c_custkey % 3 = 0)"


@register("list_target_files", f"SELECT * FROM ({_LISTED}) WHERE {_THIRD}")
def q_list_target_files(spark, sf_dir):
    """S7 of some companies: only their folders are listed, in tasks."""
    def read(root, keys):
        return S.list_landed_files(spark, root, keys).filter("size > 0").select("enterprise_key", "filename")

    return _on_tree(spark, sf_dir, read, (_every_third(spark, sf_dir), F.col("enterprise_key")))


@register("target_tree_facts", f"SELECT * FROM ({FACTS_SQL}) WHERE {_THIRD}")
def q_target_tree_facts(spark, sf_dir):
    """S4 + S5 + A1..X19 of some companies: only their files are opened."""
    return _on_tree(spark, sf_dir, lambda root, keys: A.facts_from_lines(S.read_filing_lines(spark, root, keys)),
                    (_every_third(spark, sf_dir), F.col("enterprise_key")))


def _by_company(state):
    """A progress table and its company key."""
    return state, X.company_key(F.col("_id"))


def _landed_orders(spark, sf_dir):
    o = AD.table(spark, sf_dir, "orders").filter(~((F.col("o_orderstatus") == "P")
                                                   & (F.col("o_orderpriority") == "3-MEDIUM")))
    return o.select(AD.key_of(F.col("o_custkey")).alias("enterprise_key"),
                    F.col("o_orderkey").cast("string").alias("filing_ref"))


@register("missing_files", f"""
WITH m AS (SELECT o_custkey, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR) || '.csv', ',' ORDER BY CAST(o_orderkey AS VARCHAR) || '.csv') AS missing
           FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' GROUP BY o_custkey)
SELECT {_NUM} AS _id, CAST(coalesce(m.n, 0) AS INTEGER) AS n_missing, coalesce(m.missing, '') AS missing,
       CASE WHEN m.n > 0 THEN 'pending' WHEN c_acctbal >= 0 THEN 'done' ELSE 'pending' END AS status_after
FROM customer LEFT JOIN m ON m.o_custkey = c_custkey""")
def q_missing_files(spark, sf_dir):
    def read(root, state):
        r = C.missing_files(state, S.list_landed_files(spark, root, state.select(F.regexp_replace("_id", "[^0-9]", "").alias("enterprise_key"))))
        return r.select("_id", F.size("missing").alias("n_missing"), F.array_join("missing", ",").alias("missing"),
                        "status_after")

    return _on_tree(spark, sf_dir, read, _by_company(AD.download_state(spark, sf_dir)), keep=_landed_orders(spark, sf_dir))


DONE_KEYS = f"""(SELECT {_KEY} FROM customer WHERE c_acctbal >= 0
                 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey))"""


@register("gold_from_files", _accounts_flat_sql(f"WHERE enterprise_key IN {DONE_KEYS}"))
def q_gold_from_files(spark, sf_dir):
    """E2 batch job on a landed tree, run twice (the second run finds no
    new filing and leaves gold unchanged)."""
    ran = []

    def run(folder, lines, ds):
        root = f"{folder}/tree"
        materialize_tree(lines, root)
        ran.append([run_gold(spark, root, ds, f"{folder}/state", f"{folder}/gold", AD.as_of()) for _ in range(2)])
        return _gold_rows(spark, folder)

    out = _landed_waves(spark, sf_dir, run, _by_company(AD.download_state(spark, sf_dir)))
    assert any(first["targets"] for first, _ in ran) and not any(second["targets"] for _, second in ran), ran
    return out


@register("incremental_gold_stream", _accounts_flat_sql())
def q_incremental_gold_stream(spark, sf_dir):
    """E2 stream form: files picked up in several micro-batches."""
    root = _tree(spark, sf_dir)
    gold_t, comp, ckpt = _scratch(spark), _scratch(spark), _scratch(spark)
    numbers = AD.download_state(spark, sf_dir).filter(F.col("status") == "done")
    q = start_incremental_gold(spark, root, numbers, gold_t, comp, ckpt, AD.as_of(), max_files_per_trigger=8000,
                               buckets=16)
    q.awaitTermination()
    return flat_accounts(spark.read.parquet(gold_t))


@register("gold_stream_late_done", _accounts_flat_sql(f"WHERE enterprise_key IN {DONE_KEYS}"))
def q_gold_stream_late_done(spark, sf_dir):
    """E2 stream where downloads are recorded after their files landed: at the first run
    the files of all companies are there and no company is done, at the second all downloads are done and
    nothing new lands, at the third some files have been written again with other content
    (at first, the files of a third of the companies hold no amounts)."""
    lines = AD.filing_lines(spark, sf_dir)
    root = _scratch(spark)
    damaged = (F.col("enterprise_key").cast("long") % 3 == 0) & ~F.col("code").rlike("^[A-Z]")
    materialize_tree(lines.filter(~damaged), root)
    gold_t, comp, ckpt, state_t = (_scratch(spark) for _ in range(4))
    state = AD.download_state(spark, sf_dir)

    def run():
        q = start_incremental_gold(spark, root, lambda: T.done_with_filings(sinks.read_table(spark, state_t)), gold_t, comp, ckpt, AD.as_of(), max_files_per_trigger=50_000,
                                   buckets=16, done_only=True, state_table=state_t)
        q.awaitTermination()

    sinks.write_replace(state.withColumn("status", F.lit("pending")), state_t)
    run()
    sinks.write_replace(state, state_t)
    run()
    materialize_tree(lines.filter(F.col("enterprise_key").cast("long") % 3 == 0), root)
    run()
    return flat_accounts(spark.read.parquet(gold_t))


# A captured page of the register (invented content) with an office-holder
# section between other sections.
FIXTURE_PAGE = """<table>
 <tr><td><h2>Algemeen</h2></td></tr><tr><td class="QL">Status</td><td>Actief</td></tr>
 <tr><td><h2>Functies</h2></td></tr>
 <tr><td class="QL">Bestuurder</td><td class="QL">Doe ,
     Jane</td><td class="RL">Sinds 1 januari 2020</td></tr>
 <tr><td class="RL">Zaakvoerder</td><td class="RL">Roe, Ann</td></tr>
 <tr><td>no class</td><td>skipped</td></tr>
 <tr><td><h2>Vaardigheden</h2></td></tr><tr><td class="QL">X</td><td>not read</td></tr>
</table>"""


def _pages(spark, sf_dir):
    """The driver's web pages (none has the section) and the derived register pages."""
    real = AD.table(spark, sf_dir, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string"))
                                                   .alias("company"), "html")
    return real.unionByName(AD.director_pages(spark, sf_dir))


_HOLDERS = f"""
holders AS (
  SELECT {_NUM.replace('c_custkey', 'o_custkey')} AS company,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
         o_orderpriority AS role, 'Clerk&' || CAST(o_orderkey AS VARCHAR) AS name, strftime(o_orderdate, '%Y-%m-%d') AS start_date
  FROM orders)"""


@register("extract_directors", f"WITH {_HOLDERS} SELECT * FROM holders")
def q_extract_directors(spark, sf_dir):
    """P1 over every captured page."""
    return P.extract_directors(_pages(spark, sf_dir))


@register("directors_to_fetch", f"""
SELECT {_NUM} AS _id FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def q_directors_to_fetch(spark, sf_dir):
    """Companies with an urgent order are cached (with an empty list)."""
    cust = AD.table(spark, sf_dir, "customer").select(AD.number_of(F.col("c_custkey")).alias("_id"))
    urgent = (AD.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
              .select(AD.number_of(F.col("o_custkey")).alias("_id")))
    empty_dirs = spark.createDataFrame([], P.DIRECTOR_SCHEMA)
    cache = P.directors_cache_rows(empty_dirs, urgent, AD.as_of())
    return P.directors_to_fetch(cust, cache)


@register("directors_cache", f"""
WITH {_HOLDERS},
fetched AS (SELECT company, count(*) AS n, string_agg(role || '|' || name || '|' || start_date, ';' ORDER BY pos) AS directors
            FROM holders WHERE company NOT IN (SELECT company FROM holders WHERE role = '1-URGENT') GROUP BY company)
SELECT {_NUM} AS _id, CAST(coalesce(f.n, 0) AS INTEGER) AS n_directors, coalesce(f.directors, '') AS directors
FROM customer LEFT JOIN fetched f ON f.company = {_NUM}""")
def q_directors_cache(spark, sf_dir):
    """J10 + S10: fetch what is missing (pages parsed by P1) and upsert.
    Companies with an urgent order are cached with an empty list."""
    cust = AD.table(spark, sf_dir, "customer").select(AD.number_of(F.col("c_custkey")).alias("_id"))
    urgent = (AD.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
              .select(AD.number_of(F.col("o_custkey")).alias("_id")))
    empty_dirs = spark.createDataFrame([], P.DIRECTOR_SCHEMA)
    cache = P.directors_cache_rows(empty_dirs, urgent, AD.as_of())
    todo = P.directors_to_fetch(cust, cache)
    fetched = P.directors_cache_rows(P.extract_directors(_pages(spark, sf_dir)), todo, AD.as_of())
    new = P.update_directors_cache(cache, fetched)
    return new.select("_id", F.size("directors").alias("n_directors"),
                      F.array_join(F.transform("directors", lambda d: F.concat_ws("|", d["role"], d["name"], d["start_date"])), ";").alias("directors"))


@register("gold_from_compacted", _accounts_flat_sql(f"WHERE enterprise_key IN {DONE_KEYS}"))
def q_gold_from_compacted(spark, sf_dir):
    """S4 -> compaction (Parquet, bucketed by company) -> E2 batch run that
    reads only the buckets of the target companies (dynamic partition
    pruning)."""
    ran = []

    def run(folder, lines, state):
        root, comp = f"{folder}/tree", f"{folder}/compacted"
        materialize_tree(lines, root)
        S.compact_filing_lines(spark, root, comp, buckets=16)
        ran.append(run_gold(spark, root, state, f"{folder}/state", f"{folder}/gold", AD.as_of(), compacted=comp))
        return _gold_rows(spark, folder)

    out = _landed_waves(spark, sf_dir, run, _by_company(AD.download_state(spark, sf_dir)))
    assert any(r["targets"] for r in ran), ran
    return out


def _gold_rows(spark, folder):
    """The gold table of a wave, if one was written."""
    gold = sinks.read_table(spark, f"{folder}/gold")
    return gold and flat_accounts(gold)


def _early(spark, sf_dir):
    """(enterprise_key, filing_ref) of orders that aren't open: what had landed at the first run."""
    o = AD.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "O")
    return o.select(AD.key_of(F.col("o_custkey")).alias("enterprise_key"), F.col("o_orderkey").cast("string").alias("filing_ref"))


def _early_state(spark, sf_dir, state):
    """The download state as it was when only those filings were done."""
    early = (_early(spark, sf_dir).groupBy("enterprise_key").agg(F.collect_list("filing_ref").alias("_early")))
    none = F.array().cast("array<string>")
    return (state.withColumn("enterprise_key", F.regexp_replace("_id", "[^0-9]", "")).join(early, "enterprise_key", "left")
            .withColumn("filings_done", F.array_intersect(F.coalesce("filings_done", none), F.coalesce("_early", none)))
            .select(*state.columns))


@register("gold_stale_compaction", _accounts_flat_sql(f"WHERE enterprise_key IN {DONE_KEYS}"))
def q_gold_stale_compaction(spark, sf_dir):
    """E2 batch run over a compacted table that was made before the open
    orders' filings landed: they are read from their files and appended first."""
    ran = []

    def run(folder, lines, state, early):
        root, comp = f"{folder}/tree", f"{folder}/compacted"
        materialize_tree(lines.join(early, ["enterprise_key", "filing_ref"], "left_semi"), root)
        S.compact_filing_lines(spark, root, comp, buckets=16)
        materialize_tree(lines.join(early, ["enterprise_key", "filing_ref"], "left_anti"), root)
        ran.append(run_gold(spark, root, state, f"{folder}/state", f"{folder}/gold", AD.as_of(), compacted=comp))
        return _gold_rows(spark, folder)

    out = _landed_waves(spark, sf_dir, run, _by_company(AD.download_state(spark, sf_dir)), (_early(spark, sf_dir), F.col("enterprise_key")))
    assert any(r["lacking"] for r in ran), ran
    return out


@register("gold_partial_update", _accounts_flat_sql(f"WHERE enterprise_key IN {DONE_KEYS}"))
def q_gold_partial_update(spark, sf_dir):
    """E2 run twice: the second run finds new filings of some companies
    only, and rebuilds those from all of their filings."""
    ran = []

    def run(folder, lines, full, before, early):
        root, comp = f"{folder}/tree", f"{folder}/compacted"
        tables = f"{folder}/state", f"{folder}/gold"
        materialize_tree(lines.join(early, ["enterprise_key", "filing_ref"], "left_semi"), root)
        S.compact_filing_lines(spark, root, comp, buckets=16)
        first = run_gold(spark, root, before, *tables, AD.as_of(), compacted=comp)
        materialize_tree(lines.join(early, ["enterprise_key", "filing_ref"], "left_anti"), root)
        ran.append((first, run_gold(spark, root, full, *tables, AD.as_of(), compacted=comp)))
        return _gold_rows(spark, folder)

    full = AD.download_state(spark, sf_dir)
    out = _landed_waves(spark, sf_dir, run, _by_company(full), _by_company(_early_state(spark, sf_dir, full)), (_early(spark, sf_dir), F.col("enterprise_key")))
    assert any(r["targets"] for _, r in ran) and any(r["lacking"] for _, r in ran) and not any(r["lacking"] for r, _ in ran), ran
    return out
