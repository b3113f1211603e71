"""E2 as Structured Streaming: gold of the companies that have work pending.

Pending is a company that may be built now (its download is done) and has
landed files that its gold row doesn't hold, whichever of the two came last.  The
stream keeps two tables beside the lines, both in the checkpoint folder:

    _landed   a row per file read: company, filing, path, modification time, and the micro-batch (epoch) that read it
    _built    a row per company: the last epoch whose files its gold row holds

Each micro-batch

1. appends its new files' lines (with provenance and line numbers) to a compacted
   Parquet table partitioned by (key_bucket, epoch).  Files that were read
   before and have been written again since are read anew (only these are
   opened; see ``rewritten_lines``); of each file only the lines
   of its last epoch count, so corrected content replaces the old;
2. reads the download state as it is now, and takes the companies whose last
   landed epoch is after their built one;
3. rebuilds their gold rows from all of their lines (the semi-join on the bucket column
   prunes the other buckets), and upserts them into the gold table, partitioned by the
   same company bucket; only then are they marked as built.

A micro-batch starts when files land, when the download state gets a new version
(its pointer files are a second streaming source), and once with each start of the
stream.  Writes overwrite only their own epoch's partitions, and a replayed micro-batch
reads the ledger as it was before, so it does the same work again.  A file written again
is taken up by the next micro-batch, not by one of its own; a stream that takes what is available at
its start looks for them once, in its first micro-batch, as its source lists the tree once, too (where only
Spark's reader can list the tree, each micro-batch does, as that finds only files newer than those read).
No file that was deleted or archived leaves gold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import accounts as A
from ..operators import gold as G
from ..sources import filings as S
from ..sources import sinks

GOLD_STATE_SCHEMA = "_id string, processed_filings array<string>, last_processed timestamp"
LANDED_SCHEMA = "enterprise_key string, filing_ref string, file_path string, modified timestamp, epoch int"
BUILT_SCHEMA = "enterprise_key string, built int, key_bucket int"
#: Spark's most tasks for looking up files, 10,000 by default.
DISCOVERY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LINE = ["enterprise_key", "filing_ref", "file_path", "modified", "line_no", "code", "value"]


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not sinks._missing(e):
            raise
        return spark.createDataFrame([], schema)


def _lines(raw: DataFrame) -> DataFrame:
    return S.with_provenance(S.number_lines(raw, "modified")).select(*LINE)


def start_incremental_gold(spark: SparkSession, root: str, numbers: DataFrame | Callable[[], DataFrame], gold_table: str,
                           compacted: str, checkpoint: str, as_of: Column | None = None,
                           available_now: bool = True, max_files_per_trigger: int | None = None,
                           buckets: int = 64, archive_dir: str | None = None,
                           done_only: bool = False, gold_state_table: str | None = None, state_table: str | None = None):
    """``numbers``: a state table (_id) used to restore written company
    numbers (J6), or a function that reads it, which is then called in each micro-batch;
    with ``done_only`` only its companies are built (lines of others are kept until
    they appear in it).  ``state_table``: the snapshot table that ``numbers`` reads; a new
    version of it starts a micro-batch.  With ``gold_state_table`` each micro-batch
    also records the filings that its companies' gold rows were built from
    (S11), so a later batch run finds only what is new.  With ``archive_dir`` processed CSVs are moved there by
    the file source (``cleanSource=archive``), so a long-running stream
    does not re-list an ever-growing tree; the compacted table keeps every
    line."""
    as_of = as_of if as_of is not None else F.current_timestamp()
    base = checkpoint.rstrip("/")
    staging, ledger, built_table, starts = (f"{base}/{x}" for x in ("_staging", "_landed", "_built", "_starts"))
    spark.range(1).select(F.uuid().alias("snapshot")).write.mode("append").json(starts)
    # Spark's CSV reader takes milliseconds a file: where tasks can open the files themselves, the source tells paths and times only
    uri = S.landed.tree_uri(spark, root)
    reader = (S.file_reader if uri else S.filing_reader)(spark.readStream)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if uri:
        landed = reader.load(root).select("path", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("modified"))
    else:
        landed = S.with_file_columns(reader.csv(root), "modified")
    for folder in [starts, *([sinks.pointer_folder(state_table)] if state_table and sinks.versions(spark, state_table) else [])]:
        news = spark.readStream.schema(sinks.POINTER_SCHEMA).json(folder)
        landed = landed.unionByName(news.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in landed.schema]))

    def corrected(before: DataFrame, found: str) -> DataFrame | None:
        """Lines of the files that were read before and have another modification time now."""
        known = before.groupBy("file_path").agg(F.max("modified").alias("known"))
        again = S.rewritten_lines(spark, root, known, found)
        return None if again is None else again.select(*LINE)

    looked: list[int] = []                                # micro-batches of this start that looked for files written again

    def apply(raw: DataFrame, epoch_id: int) -> None:
        raw.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        before = _stored(spark, ledger, LANDED_SCHEMA).filter(F.col("epoch") < epoch_id)
        new = raw.filter(F.col("file_path").isNotNull())
        batch = S.lines_of_files(spark, uri, new).select(*LINE) if uri else _lines(new)
        if not (available_now and looked and S.timed_uri(spark, root)):
            looked.append(epoch_id)
            again = corrected(before, f"{staging}/again={epoch_id}")
            if again is not None:
                batch = batch.unionByName(again)
        batch = batch.persist()
        S.write_compacted(batch.drop("modified").withColumn("epoch", F.lit(epoch_id)), compacted, buckets, mode="overwrite",
                          extra_partitions=("epoch",))
        files = batch.select("enterprise_key", "filing_ref", "file_path", "modified").distinct().withColumn("epoch", F.lit(epoch_id))
        files.write.mode("overwrite").partitionBy("epoch").parquet(ledger)
        batch.unpersist()
        sinks.remove(spark, f"{staging}/again={epoch_id}")

        files = _stored(spark, ledger, LANDED_SCHEMA).filter(F.col("epoch") <= epoch_id)
        state = numbers() if callable(numbers) else numbers
        due = files.groupBy("enterprise_key").agg(F.max("epoch").alias("last")).join(_stored(spark, built_table, BUILT_SCHEMA), "enterprise_key", "left")
        due = due.filter(F.col("built").isNull() | (F.col("last") > F.col("built"))).select("enterprise_key", "last")
        if done_only:
            due = due.join(G.company_numbers(state).select("enterprise_key").distinct(), "enterprise_key", "left_semi")
        due = due.persist()
        if not due.isEmpty():
            # of each file the lines of its last epoch
            current = files.join(due, "enterprise_key", "left_semi").groupBy("file_path").agg(F.max("epoch").alias("epoch"))
            lines = S.read_compacted_lines(spark, compacted, due, buckets, keep=("epoch",)).join(current, ["file_path", "epoch"], "left_semi").drop("epoch")
            accounts = G.numbered_accounts(A.facts_from_lines(lines), state, as_of).withColumn(
                "key_bucket", S.key_bucket(X.company_key(F.col("enterprise_number")), buckets)).persist()
            sinks.upsert_partitions(accounts, gold_table, "enterprise_number", "key_bucket",
                                    f"{staging}/epoch={epoch_id}")
            accounts.unpersist()
            if gold_state_table:
                before_state = sinks.current_snapshot(spark, gold_state_table)
                refs = lines.groupBy("enterprise_key").agg(F.array_sort(F.collect_set("filing_ref")).alias("processed_filings"))
                seen = G.restore_company_number(refs, state).select(
                    F.col("enterprise_number").alias("_id"), "processed_filings", as_of.cast("timestamp").alias("last_processed"))
                written = sinks.read_table(spark, gold_state_table, GOLD_STATE_SCHEMA)
                sinks.write_replace(sinks.upsert(written, seen, "_id"), gold_state_table, expected=before_state)
            done = due.select("enterprise_key", F.col("last").alias("built"), S.key_bucket(F.col("enterprise_key"), buckets).alias("key_bucket"))
            sinks.upsert_partitions(done, built_table, "enterprise_key", "key_bucket", f"{staging}/built={epoch_id}")
        due.unpersist()

    w = landed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    # the files of a micro-batch are looked up by a few tasks a slot, not by one a file; the source asks the session
    # in each micro-batch, so the setting stays
    spark.conf.set(DISCOVERY, str(min(int(spark.conf.get(DISCOVERY)), 4 * spark.sparkContext.defaultParallelism)))
    return w.start()
