"""Deeds: published deeds, file names, the deed manifest, cached deeds and
the fold of download-progress events (F8, X22, J9, J14, A9, A10, E1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import STATE_DONE
from ..functions import expr as X

PROGRESS_KINDS = ("downloading", "downloaded")


def published_deeds(deeds: DataFrame) -> DataFrame:
    """F8: deeds whose documentStatus is DONE."""
    return deeds.filter(F.col("documentStatus") == "DONE")


def with_deed_filename(deeds: DataFrame, key: str = "company_key") -> DataFrame:
    """The file name a deed is stored under."""
    return deeds.withColumn("filename", X.deed_filename(F.col(key), F.col("deedDate"), F.col("documentId")))


def deeds_to_fetch(deeds: DataFrame, state: DataFrame, manifest: DataFrame, key: str = "company_key") -> DataFrame:
    """J9 for deeds: published deeds not in the company's ``acts_done``;
    ``route`` = 'have_file' when the file is already on disk (counts as done
    without a fetch), else 'fetch'."""
    done = (state.select(X.company_key(F.col("_id")).alias(key), F.explode("acts_done").alias("documentId"))
            .distinct())
    todo = with_deed_filename(published_deeds(deeds), key).join(done, [key, "documentId"], "left_anti")
    have = manifest.select(key, "filename").distinct().withColumn("_have", F.lit(True))
    return (todo.join(have, [key, "filename"], "left")
            .withColumn("route", F.when(F.col("_have"), F.lit("have_file")).otherwise(F.lit("fetch")))
            .drop("_have"))


def cached_deeds(state: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For companies whose deed state is done, their files from the
    manifest (with the count per company); the other companies are left for
    fetching.  Returns (cached files, companies to fetch)."""
    s = state.select("_id", "status", X.company_key(F.col("_id")).alias("company_key"))
    done = s.filter(F.col("status") == STATE_DONE)
    files = done.join(manifest, "company_key")
    counts = files.groupBy("_id").agg(F.count(F.lit(1)).alias("files_count"))
    cached = files.join(counts, "_id")
    to_fetch = s.join(done.select("_id"), "_id", "left_anti").select("_id", "company_key")
    return cached, to_fetch


def _newest(rank, added, added_seq, got, got_seq) -> list:
    """The fold's three aggregates: the highest status, the event that added the
    row (lowest number) and the last download (highest number), with these numbers."""
    return [F.max(rank).alias("rank"),
            F.min(added_seq).alias("added_seq"), F.min_by(F.struct(*added), added_seq).alias("added"),
            F.max(got_seq).alias("got_seq"), F.max_by(F.struct(*got), got_seq).alias("got")]


_PARTIAL = ["run", "documentId", "rank", "added_seq", "added", "got_seq", "got"]


def deed_partials(events: DataFrame) -> DataFrame:
    """Events -> one partial row per (run, documentId), which keeps the number of the event that each value is from."""
    ev = F.col("event")
    downloaded = ev == "downloaded"
    return (events.filter(ev.isin(*PROGRESS_KINDS) & F.col("documentId").isNotNull()).groupBy("run", "documentId")
            .agg(*_newest(F.when(downloaded, F.lit(1)).otherwise(F.lit(0)), ["deedDate", "description"], F.col("seq"), ["filename", "sizeBytes"], F.when(downloaded, F.col("seq")))))


def merge_partials(parts: DataFrame, *more: str) -> DataFrame:
    """Partial rows of any batches -> one a (run, documentId).  The order of merging
    doesn't matter, and merging a batch again changes nothing."""
    return (parts.groupBy("run", "documentId", *more)
            .agg(*_newest(F.col("rank"), [F.col("added.deedDate"), F.col("added.description")], F.col("added_seq"), [F.col("got.filename"), F.col("got.sizeBytes")], F.col("got_seq")))
            .select(*_PARTIAL, *more))


def deed_table(parts: DataFrame) -> DataFrame:
    """Partial rows -> the running table."""
    return parts.select(
        "run", "documentId",
        F.when(F.col("rank") == 1, F.lit("downloaded")).otherwise(F.lit("downloading")).alias("status"),
        F.col("added.deedDate").alias("deedDate"),
        F.coalesce(F.col("added.description"), F.lit("")).alias("description"),
        F.coalesce(F.col("got.filename"), F.lit("")).alias("filename"),
        F.coalesce(F.col("got.sizeBytes"), F.lit(0)).cast("long").alias("sizeBytes"))


def deed_status(events: DataFrame) -> DataFrame:
    """Running table per (run, documentId) from progress events.

    'downloading' adds a row; 'downloaded' sets status, filename and size
    (adding the row if absent); a later 'downloading' never resets a
    'downloaded'; 'download_failed' is ignored.  deedDate and description
    come from the event that added the row, filename and size from the last
    'downloaded'.  Order is the event number ``seq``, so the result does not
    depend on arrival order."""
    return deed_table(deed_partials(events))


def run_summary(events: DataFrame) -> DataFrame:
    """A10: per run the final state ('done' / 'error' / 'running'), the
    totals of the 'done' event, the error text, and the documents seen and
    downloaded (from the folded table)."""
    ev = F.col("event")
    end = ev.isin("done", "error")
    runs = events.groupBy("run").agg(
        F.max_by(ev, F.when(end, F.col("seq"))).alias("final"),
        F.max_by(F.col("total"), F.when(ev == "done", F.col("seq"))).alias("total"),
        F.max_by(F.col("downloaded"), F.when(ev == "done", F.col("seq"))).alias("downloaded"),
        F.max_by(F.col("message"), F.when(ev == "error", F.col("seq"))).alias("error"))
    docs = deed_status(events).groupBy("run").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if(F.col("status") == "downloaded").alias("n_downloaded"))
    return (runs.join(docs, "run", "left")
            .select("run", F.coalesce("final", F.lit("running")).alias("final"), "total", "downloaded", "error",
                    F.coalesce("n_documents", F.lit(0)).alias("n_documents"),
                    F.coalesce("n_downloaded", F.lit(0)).alias("n_downloaded")))
