"""E1 as Structured Streaming: progress-event files -> running deed table.

The stream keeps no state and no log of events.  The table holds a partial row
per (run, documentId): its values and, with each, the number ``seq`` of the event
that it is from.  Each micro-batch folds its own events to partial rows and
merges them with the stored rows of the runs it touches; so a batch costs what
its events and its runs' documents cost, however many events came before.
Merging is by number, not by arrival, and merging a batch twice is merging it once: the
table doesn't depend on the order of files, a replayed micro-batch changes
nothing, and no watermark is needed.

The table is partitioned by run, written ``r<run>`` (and ``none`` for a null run), so that null and
empty runs are kept apart and no run is lost; a run that has ended is not
read again.  The checkpoint folder makes the query restart where it stopped after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import deeds as D
from ..sources import sinks
from ..sources.listings import read_progress_events

PARTIAL_SCHEMA = ("run string, documentId string, rank int, added_seq long, added struct<deedDate: string, description: string>, "
                  "got_seq long, got struct<filename: string, sizeBytes: long>, run_part string")


def fold_batch(table: str, staging_root: str):
    """A micro-batch's partial rows merged into those of the runs it touches."""
    def _apply(batch: DataFrame, epoch_id: int) -> None:
        part = F.when(F.col("run").isNull(), F.lit("none")).otherwise(F.concat(F.lit("r"), F.col("run")))
        parts = D.deed_partials(batch).withColumn("run_part", part)
        sinks.rewrite_partitions(parts, table, "run_part", f"{staging_root}/epoch={epoch_id}",
                                 lambda current, new: D.merge_partials(current.unionByName(new), "run_part"))
    return _apply


def start_deed_status_stream(spark: SparkSession, events_path: str, table: str, checkpoint: str,
                             available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; with ``available_now`` it processes what is there
    and stops."""
    events = read_progress_events(spark, events_path, stream=True, max_files_per_trigger=max_files_per_trigger)
    w = (events.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(fold_batch(table, f"{checkpoint.rstrip('/')}/_staging")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_deed_table(spark: SparkSession, table: str) -> DataFrame:
    """The running table, from its stored partial rows."""
    return D.deed_table(spark.read.schema(PARTIAL_SCHEMA).parquet(table))


def run_to_end(spark: SparkSession, events_path: str, table: str, checkpoint: str,
               max_files_per_trigger: int | None = None) -> DataFrame:
    q = start_deed_status_stream(spark, events_path, table, checkpoint, True, max_files_per_trigger)
    q.awaitTermination()
    return read_deed_table(spark, table)
