"""Sinks: full rewrite and keyed upsert as snapshot writes.

No table format with MERGE is assumed.  A table is a folder of snapshots;
a write goes to a new snapshot folder through Spark's output committer, then a
pointer file of the next version is published; readers take the highest version.
Versions count up from the last one and no clock takes part.  A pointer is
written beside its place and renamed onto it without overwriting, so of
two writers that derive the same version one gets ConflictError (or, if it
replaces whatever there is, the next version).  A reader never sees a
half-written table, and a job lost at any point leaves the previous snapshot
current (a rerun repeats the work).  The rename must not overwrite on the file
system used, as Hadoop's FileContext demands of its implementations."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from py4j.protocol import Py4JJavaError

from ..session import checkpoint_dir

POINTER = "_CURRENT"
POINTER_SCHEMA = "snapshot string"
POINTER_NAME = re.compile(r"v([0-9]{12})[.]json")
LAYOUT = "_LAYOUT"
LAYOUT_SCHEMA = "buckets int"


def _missing(error: AnalysisException) -> bool:
    """Whether a read failed because there is no such folder (anything else is an error)."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def bucket_layout(spark: SparkSession, table: str) -> int | None:
    """The bucket count stored with a hash-bucketed table, or None."""
    try:
        row = spark.read.schema(LAYOUT_SCHEMA).json(f"{table.rstrip('/')}/{LAYOUT}").first()
    except AnalysisException as e:
        if not _missing(e):
            raise
        return None
    return row["buckets"] if row else None


def write_bucket_layout(spark: SparkSession, table: str, buckets: int) -> None:
    """Stores the bucket count in a folder that Spark's readers of the table skip."""
    spark.createDataFrame([(buckets,)], LAYOUT_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{table.rstrip('/')}/{LAYOUT}")


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def pointer_folder(table: str) -> str:
    return f"{table.rstrip('/')}/{POINTER}"


def versions(spark: SparkSession, table: str) -> list[int]:
    """The published versions, ascending (a write keeps few of them)."""
    folder, store = _path(spark, pointer_folder(table))
    if not store.exists(folder):
        return []
    names = [POINTER_NAME.fullmatch(f.getPath().getName()) for f in store.listStatus(folder)]
    return sorted(int(m[1]) for m in names if m)


def _pointer(table: str, version: int) -> str:
    return f"{pointer_folder(table)}/v{version:012d}.json"


def _snapshot(spark: SparkSession, table: str, version: int) -> str:
    return f"{table.rstrip('/')}/{spark.read.schema(POINTER_SCHEMA).json(_pointer(table, version)).first()['snapshot']}"


def current_snapshot(spark: SparkSession, table: str) -> str | None:
    """Path of the current snapshot, or None when the table has none."""
    known = versions(spark, table)
    return _snapshot(spark, table, known[-1]) if known else None


def _publish(spark: SparkSession, table: str, name: str, version: int) -> bool:
    """Publishes a snapshot as ``version``; False if there is such a version already."""
    jvm = spark._jvm
    draft, store = _path(spark, f"{pointer_folder(table)}/.{name}")
    out = store.create(draft, False)
    out.write(bytearray(json.dumps({"snapshot": name}).encode()))
    out.close()
    place, _ = _path(spark, _pointer(table, version))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(store.makeQualified(draft), store.makeQualified(place), none)
    except Py4JJavaError as e:
        store.delete(draft, False)
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame | None:
    snap = current_snapshot(spark, table)
    if snap is None:
        if schema is None:
            return None
        return spark.createDataFrame([], schema)
    return spark.read.parquet(snap)


def materialise(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: what reads it twice
    computes it once, and plans on top of it stay small."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_is_empty(spark: SparkSession, table: str) -> bool:
    """Missing or empty."""
    df = read_table(spark, table)
    return df is None or df.limit(1).count() == 0


class ConflictError(RuntimeError):
    """Another writer replaced the table since it was read."""


def write_replace(df: DataFrame, table: str, expected: str | None = None, keep: int = 2) -> str:
    """Write ``df`` as the new full content of ``table``.  Returns the
    snapshot path.  Safe when ``df`` reads the current snapshot of the same
    table, because the old snapshot is never overwritten.

    ``expected``: the snapshot (``current_snapshot``) that ``df`` was derived
    from; if another one is current when the new one is ready, nothing is
    published and ConflictError is raised, so no other writer's update is
    lost.  Of the replaced snapshots the newest ``keep`` - 1 stay for readers that
    still use them; older ones are removed."""
    spark = df.sparkSession
    name = f"snap-{uuid.uuid4().hex}"
    path = f"{table.rstrip('/')}/{name}"
    df.write.mode("errorifexists").parquet(path)
    while True:
        last = (versions(spark, table) or [0])[-1]
        if expected is not None and (not last or _snapshot(spark, table, last) != expected):
            remove(spark, path)
            raise ConflictError(f"{table} was replaced by another writer")
        # without overwriting: another writer that took this version meanwhile is seen in the next turn
        if _publish(spark, table, name, last + 1):
            break
    drop_old_snapshots(spark, table, keep)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder, if there is one."""
    p, store = _path(spark, path)
    store.delete(p, True)


def drop_old_snapshots(spark: SparkSession, table: str, keep: int) -> None:
    """Removes the snapshots that were published before the newest ``keep`` and
    their pointers.  Snapshots not yet published are another writer's and stay."""
    for version in versions(spark, table)[:-keep]:
        remove(spark, _snapshot(spark, table, version))
        remove(spark, _pointer(table, version))


def upsert(existing: DataFrame, changes: DataFrame, key: list[str] | str) -> DataFrame:
    """Rows of ``changes`` replace rows of ``existing`` with the same
    key; other existing rows stay; new keys are inserted.  A shuffle join on
    the key (left-anti) plus a union; no collect."""
    key = [key] if isinstance(key, str) else list(key)
    kept = existing.join(changes.select(*key).distinct(), key, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def seed_missing(state: DataFrame, targets: DataFrame, defaults: dict, key: str = "_id") -> DataFrame:
    """Insert targets absent from ``state`` with default values; leave
    existing rows unchanged."""
    new = targets.select(key).distinct().join(state.select(key), key, "left_anti")
    for name, value in defaults.items():
        new = new.withColumn(name, value if hasattr(value, "alias") else F.lit(value))
    return state.unionByName(new.select(*state.columns))


def rewrite_partitions(changes: DataFrame, table: str, partition_col: str, staging: str,
                       merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """``merge(current rows, changes)`` in place of the partitions that ``changes`` touches.

    For tables updated often by small batches (streaming sinks): the
    current rows of the touched partitions are read (partition pruning
    through the semi-join), merged with the changes, staged as a written
    table in ``staging`` (a folder in the shared checkpoint location; this
    also cuts the lineage to the table being overwritten), then written
    back with dynamic partition overwrite, and the staged copy is removed.
    Untouched partitions are never read or written: the cost is that of the
    partitions touched, which for hash buckets and a batch of many keys is the
    whole table.  A replayed batch produces the same partitions again if merging
    changes twice is merging them once."""
    spark = changes.sparkSession
    try:
        # read with the batch's schema: partition values are never re-typed
        # by inference (a run '2024-01-01' stays text, '001' keeps its zeros)
        current = spark.read.schema(changes.schema).parquet(table)
    except AnalysisException as e:
        if not _missing(e):
            raise
        current = spark.createDataFrame([], changes.schema)
    touched = changes.select(partition_col).distinct()
    merged = merge(current.join(touched, partition_col, "left_semi"), changes)
    merged.write.mode("overwrite").parquet(staging)
    (spark.read.schema(merged.schema).parquet(staging).hint("rebalance", partition_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(table))
    remove(spark, staging)


def upsert_partitions(changes: DataFrame, table: str, key: list[str] | str, partition_col: str,
                      staging: str) -> None:
    """Keyed upsert that rewrites only the partitions ``changes`` touches."""
    rewrite_partitions(changes, table, partition_col, staging, lambda current, new: upsert(current, new, key))
