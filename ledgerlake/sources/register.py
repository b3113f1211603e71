"""Register extracts: one CSV with header per table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DEFAULT_NULL_TOKENS
from . import sinks

REGISTER_TABLES = ("activity", "address", "branch", "code", "contact", "denomination", "enterprise",
                   "establishment", "meta")


def null_tokens(df: DataFrame, tokens=DEFAULT_NULL_TOKENS, skip=("_seq",)) -> DataFrame:
    """S3: texts in ``tokens`` become null in every string column."""
    toks = list(tokens)
    return df.select(*[
        F.when(~F.col(c).isin(toks), F.col(c)).alias(c) if t == "string" and c not in skip else F.col(c)
        for c, t in df.dtypes])


def list_csv(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(stem, path) of every entry of ``folder`` named *.csv — a single
    file or a folder of part files as Spark writes them — sorted by name.
    Only the folder's own entries are listed, through the Hadoop file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(n for n in (e.getPath().getName() for e in entries) if n.endswith(".csv"))
    return [(n[:-4], f"{folder.rstrip('/')}/{n}") for n in names]


def read_register_csv(spark: SparkSession, path: str, tokens=DEFAULT_NULL_TOKENS,
                      whole_files: bool = False) -> DataFrame:
    """One register CSV, every column a string (leading zeros kept), plus
    ``_seq``: read order, increasing over the files and within each (persist it by writing
    the bronze table; it is not stable across re-reads of a changed file).

    A quoted value may hold line breaks, and large files are split all the same (see
    ``_records``).  A quote inside a value must be doubled and the value quoted, as in the
    register's extracts, and lines end in LF or CRLF; ``whole_files`` reads other files, one task each."""
    options = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"'}
    # a UTF-8 byte-order mark at the start of the file would otherwise stick
    # to the first column name
    names = [c.lstrip("\ufeff") for c in spark.read.options(**options).csv(path).columns]
    if whole_files:
        df = spark.read.options(**options).option("multiLine", "true").csv(path).toDF(*names).withColumn("_seq", F.monotonically_increasing_id())
        return null_tokens(df, tokens)
    fields = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    parsed = F.from_csv("record", fields.simpleString()[7:-1].replace(":", " "), {**options, "header": "false", "multiLine": "true"})
    df = _records(spark, path).select(parsed.alias("r"), "_seq").select(*[F.col(f"r.c{k}").alias(n) for k, n in enumerate(names)], "_seq")
    return null_tokens(df, tokens)


_LINES_SCHEMA = "file string, block long, at long, value string, inside boolean, odd boolean, opens0 long, opens1 long"
#: ``_seq`` of a file starts at its number times this; files are shorter.
_FILE = 1 << 44


def _records(spark: SparkSession, path: str) -> DataFrame:
    """record, _seq: the records of CSV files but their headers, from splits read in parallel.

    A line starts inside a quoted value if the quotes before it are odd in
    number.  Each task counts them from its split's start, which is right or just the
    opposite of right; which of the two follows from the number of quotes in the splits before
    (a row a split is summed up).  Lines that are a record alone, nearly all, go on as they are.
    The others are put together by the line that opened the record; where that lies in an
    earlier split, by the last record that these splits opened."""
    def counted(batches):
        now, at, odd_before, opens = None, 0, 0, np.zeros(2, np.int64)
        for b in batches:
            files, blocks = b.column("file").to_pylist(), b.column("block").to_numpy()
            quotes = (pc.count_substring(b.column("value"), '"').to_numpy() % 2).astype(np.int64)
            new = np.flatnonzero([k == 0 or files[k] != files[k - 1] or blocks[k] != blocks[k - 1] for k in range(len(files))])
            for lo, hi in zip(new, [*new[1:], len(files)]):
                if (files[lo], blocks[lo]) != now:
                    now, at, odd_before, opens = (files[lo], blocks[lo]), 0, 0, np.zeros(2, np.int64)
                odd = quotes[lo:hi]
                before = (odd_before + np.cumsum(odd) - odd) % 2
                # lines that open a record of several lines, if the split starts outside of quotes, and if inside
                upto = opens[:, None] + np.cumsum(np.stack([(before == 0) & (odd == 1), (before == 1) & (odd == 1)]), axis=1)
                yield pa.RecordBatch.from_arrays([b.column("file")[lo:hi], b.column("block")[lo:hi], pa.array(at + np.arange(hi - lo)), b.column("value")[lo:hi],
                                                  pa.array(before == 1), pa.array(odd == 1), pa.array(upto[0]), pa.array(upto[1])],
                                                 ["file", "block", "at", "value", "inside", "odd", "opens0", "opens1"])
                at, odd_before, opens = at + hi - lo, int(before[-1] + odd[-1]) % 2, upto[:, -1]

    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value").mapInArrow(counted, _LINES_SCHEMA)

    # a row a split: whether it starts inside quotes, and the last record opened before it
    first = (F.col("block") == 0) & (F.col("at") == 0)
    splits = lines.groupBy("file", "block").agg(F.sum(F.col("odd").cast("int")).alias("quotes"), F.max("opens0").alias("opens0"), F.max("opens1").alias("opens1"),
                                                F.max(first & F.col("value").endswith("\r")).alias("crlf"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("starts_inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    splits = splits.withColumn("last", F.when(F.col("starts_inside"), F.col("opens1")).otherwise(F.col("opens0")))
    splits = splits.withColumn("carried", F.last(F.when(F.col("last") > 0, F.struct("block", F.col("last").alias("number"))), ignorenulls=True).over(before))
    splits = splits.withColumn("crlf", F.max("crlf").over(Window.partitionBy("file")))
    number = splits.select("file").distinct().withColumn("file_no", F.row_number().over(Window.orderBy("file")).cast("long") - 1)
    splits = splits.join(number, "file").select("file", "block", "starts_inside", "carried", "crlf", "file_no")

    own = lines.join(splits, ["file", "block"]).filter(~first)
    own = own.withColumn("inside", F.col("inside") != F.col("starts_inside"))
    own = own.withColumn("value", F.when(F.col("crlf") & F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")))
    seq = F.col("file_no") * _FILE + F.col("block") + F.col("at")
    alone = ~F.col("inside") & ~F.col("odd")
    single = own.filter(alone & (F.col("value") != "")).select(F.col("value").alias("record"), seq.alias("_seq"))
    opened = F.when(F.col("starts_inside"), F.col("opens1")).otherwise(F.col("opens0"))
    record = F.when(opened > 0, F.struct("block", opened.alias("number"))).otherwise(F.col("carried"))
    torn = own.filter(~alone).select("file_no", record.alias("record"), seq.alias("_seq"), "value").groupBy("file_no", "record").agg(F.array_sort(F.collect_list(F.struct("_seq", "value"))).alias("lines"))
    joined = torn.select(F.array_join(F.col("lines.value"), "\n").alias("record"), F.col("lines")[0]["_seq"].alias("_seq"))
    return single.unionByName(joined)


def load_register(spark: SparkSession, folder: str, null_tokens=DEFAULT_NULL_TOKENS,
                  skip=frozenset()) -> dict[str, DataFrame]:
    """Every *.csv of ``folder`` (sorted) as a table named by its stem.
    Stems in ``skip`` are left out (see ``load_missing`` for S2)."""
    return {stem: read_register_csv(spark, path, null_tokens)
            for stem, path in list_csv(spark, folder) if stem not in skip}


def load_missing(spark: SparkSession, folder: str, bronze_root: str,
                 tokens=DEFAULT_NULL_TOKENS) -> dict[str, str]:
    """Import a table only when its bronze table is missing or empty;
    otherwise keep it.  Returns {stem: 'loaded' | 'kept'}."""
    status = {}
    for stem, path in list_csv(spark, folder):
        target = f"{bronze_root.rstrip('/')}/{stem}"
        if sinks.table_is_empty(spark, target):
            sinks.write_replace(read_register_csv(spark, path, tokens), target)
            status[stem] = "loaded"
        else:
            status[stem] = "kept"
    return status


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) per table, as one union of per-table counts."""
    parts = [df.select(F.lit(name).alias("name"), F.lit(1).alias("_one")) for name, df in tables.items()]
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p)
    return allrows.groupBy("name").agg(F.count("_one").alias("rows"))
