"""Listing files of the remote registers, taken as files.

* deposits: JSON documents with ``content[]`` (one listing per company)
* deeds: paged JSON documents with ``statutes[]`` and ``totalItems``
* progress events: JSON lines, batch or stream
* deed files on disk: ``{key}_{yyyymmdd|unknown}_{docId}.pdf``

The company of a listing is taken from its path: the parent folder name
(a ``name=value`` folder gives ``value``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from . import landed

DEPOSIT_SCHEMA = ("content array<struct<reference: string, periodEndDateYear: int, id: string, "
                  "migration: boolean, periodEndDate: string, depositDate: string>>")
DEED_SCHEMA = ("statutes array<struct<documentId: string, deedDate: string, deedNatureDecoded: string, "
               "documentStatus: string>>, totalItems int")
EVENT_SCHEMA = ("event string, documentId string, deedDate string, description string, filename string, "
                "sizeBytes long, count long, total long, downloaded long, message string, enterprise string, "
                "run string, seq long")


def company_from_path(path: Column) -> Column:
    parent = F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)
    return F.regexp_replace(parent, r"^[^=]*=", "")


def _documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """company_key and the columns of ``schema`` of every JSON document under ``path``.  A folder's files, one or
    more a company, are listed and read in tasks (``sources.landed``); other paths by Spark's reader."""
    uri = landed.tree_uri(spark, path)
    if uri is None:
        raw = spark.read.schema(schema).json(path)
        return raw.select(company_from_path(F.col("_metadata.file_path")).alias("company_key"), *raw.columns)
    # an array of documents, as the reader takes it, too: one document is an array of one
    lines = landed.text_lines(spark, uri).withColumn("docs", F.from_json("line", f"array<struct<{schema}>>"))
    return lines.select(company_from_path(F.col("file_path")).alias("company_key"), F.explode_outer("docs").alias("doc")).select("company_key", "doc.*")


def read_deposits(spark: SparkSession, path: str) -> DataFrame:
    """One row per deposit of every listing under ``path``."""
    return _documents(spark, path, DEPOSIT_SCHEMA).select("company_key", F.explode("content").alias("d")).select("company_key", "d.*")


def listed_companies(spark: SparkSession, path: str) -> DataFrame:
    """The companies that have a listing (of deposits or deeds) under ``path``, an empty one included."""
    return _documents(spark, path, DEPOSIT_SCHEMA).select("company_key").distinct()


def read_deeds(spark: SparkSession, path: str) -> DataFrame:
    """One row per deed of all pages of all listings under ``path``."""
    return _documents(spark, path, DEED_SCHEMA).select("company_key", F.explode("statutes").alias("s")).select("company_key", "s.*")


def read_progress_events(spark: SparkSession, path: str, stream: bool = False,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Progress events (JSON lines) as a batch or a streaming frame."""
    if stream:
        r = spark.readStream.schema(EVENT_SCHEMA)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.json(path)
    return spark.read.schema(EVENT_SCHEMA).json(path)


def list_deed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files ``*.pdf`` under ``folder`` (names and sizes only)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
            .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.col("length").alias("size")))


def deed_manifest(files: DataFrame) -> DataFrame:
    """Filename, size -> company_key, deed_date, doc_id, filename, size
    ('unknown' for a missing part)."""
    p = X.parse_deed_filename(F.col("filename"))
    return files.select(p["company_key"].alias("company_key"), p["deed_date"].alias("deed_date"),
                        p["doc_id"].alias("doc_id"), "filename", "size")
