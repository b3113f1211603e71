"""Corpus pipeline: documents -> packed training sequences.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the docs of
the next.  Stages but the last return the columns of their docs.

Verdicts hold for rows, not for ids: rows that share a ``doc_id``, or have none,
are judged each by its own text.  Where verdicts are found elsewhere, the
stage's rows are written with a key of their own and joined on it.  Null or
empty texts have no language and go in the first stage.  Empty tables pass as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, langid, packing, quality, simhash
from ledgerlake.llm.common import id_remainder, materialise, table, tokenizer_path

#: Least share of a document that its main language must have (a mixture of two or three languages has it).
MAIN_LANGUAGE = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with underscores if ``docs`` has a column that starts so."""
    while any(c.lower().startswith(name.lower()) for c in docs.columns):
        name += "_"
    return name


def _keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, written once so that it stays the same, and the key's name."""
    key = _free(docs, "_row")
    return materialise(docs.withColumn(key, F.monotonically_increasing_id()), name), key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or no language with at least MAIN_LANGUAGE of their text."""
    model = langid.train(docs, id_remainder("doc_id", 3) != 1)
    if not model.languages:  # nothing to tell languages by
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    names = tuple(_free(docs, n) for n in ("_language", "_share", "_parts"))
    found = langid.identify(docs, model, names=names)
    return found.filter((F.col(names[0]) != "und") & (F.col(names[1]) >= MAIN_LANGUAGE)).select(*docs.columns)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose quality score is below 0.7."""
    prefix = _free(docs, "_quality_")
    labels, use = table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2
    model = quality.learn(quality.with_statistics(quality.labelled(docs, labels, use)), labels, use)  # statistics of labelled rows only
    return quality.add_statistics(docs, prefix).filter(model.score(prefix) >= 0.7).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of smallest doc_id stays (a row
    without one only if none has one); of rows of that id, one."""
    rows, key = _keyed(docs, "distinct-rows")
    found = simhash.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), words=3, max_bits=3)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    stay = (found.select(F.col("doc_id").alias("row"), "component_id").join(rows.select(F.col(key).alias("row"), F.col("doc_id").alias("id")), "row")
            .groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias(key)))
    return rows.join(stay, key, "left_semi").select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a passage of a benchmark item."""
    rows, key = _keyed(docs, "clean-rows")
    leaks = decontaminate.find_leaks(rows.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(leaks.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 1024 ids."""
    out = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, window=1024)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("quality", good), ("near_duplicates", distinct), ("decontamination", clean), ("packing", pack)]

#: Trained models, fingerprints, alignment and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
