"""The corpus pipeline: every stage's decisions, odd rows and empty tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from .helpers import no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "decontamination", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        out[name] = (before, docs)
    return out


def test_decisions_take_effect(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns
        assert after.join(before, "doc_id", "left_anti").count() == 0
    before, after = stages["language"]
    assert after.count() >= 0.99 * before.count()
    after = stages["quality"][1].join(labels, "doc_id")
    good, bad = labels.join(stages["quality"][0], "doc_id").filter("quality = 1").count(), after.filter("quality = 0").count()
    assert after.filter("quality = 1").count() >= 0.98 * good and bad <= 5
    distinct = stages["near_duplicates"][1]
    assert distinct.select("text").distinct().count() == distinct.count()
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [r.doc_id for r in stages["decontamination"][1].collect() if any(i in r.text for i in items)]


def test_packing_holds_what_is_left(spark, stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}
    assert corpus_pipeline.run(spark, SF).count() == after.count()


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_documents(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        if name != "packing":
            assert after.columns == docs.columns and after.count() <= docs.count()
            docs = after
    assert (after.count() > 0) == (make is odd_docs)


def test_rows_of_one_id_or_none_are_judged_each(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = [r.text for r in docs.join(labels.filter("quality = 1"), "doc_id").filter("n_chars BETWEEN 1500 AND 3000").orderBy("doc_id").limit(8).collect()]
    bad = [r.text for r in docs.join(labels.filter("quality = 0"), "doc_id").orderBy("doc_id").limit(6).collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text

    def run(name, rows):
        frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _row string")
        # the labelled documents are what the quality model learns from
        frame = frame.unionByName(docs.select("doc_id", "text", F.lit("given").alias("_row"))) if name == "quality" else frame
        after = dict(corpus_pipeline.STAGES)[name](spark, frame, SF)
        assert after.columns == frame.columns
        return sorted((r.doc_id or 0, r.text) for r in after.filter("_row = 'x'").collect())

    # a rejected row takes no other row of its id along, and rows without an id are rejected, too
    kept = run("quality", [(900_001, good[0]), *((900_001, b) for b in bad), *((None, b) for b in bad), (None, good[1])])
    assert (900_001, good[0]) in kept and (0, good[1]) in kept and len(kept) <= 4
    assert run("decontamination", [(1, good[0]), (1, f"{good[1]} {item} x"), (None, f"{good[2]} {item}"), (None, good[3])]) == sorted([(1, good[0]), (0, good[3])])
    # different texts of one id are no duplicates; of equal ones the smallest id stays, an id before none
    rows = [(7, good[0]), (7, good[1]), (7, good[1]), (9, good[0]), (None, good[1]), (None, good[2]), (None, good[2]), (None, good[3]), (5, good[3])]
    assert run("near_duplicates", rows) == sorted([(7, good[0]), (7, good[1]), (0, good[2]), (5, good[3])])


def test_columns_of_any_name_stay(spark):
    """Columns named as a stage's own ones come out as they went in."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    own = ["_language", "_share", "_shares", "_parts", "_quality_n_words", "_Quality_", "_row", "component_id", "fp", "item_id"]
    docs = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id")).alias(c) for c in own])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.count() > 0
        assert all(r[c] == f"{c} {r.doc_id}" for r in docs.collect() for c in own), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
