"""Register CSVs read in splits (S1): every value as the whole-file reader gives it."""

import csv
import os
import random

import pytest

from ledgerlake.sources import register as R


def write(path, rows, end="\n", bom=False):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as fh:
        csv.writer(fh, quoting=csv.QUOTE_ALL, lineterminator=end).writerows([["Id", "Name", "Note"], *rows])


def values(df):
    return [tuple(r) for r in df.orderBy("_seq").drop("_seq").collect()]


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "200")
    yield
    for n, v in kept.items():
        spark.conf.set(n, v)


def notes(rng, end):
    bits = ["a", "b c", '"', '""', ",", end, end + end, "é", "", "NA", " ", "x" * 150, end + '"', '"' + end]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))


@pytest.mark.parametrize("end, bom", [("\n", False), ("\r\n", False), ("\n", True)])
def test_equal_to_whole_files(spark, tmpdir_path, small_splits, end, bom):
    rng = random.Random(len(end) + bom)
    rows = [[str(k).zfill(5), notes(rng, end), notes(rng, end)] for k in range(300)]
    path = os.path.join(tmpdir_path, "t.csv")
    write(path, rows, end, bom)
    got = R.read_register_csv(spark, path, tokens=("NA",))
    want = R.read_register_csv(spark, path, tokens=("NA",), whole_files=True)
    assert got.columns == want.columns == ["Id", "Name", "Note", "_seq"]
    assert values(got) == values(want) and len(values(got)) == 300
    assert spark.read.text(path).rdd.getNumPartitions() > 20  # many splits, most of them torn inside a record


def test_part_files_and_long_records(spark, tmpdir_path, small_splits):
    folder = os.path.join(tmpdir_path, "t.csv")
    os.makedirs(folder)
    write(os.path.join(folder, "part-0.csv"), [["1", "one\n" * 400, "end"], ["2", "", ""]])  # a record over many splits
    write(os.path.join(folder, "part-1.csv"), [["3", '"\n"', "x"]])
    write(os.path.join(folder, "part-2.csv"), [])
    got = values(R.read_register_csv(spark, folder, tokens=()))
    assert got == [("1", "one\n" * 400, "end"), ("2", got[1][1], got[1][2]), ("3", '"\n"', "x")]
    assert sorted(map(str, got)) == sorted(map(str, values(R.read_register_csv(spark, folder, tokens=(), whole_files=True))))


def test_blank_lines_and_unquoted_values(spark, tmpdir_path, small_splits):
    path = os.path.join(tmpdir_path, "t.csv")
    with open(path, "w") as fh:
        fh.write('Id,Name,Note\n1,plain,\n\n  \n2,"a\n\nb",x,more\n3\n')
    assert values(R.read_register_csv(spark, path)) == values(R.read_register_csv(spark, path, whole_files=True))


def test_register_texts_are_written_by_every_task(spark, tmpdir_path):
    from ledgerlake.plans.queries_silver import _write_texts_csv
    rows = [(k, f'line {k}\n"quoted", line\r\n', "en") for k in range(30)]
    folder = os.path.join(tmpdir_path, "texts")
    _write_texts_csv(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), f"{folder}/documents.csv")
    assert len([n for n in os.listdir(f"{folder}/documents.csv") if n.endswith(".csv")]) == 3
    got = R.load_register(spark, folder, null_tokens=("",))["documents"]
    assert sorted((int(r["doc_id"]), r["text"], r["lang"]) for r in got.collect()) == rows


def test_register_texts_go_through_no_single_task(spark, tmpdir_path, monkeypatch):
    from ledgerlake.plans import queries_silver as Q
    docs = spark.range(30).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang").repartition(3)
    folder = os.path.join(tmpdir_path, "whole")
    monkeypatch.setattr(Q.AD, "table", lambda *a: docs)
    monkeypatch.setattr(Q, "_scratch", lambda spark: folder)
    assert Q.q_load_register_texts(spark, "").count() == 30
    assert len([n for n in os.listdir(f"{folder}/documents.csv") if n.endswith(".csv")]) == 3
