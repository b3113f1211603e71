"""Plans and readers that hold no table and no list of files in the driver."""

from __future__ import annotations

import gzip
import json
import os

from pyspark.sql import functions as F

from ledgerlake.operators import search as SE
from ledgerlake.sources import filings as S
from ledgerlake.sources import listings as L
from tests.test_plans import plan_of


def test_names_are_not_broadcast(spark, tmpdir_path):
    """A few MB of compressed files may hold millions of names."""
    rows = [(f"0{i:03}.000.000", [(f"red bolt {i}",), ("x y",)], [("55100", "MAIN", "x")]) for i in range(50)]
    path = os.path.join(tmpdir_path, "companies")
    spark.createDataFrame(rows, "EnterpriseNumber string, denominations array<struct<Denomination: string>>, "
                          "activities array<struct<NaceCode: string, Classification: string, NaceLabel: string>>").write.parquet(path)
    c = spark.read.parquet(path)
    q = SE.classify(spark.createDataFrame([(1, "bolt"), (2, "00010000000"), (3, '"red bolt" -7'), (4, "r.d"), (5, "olt 1")], "query_id int, q string"))
    names = SE._names(c)
    for hits in (SE.number_hits(c, q), SE.regex_hits(names, q.filter("kind = 'name'")), SE.token_hits(names, q, 5)):
        assert "HashedRelationBroadcastMode" not in plan_of(hits)
    got = {(r[0], r[1]) for r in SE.regex_hits(names, q.filter("query_id IN (4, 5)")).select("query_id", "EnterpriseNumber").collect()}
    assert got == {(4, f"0{i:03}.000.000") for i in range(50)} | {(5, f"0{i:03}.000.000") for i in range(50) if str(i)[0] == "1"}
    phrase = {r[0] for r in SE.token_hits(names, q.filter("query_id = 3"), 5).select("EnterpriseNumber").collect()}
    assert phrase == {f"0{i:03}.000.000" for i in range(50) if i != 7}


def test_listings_are_read_in_tasks(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "listings")

    def put(path, text, opener=open):
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with opener(f"{root}/{path}", "wb") as fh:
            fh.write(text.encode())

    doc = lambda *ids: json.dumps({"statutes": [{"documentId": i, "documentStatus": "DONE"} for i in ids], "totalItems": len(ids)})
    put("company_key=01/a.json", doc("d1", "d2") + "\n\n" + doc("d3") + "\n")
    put("company_key=02/a.json", f"[{doc('d4')}, {doc('d5')}]")
    put("company_key=02/b.json.gz", doc("d6"), gzip.open)
    put("company_key=03/_hidden.json", doc("d7"))
    put("company_key=03/.b.json", doc("d8"))
    put("company_key=04/a.json", "not json\n" + doc("d9"))
    put("company_key=05/a.json", doc())
    df = L.read_deeds(spark, root)
    assert "FileScan json" not in plan_of(df)
    raw = spark.read.schema(L.DEED_SCHEMA).json(root)
    want = raw.select(L.company_from_path(F.col("_metadata.file_path")).alias("k"), F.explode("statutes").alias("s")).select("k", "s.*")
    assert sorted(map(str, df.collect())) == sorted(str(r).replace("Row(k=", "Row(company_key=") for r in want.collect())
    assert {(r["company_key"], r["documentId"]) for r in df.collect()} == {("01", "d1"), ("01", "d2"), ("01", "d3"), ("02", "d4"), ("02", "d5"), ("02", "d6"), ("04", "d9")}
    assert {r[0] for r in L.listed_companies(spark, root).collect()} == {"01", "02", "04", "05"}


def test_whole_tree_is_read_in_tasks(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landed")

    def put(path, text):
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "wb") as fh:
            fh.write(text)

    put("0100000001/hbb/r1.csv", b'70,1\n"a,b","x ""y"""\n\n \n60\n')
    put("more/0100000002/hbb/r2.csv", b"\xef\xbb\xbf70,2\r\n71,3\r\n")
    put("0100000002/hbb/_r3.csv", b"70,9\n")
    put("0100000002/_tmp/hbb/r4.csv", b"70,9\n")
    put("0100000002/other/r5.csv", b"70,9\n")
    put("0100000002/hbb/r6.txt", b"70,9\n")
    df = S.read_filing_lines(spark, root)
    assert "FileScan csv" not in plan_of(df)
    cols = ["enterprise_key", "filing_ref", "file_path", "code", "value"]
    want = S.with_provenance(S.with_line_numbers(S.filing_reader(spark.read).csv(root))).select(*cols, "line_no")
    got = [tuple(r)[:5] for r in df.select(*cols, "line_no").orderBy("file_path", "line_no").collect()]
    assert got == [tuple(r)[:5] for r in want.orderBy("file_path", "line_no").collect()] and len(got) == 5
    assert sorted(map(tuple, S.list_landed_files(spark, root).select("enterprise_key", "filename").collect())) == [("0100000001", "r1.csv"), ("0100000002", "r2.csv")]
