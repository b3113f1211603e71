import os


from ledgerlake.operators import accounts as A
from ledgerlake.sources import filings as S

FILES = {
    "0100000001/hbb/2022-1.csv": [
        '"Accounting period end date","2022-12-31"', '"Model code","m02-f"', "70,1000", "60,400", "71,50",
        "9901,200", "9904,100", "54,30", "55,20", "17,300", "43,100", "10/15,500", "100,80"],
    "0100000001/hbb/2022-2.csv": ['"Accounting period end date","2022-06-30"', "70,10"],
    "0100000001/hbb/2021-9.csv": ['"Accounting period end date","2021-12-31"', "70/74,300", "60/64,100", "54,5",
                                  "43,10"],
    "0100000002/hbb/2021-1.csv": ['"Accounting period end date","2021-12-31"', '"Model code","m04-p"', "70,abc",
                                  "70/76A,700"],
    "0100000002/hbb/2021-2.csv": ['"Accounting period end date","31/12/2021"', "70,1"],
    "0100000002/hbb/2021-3.csv": ['"Accounting period end date","2021-01-31"', "70,", "70,5,extra"],
}


def write_tree(root, files=FILES):
    for rel, lines in files.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")


def test_facts_from_tree(spark, tmpdir_path):
    write_tree(tmpdir_path)
    lines = S.read_filing_lines(spark, tmpdir_path)
    facts = {(r["enterprise_key"], r["filing_ref"]): r for r in A.facts_from_lines(lines).collect()}
    f = facts[("0100000001", "2022-1")]
    assert f["ca"] == 1000 and f["marge_brute"] == 650 and f["tresorerie"] == 50
    assert f["dettes_financieres"] == 400 and f["marge_nette"] == 10 and f["roe"] == 20
    assert f["liquidite"] == 0.125 and f["endettement"] == 80 and f["schema_type"] == "full"
    assert f["capital_souscrit"] == 80 and f["year"] == 2022
    g = facts[("0100000001", "2021-9")]
    assert g["ca"] == 300 and g["roe"] is None and g["endettement"] is None and g["tresorerie"] == 5
    # malformed first amount -> null (not the next value) -> fallback code used
    h = facts[("0100000002", "2021-1")]
    assert h["ca"] == 700 and h["schema_type"] == "micro"
    # bad date: filing dropped
    assert ("0100000002", "2021-2") not in facts
    # null first, then 5; a three-field line is tolerated
    assert facts[("0100000002", "2021-3")]["ca"] == 5
    assert len(facts) == 5


def test_missing_company_folder_is_fine(spark, tmpdir_path):
    write_tree(tmpdir_path)
    keys = spark.createDataFrame([("0100000001",), ("0100000003",)], "enterprise_key string")
    got = S.read_filing_lines(spark, tmpdir_path, keys).select("enterprise_key").distinct().collect()
    assert [r[0] for r in got] == ["0100000001"]


def test_pivot_plan_is_single_hash_aggregate(spark, tmpdir_path):
    write_tree(tmpdir_path)
    plan = A.pivot_accounts(S.read_filing_lines(spark, tmpdir_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_listing(spark, tmpdir_path):
    write_tree(tmpdir_path)
    got = S.list_landed_files(spark, tmpdir_path).groupBy("enterprise_key").count().collect()
    assert {r[0]: r[1] for r in got} == {"0100000001": 3, "0100000002": 3}
