"""Landed trees stand on disk for a share of the companies at a time."""

import datetime
import os

import pytest

from ledgerlake.plans import filing_tree, queries_files, registry

COMPANIES, FILINGS = 20, 120


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Companies with 0 to some filings, a repeated company and a filing of no known company."""
    root = str(tmp_path_factory.mktemp("waves"))
    customers = [(k, float(k % 5 - 1)) for k in range(1, COMPANIES + 1)] + [(3, 2.0), (None, 1.0)]
    orders = [(k, 1 + k * k % (COMPANIES - 1), datetime.date(2015 + k % 6, 1 + k % 12, 5), ["1-URGENT", "3-MEDIUM", "5-LOW"][k % 3], "OFP"[k % 7 % 3]) for k in range(FILINGS)]
    orders.append((FILINGS, 999, datetime.date(2020, 1, 1), "1-URGENT", "O"))
    lines = [(k % (FILINGS + 1), k % 11, k % 4, k % 7, 10.0 + k, 0.01 * (k % 3)) for k in range(4 * FILINGS)]
    for name, rows, schema in (("customer", customers, "c_custkey long, c_acctbal double"),
                               ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string, o_orderstatus string"),
                               ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double")):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", ["gold_from_compacted", "gold_stale_compaction", "gold_partial_update"])
def test_waves_of_compacted_files(spark, sf_dir, monkeypatch, name):
    registry.load_all()
    want = sorted(map(repr, registry.QUERIES[name](spark, sf_dir).collect()))
    monkeypatch.setattr(filing_tree, "WAVE_FILINGS", 45)
    assert sorted(map(repr, registry.QUERIES[name](spark, sf_dir).collect())) == want and len(want) > 1


@pytest.mark.parametrize("name", ["list_landed_files", "list_target_files", "filing_tree_facts", "target_tree_facts", "missing_files", "gold_from_files"])
def test_waves_give_the_rows_of_one_tree(spark, sf_dir, monkeypatch, tmp_path, name):
    registry.load_all()
    monkeypatch.setattr(queries_files, "_scratch", lambda spark: str(tmp_path / f"s{len(os.listdir(tmp_path))}"))
    whole = registry.QUERIES[name](spark, sf_dir)
    want, schema = sorted(map(repr, whole.collect())), whole.schema.simpleString()

    standing, written, land = [], [], queries_files.materialize_tree

    def counted(lines, root):
        written.append(land(lines, root))
        standing.append(sum(f.endswith(".csv") for top in tmp_path.glob("s1*") for _, _, names in os.walk(top) for f in names))
        return written[-1]

    monkeypatch.setattr(queries_files, "materialize_tree", counted)
    monkeypatch.setattr(filing_tree, "WAVE_FILINGS", 10)
    got = registry.QUERIES[name](spark, sf_dir)
    assert sorted(map(repr, got.collect())) == want and got.schema.simpleString() == schema and len(want) > 1
    landed = sum(written)
    assert len(written) == 13 and 0 in written  # a wave without filings is run, too
    assert landed == FILINGS + 1 - (name == "missing_files") * sum("OFP"[k % 7 % 3] == "P" and k % 3 == 1 for k in range(FILINGS))
    assert standing == written and max(standing) < landed / 2
    assert not [f for top in tmp_path.glob("s1*") for _, _, names in os.walk(top) for f in names if f.endswith(".csv")]


def test_few_waves_and_trees_removed_in_tasks(spark, tmp_path, monkeypatch):
    """A wave costs its jobs, and files made after others were removed: 900,000 filings (0.1 GB) are one."""
    ran = []
    filing_tree.over_waves(spark, str(tmp_path / "none"), 900_000, [], lambda folder: ran.append(folder))
    assert len(ran) == 1

    root = tmp_path / "tree"
    lines = spark.createDataFrame([(f"k{k % 9}", f"r{k}", 0, "70", "5") for k in range(90)], "enterprise_key string, filing_ref string, line_no long, code string, value string")
    assert filing_tree.materialize_tree(lines, str(root)) == 90 and len(list(root.glob("*/hbb/*.csv"))) == 90
    left, remove = [], filing_tree.sinks.remove
    monkeypatch.setattr(filing_tree.sinks, "remove", lambda spark, path: left.append(sum(len(f) for _, _, f in os.walk(path))) or remove(spark, path))
    filing_tree.remove_tree(spark, str(root))
    filing_tree.remove_tree(spark, str(tmp_path / "missing"))
    assert left == [0, 0] and not root.exists()  # nothing was left to the driver


@pytest.mark.parametrize("name", ["gold_stale_compaction", "gold_partial_update"])
def test_a_filing_lands_once(spark, sf_dir, monkeypatch, name):
    written, land = [], queries_files.materialize_tree
    monkeypatch.setattr(queries_files, "materialize_tree", lambda lines, root: written.append(land(lines, root)))
    registry.load_all()
    assert registry.QUERIES[name](spark, sf_dir).count() > 1
    assert len(written) == 2 and min(written) > 0 and sum(written) == FILINGS + 1


def test_null_keys_and_values_land(spark, tmp_path):
    rows = [(None, "r1", 0, "70", "5"), (None, "r2", 0, None, "6"), ("k1", None, 0, "70", None), (None, None, 0, "70", 'a "b",c')]
    lines = spark.createDataFrame(rows, "enterprise_key string, filing_ref string, line_no long, code string, value string")
    assert filing_tree.materialize_tree(lines, str(tmp_path / "tree")) == 4
    got = {f.relative_to(tmp_path / "tree").as_posix(): f.read_text() for f in (tmp_path / "tree").glob("*/hbb/*.csv")}
    assert got == {"None/hbb/r1.csv": "70,5\n", "None/hbb/r2.csv": ",6\n", "k1/hbb/None.csv": "70,\n", "None/hbb/None.csv": '70,"a ""b"",c"\n'}
