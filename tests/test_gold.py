import os

from pyspark.sql import functions as F

from ledgerlake.operators import gold as G
from ledgerlake.plans.gold_run import run_gold
from ledgerlake.sources import sinks
from tests.test_accounts import write_tree

STATE = "_id string, status string, filings_count int, filings_done array<string>, filings_migrated array<string>"


def test_incremental_targets(spark):
    ds = spark.createDataFrame([
        ("0100.000.001", "done", 2, ["r1", "r2"], []),   # no gold state -> selected
        ("0100.000.002", "done", 1, ["r1"], []),         # same refs -> not
        ("0100.000.003", "done", 2, ["r1", "r9"], []),   # one new ref -> selected
        ("0100.000.004", "done", 0, [], []),             # empty -> never
        ("0100.000.005", "pending", 1, ["r1"], [])], STATE)
    gs = spark.createDataFrame([("0100.000.002", ["r1"], None), ("0100.000.003", ["r1"], None)],
                               "_id string, processed_filings array<string>, last_processed timestamp")
    got = sorted(r[0] for r in G.incremental_targets(ds, gs).collect())
    assert got == ["0100.000.001", "0100.000.003"]


def test_gold_runs_end_to_end(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landed")
    write_tree(root)
    write_tree(root, {"0100000003/hbb/x.csv": []})               # landed, but holds no line
    ds = spark.createDataFrame([
        ("0100.000.001", "done", 3, ["2022-1", "2022-2", "2021-9"], []),
        ("0100.000.002", "done", 3, ["2021-1", "2021-2", "2021-3"], []),
        ("0100.000.003", "done", 1, ["x"], [])], STATE)
    st, gold = os.path.join(tmpdir_path, "gold_state"), os.path.join(tmpdir_path, "gold")
    as_of = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    assert run_gold(spark, root, ds, st, gold, as_of)["targets"] == 3
    g = {r["enterprise_number"]: r for r in sinks.read_table(spark, gold).collect()}
    years = g["0100.000.001"]["years"]
    assert [(y["year"], y["filing_ref"]) for y in years] == [(2021, "2021-9"), (2022, "2022-1"), (2022, "2022-2")]
    assert g["0100.000.001"]["schema_type"] == "full"          # latest year, smallest ref
    assert years[1]["ratios"]["marge_brute"] == 650
    assert "0100.000.003" not in g                               # no lines -> no gold row
    # second run: nothing to do
    assert run_gold(spark, root, ds, st, gold, as_of)["targets"] == 0
    # a new file for one company -> only that company is recomputed
    write_tree(root, {"0100000002/hbb/2023-1.csv": ['"Accounting period end date","2023-12-31"', "70,42"]})
    ds2 = ds.withColumn("filings_done", F.when(F.col("_id") == "0100.000.002",
                                               F.array_union("filings_done", F.array(F.lit("2023-1"))))
                        .otherwise(F.col("filings_done")))
    assert run_gold(spark, root, ds2, st, gold, F.to_timestamp(F.lit("2024-02-01 00:00:00")))["targets"] == 1
    g2 = {r["enterprise_number"]: r for r in sinks.read_table(spark, gold).collect()}
    assert g2["0100.000.002"]["years"][-1]["year"] == 2023
    assert str(g2["0100.000.001"]["last_updated"]).startswith("2024-01-01")
    assert str(g2["0100.000.002"]["last_updated"]).startswith("2024-02-01")


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in sinks.upsert(old, new, "k").collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_gold_from_compacted_lines(spark, tmpdir_path):
    from ledgerlake.sources import filings as S
    root = os.path.join(tmpdir_path, "landed")
    write_tree(root)
    comp = os.path.join(tmpdir_path, "compacted")
    S.compact_filing_lines(spark, root, comp, buckets=4)
    ds = spark.createDataFrame([("0100.000.001", "done", 3, ["2022-1", "2022-2", "2021-9"], [])], STATE)
    st, gold = os.path.join(tmpdir_path, "gs"), os.path.join(tmpdir_path, "g")
    assert run_gold(spark, root, ds, st, gold, F.current_timestamp(), compacted=comp)["targets"] == 1
    g = sinks.read_table(spark, gold).collect()
    assert [r["enterprise_number"] for r in g] == ["0100.000.001"] and len(g[0]["years"]) == 3


def test_upsert_partitions_rewrites_only_touched(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "t")
    first = spark.createDataFrame([("r1", "a", 1), ("r1", "b", 2), ("r2", "c", 3)], "run string, k string, v int")
    sinks.upsert_partitions(first, t, ["run", "k"], "run", os.path.join(tmpdir_path, "s1"))
    change = spark.createDataFrame([("r1", "b", 20), ("r1", "d", 4)], "run string, k string, v int")
    sinks.upsert_partitions(change, t, ["run", "k"], "run", os.path.join(tmpdir_path, "s2"))
    # the same batch again (a replayed epoch) changes nothing
    sinks.upsert_partitions(change, t, ["run", "k"], "run", os.path.join(tmpdir_path, "s3"))
    got = sorted((r["run"], r["k"], r["v"]) for r in spark.read.parquet(t).collect())
    assert got == [("r1", "a", 1), ("r1", "b", 20), ("r1", "d", 4), ("r2", "c", 3)]


def test_upsert_partitions_keeps_partition_text(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "t")
    a = spark.createDataFrame([("001", "k", 1), ("2024-01-01", "k", 2)], "p string, k string, v int")
    sinks.upsert_partitions(a, t, ["p", "k"], "p", os.path.join(tmpdir_path, "s1"))
    b = spark.createDataFrame([("001", "k", 10)], "p string, k string, v int")
    sinks.upsert_partitions(b, t, ["p", "k"], "p", os.path.join(tmpdir_path, "s2"))
    got = sorted(tuple(r) for r in spark.read.schema(b.schema).parquet(t).select("p", "k", "v").collect())
    assert got == [("001", "k", 10), ("2024-01-01", "k", 2)]


def _two_filings(spark, tmpdir_path):
    from tests.test_accounts import write_tree
    root, comp = tmpdir_path + "/landed", tmpdir_path + "/compacted"
    write_tree(root)
    return root, comp


def test_stale_compaction_loses_nothing(spark, tmpdir_path):
    """Filings that landed after the compaction are read and appended once."""
    from ledgerlake.sources import filings as S
    from ledgerlake.sources import sinks
    root, comp = _two_filings(spark, tmpdir_path)
    all_refs = S.read_filing_lines(spark, root).select("enterprise_key", "filing_ref").distinct().orderBy("enterprise_key", "filing_ref").collect()
    late = all_refs[-1]
    early = S.read_filing_lines(spark, root).filter((F.col("enterprise_key") != late[0]) | (F.col("filing_ref") != late[1]))
    S.write_compacted(early, comp, buckets=4)
    assert S.add_missing_filings(spark, root, comp, spark.createDataFrame(all_refs)) == 1
    assert S.add_missing_filings(spark, root, comp, spark.createDataFrame(all_refs)) == 0
    cols = ["enterprise_key", "filing_ref", "line_no", "code", "value"]
    assert (sorted(map(tuple, S.read_compacted_lines(spark, comp).select(*cols).collect()), key=str)
            == sorted(map(tuple, S.read_filing_lines(spark, root).select(*cols).collect()), key=str))
    state, gold = tmpdir_path + "/state-stale", tmpdir_path + "/gold-stale"
    ids = {r[0] for r in all_refs}
    done = {k: [r[1] for r in all_refs if r[0] == k] + ["not-landed"] for k in ids}
    ds = spark.createDataFrame([(k, "done", 1, v, []) for k, v in done.items()],
                               "_id string, status string, filings_count int, filings_done array<string>, filings_migrated array<string>")
    assert run_gold(spark, root, ds, state, gold, compacted=comp)["targets"] == len(ids)
    # only what was read counts as processed; the filing that has not landed keeps its company a target
    for r in sinks.read_table(spark, state).collect():
        assert sorted(r["processed_filings"]) == sorted(x for x in done[r["_id"]] if x != "not-landed")


def test_bucket_counts_must_agree(spark, tmpdir_path):
    import pytest
    from ledgerlake.sources import filings as S
    root, comp = _two_filings(spark, tmpdir_path)
    S.compact_filing_lines(spark, root, comp, buckets=8)
    keys = S.read_filing_lines(spark, root).select("enterprise_key").distinct()
    for wrong in (lambda: S.read_compacted_lines(spark, comp, keys, buckets=64), lambda: S.write_compacted(S.read_filing_lines(spark, root), comp, 64, mode="append")):
        with pytest.raises(ValueError):
            wrong()
    assert S.read_compacted_lines(spark, comp, keys).select("enterprise_key").distinct().count() == keys.count()
    S.compact_filing_lines(spark, root, comp, buckets=2)  # a full rebuild may change the count
    assert S.compacted_buckets(spark, comp) == 2


def test_replaced_table_is_not_overwritten(spark, tmpdir_path):
    import os
    import pytest
    from ledgerlake.sources import sinks
    path = tmpdir_path + "/replaced"
    one = sinks.write_replace(spark.range(1), path)
    sinks.write_replace(spark.range(2), path, expected=one)
    with pytest.raises(sinks.ConflictError):
        sinks.write_replace(spark.range(3), path, expected=one)
    assert sinks.read_table(spark, path).count() == 2
    for n in range(4):
        sinks.write_replace(spark.range(n), path, keep=2)
    assert len([d for d in os.listdir(path) if d.startswith("snap-")]) == 2


def test_read_errors_are_not_taken_for_missing_tables(spark, tmpdir_path):
    import pytest
    from ledgerlake.sources import sinks
    assert sinks.read_table(spark, tmpdir_path + "/nothing") is None
    with pytest.raises(Exception, match="No FileSystem for scheme"):
        sinks.current_snapshot(spark, "nosuchscheme://x/y")
