import os
import random

from ledgerlake.operators import deeds as D
from ledgerlake.operators import pages as P
from ledgerlake.plans.queries_files import FIXTURE_PAGE
from ledgerlake.sources.listings import EVENT_SCHEMA
from ledgerlake.streaming.deed_status import run_to_end

EVENTS = [
    # run, seq, event, documentId, deedDate, description, filename, sizeBytes
    ("r1", 1, "downloading", "A", "2020-01-01", "Statuts", None, None),
    ("r1", 2, "downloaded", "A", "2020-01-01", None, "k_20200101_A.pdf", 10),
    ("r1", 3, "downloaded", "B", "2021-01-01", None, "k_20210101_B.pdf", 20),    # downloaded alone
    ("r1", 4, "downloading", "C", "2019-01-01", "Nomination", None, None),
    ("r1", 5, "download_failed", "C", "2019-01-01", None, None, None),            # stays downloading
    ("r1", 6, "downloading", "A", "1999-01-01", "later", None, None),             # no reset
    ("r1", 7, "error", None, None, None, None, None),
]


def frame(spark, rows):
    full = [(e, d, dd, desc, fn, sz, None, None, None, "boom" if e == "error" else None, None, run, seq)
            for run, seq, e, d, dd, desc, fn, sz in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA)


def table(df):
    return {r["documentId"]: (r["status"], r["deedDate"], r["description"], r["filename"], r["sizeBytes"])
            for r in df.collect()}


def test_deed_status_fold(spark):
    t = table(D.deed_status(frame(spark, EVENTS)))
    assert t["A"] == ("downloaded", "2020-01-01", "Statuts", "k_20200101_A.pdf", 10)
    assert t["B"] == ("downloaded", "2021-01-01", "", "k_20210101_B.pdf", 20)
    assert t["C"] == ("downloading", "2019-01-01", "Nomination", "", 0)
    shuffled = EVENTS[:]
    random.Random(7).shuffle(shuffled)
    assert table(D.deed_status(frame(spark, shuffled))) == t
    s = D.run_summary(frame(spark, EVENTS)).first()
    assert s["final"] == "error" and s["error"] == "boom" and s["n_documents"] == 3 and s["n_downloaded"] == 2


def test_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "events")
    shuffled = EVENTS[:]
    random.Random(3).shuffle(shuffled)
    for i, row in enumerate(shuffled):
        frame(spark, [row]).coalesce(1).write.mode("append").json(src)
    out = run_to_end(spark, src, os.path.join(tmpdir_path, "table"), os.path.join(tmpdir_path, "ckpt"),
                     max_files_per_trigger=2)
    assert table(out) == table(D.deed_status(frame(spark, EVENTS)))


def holders(page):
    return list(P.holders(page, "Functies", frozenset(("QL", "RL"))))


def test_directors_fixture(spark):
    assert holders(FIXTURE_PAGE) == [("Bestuurder", "Doe , Jane", "Sinds 1 januari 2020"), ("Zaakvoerder", "Roe, Ann", "")]
    assert holders("<html><p>no table</p></html>") == [] and holders(None) == []
    df = spark.createDataFrame([("c1", FIXTURE_PAGE), ("c2", "<p/>"), ("c3", None)], "company string, html string")
    rows = P.extract_directors(df).collect()
    assert [(r["company"], r["pos"], r["name"]) for r in rows] == [("c1", 0, "Doe , Jane"), ("c1", 1, "Roe, Ann")]


def test_directors_of_split_headings(spark):
    page = "<TABLE><tr><td><H2>{}</H2></td></tr><tr><td class=QL>a</td><td>b</td></tr></TABLE>"
    pages = [(str(k), page.format(h)) for k, h in enumerate(["Functies", "Func<b>ties</b>", "F&#117;ncties", "Other"])]
    rows = P.extract_directors(spark.createDataFrame(pages, "company string, html string")).collect()
    assert sorted((r["company"], r["role"], r["name"]) for r in rows) == [(k, "a", "b") for k in "012"]


def test_directors_of_odd_pages():
    head = "<tr><td><h2>Mijn Functies</h2></td></tr>"
    assert holders(f"<table>{head}<tr><td class='x RL'>a<td>b  c<td>d</table><table>{head}<tr><td class=QL>no<td>no</table>") == [("a", "b c", "d")]
    assert holders(f"<table><tr><td class=QL>a</td><td>b</td></tr>{head}</table>") == []
    assert holders(f"<table>{head}<tr><td class=QL>a</td><td>b</td></tr><tr><td><h2>X</h2></td></tr>{head}<tr><td class=QL>c</td><td>d</td></tr></table>") == [("a", "b", "")]
    # a table inside a cell: its cells are also cells of the row around it
    assert holders(f"<table>{head}<tr><td class=QL>a<table><tr><td>b</td></tr></table></td><td>c</td></tr></table>") == [("ab", "b", "c")]


def test_stream_keeps_rows_of_null_and_empty_runs(spark, tmpdir_path):
    rows = [(run, *row[1:]) for row in EVENTS for run in ("r1", None, "")]
    random.Random(5).shuffle(rows)
    src = os.path.join(tmpdir_path, "events")
    for lo in range(0, len(rows), 4):
        frame(spark, rows[lo:lo + 4]).coalesce(1).write.mode("append").json(src)
    out = run_to_end(spark, src, os.path.join(tmpdir_path, "table"), os.path.join(tmpdir_path, "ckpt"), max_files_per_trigger=1)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, D.deed_status(frame(spark, rows)).collect()))
    assert out.count() == 9


def test_partial_rows_merge_in_any_order_and_twice(spark):
    rng = random.Random(6)
    for _ in range(3):
        shuffled = rng.sample(EVENTS, len(EVENTS))
        cut = rng.randint(1, len(EVENTS) - 1)
        one, two = (D.deed_partials(frame(spark, part)) for part in (shuffled[:cut], shuffled[cut:]))
        merged = D.merge_partials(D.merge_partials(one.unionByName(two)).unionByName(two))
        assert table(D.deed_table(merged)) == table(D.deed_status(frame(spark, EVENTS)))


def test_pages_reach_the_parser_in_small_batches(spark):
    from tests.test_plans import plan_of
    df = spark.createDataFrame([(f"c{k}", FIXTURE_PAGE) for k in range(250)] + [(None, FIXTURE_PAGE), ("none", None)], "company string, html string")
    got = P.extract_directors(df)
    assert got.count() == 502
    plan = plan_of(got)
    assert "MapInPandas" not in plan and plan.split("== Initial Plan")[0].count("BatchEvalPython") == 1   # no Arrow batch of whole pages; parsed once
    assert sorted(map(tuple, got.filter("company IS NULL").collect())) == [(None, 0, "Bestuurder", "Doe , Jane", "Sinds 1 januari 2020"), (None, 1, "Zaakvoerder", "Roe, Ann", "")]
