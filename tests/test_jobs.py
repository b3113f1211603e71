"""End to end: register CSV files -> bronze -> silver -> targets -> (state
after a deposit run) -> gold from a landed tree, through the job stages."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake import jobs
from ledgerlake.operators import targets as T
from ledgerlake.sources import sinks
from tests.test_accounts import write_tree

REGISTER = {
    "enterprise": (["EnterpriseNumber", "Status", "JuridicalSituation", "TypeOfEnterprise", "JuridicalForm",
                    "StartDate"],
                   [["0100.000.001", "AC", "000", "2", "014", "03-02-2010"],
                    ["0100.000.002", "AC", "000", "2", "", "01-01-2000"],
                    ["0100.000.003", "AC", "000", "2", "110", "01-01-2000"]]),
    "activity": (["EntityNumber", "ActivityGroup", "NaceVersion", "NaceCode", "Classification"],
                 [["0100.000.001", "001", "2008", "55100", "MAIN"], ["0100.000.002", "001", "2003", "55204", "MAIN"],
                  ["0100.000.003", "001", "2008", "55100", "MAIN"]]),
    "address": (["EntityNumber", "TypeOfAddress", "Zipcode", "MunicipalityFR", "MunicipalityNL", "StreetFR",
                 "StreetNL", "HouseNumber"],
                [["0100.000.001", "REGO", "1000", "Bruxelles", "Brussel", "", "Nieuwstraat", "5"]]),
    "branch": (["Id", "StartDate", "EnterpriseNumber"], []),
    "contact": (["EntityNumber", "EntityContact", "ContactType", "Value"], []),
    "denomination": (["EntityNumber", "Language", "TypeOfDenomination", "Denomination"],
                     [["0100.000.001", "2", "002", "HA"], ["0100.000.001", "2", "001", "Hotel Alpha"], ["0100.000.001", "2", "1", "Hotel A"]]),
    "establishment": (["EstablishmentNumber", "StartDate", "EnterpriseNumber"], []),
    "code": (["Category", "Code", "Language", "Description"],
             [["Nace2008", "55100", "FR", "Hôtels"], ["Status", "AC", "FR", "Actif"],
              ["JuridicalForm", "014", "FR", "Société anonyme"]]),
    "meta": (["Variable", "Value"], [["Version", "1"]]),
}


def write_register(folder):
    os.makedirs(folder, exist_ok=True)
    for name, (header, rows) in REGISTER.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", newline="", encoding="utf-8") as fh:
            w = csv.writer(fh, quoting=csv.QUOTE_ALL)
            w.writerow(header)
            w.writerows(rows)


def test_pipeline(spark, tmpdir_path):
    reg, lake, landed = (os.path.join(tmpdir_path, x) for x in ("register", "lake", "landed"))
    write_register(reg)
    write_tree(landed)
    assert jobs.bronze(spark, lake, reg)["enterprise"] == "loaded"
    assert jobs.bronze(spark, lake, reg)["enterprise"] == "kept"
    jobs.silver(spark, lake)
    s = {r["EnterpriseNumber"]: r for r in sinks.read_table(spark, f"{lake}/silver/companies").collect()}
    assert s["0100.000.001"]["JuridicalFormLabel"] == "Société anonyme"
    assert [d["Denomination"] for d in s["0100.000.001"]["denominations"]] == ["Hotel Alpha", "Hotel A", "HA"]
    jobs.targets(spark, lake)
    state = sinks.read_table(spark, f"{lake}/state/download")
    assert sorted(r["_id"] for r in state.collect()) == ["0100.000.001", "0100.000.002"]
    assert jobs.gold(spark, lake, landed)["targets"] == 0          # nothing downloaded yet
    outcomes = spark.createDataFrame(
        [("0100.000.001", "success", ["2022-1", "2022-2", "2021-9"], []),
         ("0100.000.002", "success", ["2021-1", "2021-2", "2021-3"], [])],
        "_id string, result string, new_done array<string>, new_migrated array<string>")
    sinks.write_replace(T.state_apply(state, outcomes), f"{lake}/state/download")
    jobs.compact(spark, lake, landed, buckets=4)
    assert jobs.gold(spark, lake, landed, use_compacted=True)["targets"] == 2
    g = {r["enterprise_number"]: r for r in sinks.read_table(spark, f"{lake}/gold/accounts").collect()}
    assert sorted(g) == ["0100.000.001", "0100.000.002"]
    assert [y["year"] for y in g["0100.000.002"]["years"]] == [2021, 2021]
    assert jobs.gold(spark, lake, landed)["targets"] == 0


def test_register_csv_with_bom_and_null_tokens(spark, tmpdir_path):
    from ledgerlake.sources import register as R
    folder = os.path.join(tmpdir_path, "reg")
    os.makedirs(folder)
    with open(os.path.join(folder, "enterprise.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write('"EnterpriseNumber","JuridicalForm","StartDate"\n"0100.000.001","014","NA"\n"0100.000.002","",""\n')
    t = R.load_register(spark, folder)
    assert list(t) == ["enterprise"]
    rows = sorted(t["enterprise"].collect(), key=lambda r: r["EnterpriseNumber"])
    assert rows[0]["JuridicalForm"] == "014" and rows[0]["StartDate"] is None
    assert rows[1]["JuridicalForm"] is None


def test_command_line_stages(spark, tmpdir_path, capsys):
    reg, lake = os.path.join(tmpdir_path, "register"), os.path.join(tmpdir_path, "lake")
    write_register(reg)
    jobs.main(["bronze", "--root", lake, "--register-dir", reg])
    jobs.main(["silver", "--root", lake])
    out = capsys.readouterr().out
    assert "loaded" in out and "snap-" in out
    assert sinks.read_table(spark, f"{lake}/silver/companies").count() == 3


def test_quoted_line_breaks_stay_in_their_row(spark, tmpdir_path):
    from ledgerlake.sources import register as R
    folder = os.path.join(tmpdir_path, "reg-lines")
    os.makedirs(folder)
    with open(os.path.join(folder, "denomination.csv"), "w", encoding="utf-8") as fh:
        fh.write('"EntityNumber","Denomination"\n"1","Hotel\nParis"\n"2","say ""hi"",\n\nyou"\n')
    rows = R.load_register(spark, folder)["denomination"].orderBy("_seq").collect()
    assert [(r["EntityNumber"], r["Denomination"]) for r in rows] == [("1", "Hotel\nParis"), ("2", 'say "hi",\n\nyou')]


def _listing(folder, key, refs):
    import json
    os.makedirs(os.path.join(folder, key), exist_ok=True)
    content = [{"reference": r, "periodEndDate": d, "depositDate": d, "migration": m} for r, d, m in refs]
    with open(os.path.join(folder, key, "p1.json"), "w") as fh:
        fh.write(json.dumps({"content": content}))


def test_deposit_run_reaches_gold(spark, tmpdir_path):
    """targets -> deposits -> claim -> apply -> check -> gold, without a hand-written state."""
    reg, lake, landed, listings = (os.path.join(tmpdir_path, "run", x) for x in ("register", "lake", "landed", "listings"))
    write_register(reg)
    write_tree(landed)
    _listing(listings, "0100000001", [("2022-1", "2022-12-31", False), ("2022-2", "2022-06-30", False), ("old", "2001-01-01", False), ("mig", "2022-03-31", True)])
    _listing(listings, "0100000002", [("2021-1", "2021-12-31", False), ("not-landed", "2021-11-30", False)])
    _listing(listings, "0999999999", [("x", "2022-12-31", False)])      # no target
    jobs.bronze(spark, lake, reg)
    jobs.silver(spark, lake)
    jobs.targets(spark, lake)
    jobs.deposits(spark, lake, listings, per_company=20)
    todo = {(r["company"], r["reference"]): r["route"] for r in sinks.read_table(spark, f"{lake}/deposits/todo").collect()}
    assert todo == {("0100.000.001", "2022-1"): "fetch", ("0100.000.001", "2022-2"): "fetch", ("0100.000.001", "mig"): "migrated",
                    ("0100.000.002", "2021-1"): "fetch", ("0100.000.002", "not-landed"): "fetch"}
    jobs.claim(spark, lake, 10)
    jobs.apply(spark, lake, landed)
    state = {r["_id"]: r for r in sinks.read_table(spark, f"{lake}/state/download").collect()}
    assert state["0100.000.001"]["status"] == "done" and sorted(state["0100.000.001"]["filings_done"]) == ["2022-1", "2022-2"]
    assert state["0100.000.001"]["filings_migrated"] == ["mig"]
    assert state["0100.000.002"]["status"] == "pending"                  # one of its filings has not landed
    assert jobs.gold(spark, lake, landed)["targets"] == 1
    gold = {r["enterprise_number"]: r for r in sinks.read_table(spark, f"{lake}/gold/accounts").collect()}
    assert list(gold) == ["0100.000.001"] and len(gold["0100.000.001"]["years"]) == 3   # all of its files count
    # the missing file lands: the next run takes the company up again
    write_tree(landed, {"0100000002/hbb/not-landed.csv": ['"Accounting period end date","2021-11-30"', "70,1"]})
    jobs.claim(spark, lake, 10)
    jobs.apply(spark, lake, landed)
    assert jobs.gold(spark, lake, landed)["targets"] == 1
    # a file is lost afterwards: its ref is to be fetched again
    os.remove(os.path.join(landed, "0100000001/hbb/2022-2.csv"))
    jobs.check(spark, lake, landed)
    state = {r["_id"]: r for r in sinks.read_table(spark, f"{lake}/state/download").collect()}
    assert state["0100.000.001"]["status"] == "pending" and state["0100.000.001"]["filings_done"] == ["2022-1"]
    assert state["0100.000.002"]["status"] == "done"
    # the stream builds gold of done companies only, and records what it read
    jobs.gold_stream(spark, lake, landed, available_now=True, buckets=4).awaitTermination()
    assert {r["enterprise_number"] for r in spark.read.parquet(f"{lake}/gold/stream").collect()} == {"0100.000.002"}
    processed = {r["_id"]: r["processed_filings"] for r in sinks.read_table(spark, f"{lake}/state/gold_stream").collect()}
    assert processed == {"0100.000.002": ["2021-1", "2021-2", "2021-3", "not-landed"]}

    # the other company becomes done after its files landed; nothing new lands
    def stream():
        jobs.gold_stream(spark, lake, landed, available_now=True, buckets=4).awaitTermination()
        return {r["enterprise_number"]: r for r in spark.read.parquet(f"{lake}/gold/stream").collect()}

    now = sinks.read_table(spark, f"{lake}/state/download")
    sinks.write_replace(now.withColumn("status", F.lit("done")), f"{lake}/state/download")
    built = stream()
    assert sorted(built) == ["0100.000.001", "0100.000.002"] and len(built["0100.000.001"]["years"]) == 2
    # a filing is written again with another amount: the old content counts no more
    write_tree(landed, {"0100000001/hbb/2021-9.csv": ['"Accounting period end date","2021-12-31"', "70/74,999", "60/64,100", "54,5", "43,10"]})
    again = stream()
    assert [y["ca"] for y in again["0100.000.001"]["years"] if y["year"] == 2021] == [999]
    assert again["0100.000.002"] == built["0100.000.002"]


def test_a_company_without_a_listing_is_not_done(spark, tmpdir_path):
    reg, lake, landed, listings = (os.path.join(tmpdir_path, "unlisted", x) for x in ("register", "lake", "landed", "listings"))
    write_register(reg)
    write_tree(landed)
    _listing(listings, "0100000001", [])                                # a listing without deposits
    jobs.bronze(spark, lake, reg)
    jobs.silver(spark, lake)
    jobs.targets(spark, lake)
    jobs.claim(spark, lake, 10)
    with pytest.raises(RuntimeError):
        jobs.apply(spark, lake, landed)
    jobs.deposits(spark, lake, listings, per_company=20)
    jobs.apply(spark, lake, landed)
    state = {r["_id"]: r["status"] for r in sinks.read_table(spark, f"{lake}/state/download").collect()}
    assert state == {"0100.000.001": "done", "0100.000.002": "pending"}


def test_directors_and_index_jobs(spark, tmpdir_path):
    from ledgerlake.operators import search as SE
    from ledgerlake.plans.queries_files import FIXTURE_PAGE
    reg, lake, pages = (os.path.join(tmpdir_path, "dirs", x) for x in ("register", "lake", "pages"))
    write_register(reg)
    os.makedirs(pages)
    for key, page in (("0100000001", FIXTURE_PAGE), ("0100000002", "<p>none</p>"), ("0777777777", FIXTURE_PAGE)):
        with open(os.path.join(pages, f"{key}.html"), "w") as fh:
            fh.write(page)
    for stage in (lambda: jobs.bronze(spark, lake, reg), lambda: jobs.silver(spark, lake), lambda: jobs.targets(spark, lake)):
        stage()
    jobs.directors(spark, lake, pages)
    cache = {r["_id"]: [d["name"] for d in r["directors"]] for r in sinks.read_table(spark, f"{lake}/directors/cache").collect()}
    assert cache == {"0100.000.001": ["Doe , Jane", "Roe, Ann"], "0100.000.002": []}
    jobs.index(spark, lake, buckets=4)
    companies = sinks.read_table(spark, f"{lake}/silver/companies")
    q = spark.createDataFrame([(1, "alpha")], "query_id int, q string")
    assert [r["EnterpriseNumber"] for r in SE.search_indexed(companies, f"{lake}/index/names", q, limit=5).collect()] == ["0100.000.001"]
    # a second run of the stage indexes nothing if no name changed
    jobs.index(spark, lake, buckets=4)
    assert len(SE.NI.live_segments(spark, f"{lake}/index/names")) == 1
    # the stages answer a batch of queries, and store profiles of the written tables
    asked = os.path.join(tmpdir_path, "dirs", "queries")
    spark.createDataFrame([(1, "alpha"), (2, "0100000001"), (3, "al.h.*"), (4, "alpha$")], "query_id long, q string").write.json(asked)
    jobs.search(spark, lake, asked)
    answers = {(r["query_id"], r["EnterpriseNumber"], r["source"]) for r in sinks.read_table(spark, f"{lake}/search/answers").collect()}
    assert {(1, "0100.000.001", "token"), (2, "0100.000.001", "number")} <= answers and (3, "0100.000.001", "regex") in answers
    with pytest.raises(RuntimeError):
        jobs.profiles(spark, lake)
    landed = os.path.join(tmpdir_path, "dirs", "landed")
    write_tree(landed)
    state = sinks.read_table(spark, f"{lake}/state/download")
    outcomes = spark.createDataFrame([("0100.000.001", "success", ["2022-1"], [])], "_id string, result string, new_done array<string>, new_migrated array<string>")
    sinks.write_replace(T.state_apply(state, outcomes), f"{lake}/state/download")
    jobs.gold(spark, lake, landed)
    jobs.profiles(spark, lake)
    stored = sinks.read_table(spark, f"{lake}/profiles")
    assert stored.count() == companies.count()
    assert {r["EnterpriseNumber"] for r in stored.filter("size(gold_data.years) > 0").collect()} == {"0100.000.001"}


def test_deed_run_reaches_cached_files(spark, tmpdir_path):
    """silver -> deed targets -> deeds -> claim -> apply -> cached files, and the summary of runs."""
    import json
    reg, lake, listings, files, events = (os.path.join(tmpdir_path, "deeds", x) for x in ("register", "lake", "listings", "files", "events"))
    write_register(reg)
    for key, deeds in (("0100000001", [("d1", "2020-01-02", "DONE"), ("d2", None, "DONE"), ("d3", "2020-01-04", "PENDING")]),
                       ("0100000002", []), ("0777777777", [("x", "2020-01-01", "DONE")])):
        os.makedirs(os.path.join(listings, key))
        for page, part in enumerate((deeds[:1], deeds[1:])):
            with open(os.path.join(listings, key, f"p{page}.json"), "w") as fh:
                fh.write(json.dumps({"statutes": [{"documentId": d, "deedDate": t, "documentStatus": s} for d, t, s in part], "totalItems": len(deeds)}))
    os.makedirs(files)

    def land(name):
        with open(os.path.join(files, name), "wb") as fh:
            fh.write(b"%PDF")

    def rows(*name):
        return sinks.read_table(spark, "/".join([lake, *name])).collect()

    land("0100000001_20200102_d1.pdf")
    jobs.bronze(spark, lake, reg)
    jobs.silver(spark, lake)
    jobs.deed_targets(spark, lake)
    jobs.deed_targets(spark, lake)                                       # a second run adds nothing
    assert sorted((r["_id"], r["status"], r["acts_count"]) for r in rows("state", "deeds")) == [("0100.000.001", "pending", 0), ("0100.000.002", "pending", 0)]
    jobs.deeds_claim(spark, lake, 10)
    with pytest.raises(RuntimeError):
        jobs.deeds_apply(spark, lake, files)
    jobs.deeds(spark, lake, listings, files)
    assert {(r["documentId"], r["filename"], r["route"]) for r in rows("deeds", "todo")} == {
        ("d1", "0100000001_20200102_d1.pdf", "have_file"), ("d2", "0100000001_unknown_d2.pdf", "fetch")}
    jobs.deeds_apply(spark, lake, files)                                 # one file lacks; the other company has no deeds
    assert sorted((r["_id"], r["status"], r["acts_done"]) for r in rows("state", "deeds")) == [
        ("0100.000.001", "pending", ["d1"]), ("0100.000.002", "done", [])]
    land("0100000001_unknown_d2.pdf")
    jobs.deeds(spark, lake, listings, files)
    assert [(r["documentId"], r["route"]) for r in rows("deeds", "todo")] == [("d2", "have_file")]
    jobs.deeds_claim(spark, lake, 10)
    jobs.deeds_apply(spark, lake, files)
    assert sorted((r["_id"], r["status"], r["acts_count"], r["acts_done"]) for r in rows("state", "deeds")) == [
        ("0100.000.001", "done", 2, ["d1", "d2"]), ("0100.000.002", "done", 0, [])]
    jobs.deeds_cached(spark, lake, files)
    assert sorted((r["_id"], r["doc_id"], r["deed_date"], r["files_count"]) for r in rows("deeds", "cached")) == [
        ("0100.000.001", "d1", "20200102", 2), ("0100.000.001", "d2", "unknown", 2)]
    assert rows("deeds", "left") == []
    os.makedirs(events)
    with open(os.path.join(events, "e.json"), "w") as fh:
        for e in ({"event": "downloading", "documentId": "d1", "run": "r", "seq": 1}, {"event": "downloaded", "documentId": "d1", "run": "r", "seq": 2},
                  {"event": "done", "total": 1, "downloaded": 1, "run": "r", "seq": 3}):
            fh.write(json.dumps(e) + "\n")
    jobs.deeds_summary(spark, lake, events)
    assert [(r["run"], r["final"], r["n_downloaded"]) for r in rows("deeds", "summary")] == [("r", "done", 1)]
    with pytest.raises(SystemExit):
        jobs.main(["deeds-apply", "--root", lake])
