"""Phrases, excluded words and index segments against a plain reading of the names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import name_index as NI
from ledgerlake.operators import search as SE
from ledgerlake.sources import sinks

NAMES = "EnterpriseNumber string, denominations array<struct<Denomination:string>>, activities array<struct<NaceCode:string,NaceLabel:string>>, " \
        "addresses array<struct<Zipcode:string,MunicipalityFR:string>>, StatusLabel string, JuridicalFormLabel string"


def companies(spark, names):
    return spark.createDataFrame([(k, None if v is None else [(n,) for n in v], [("55100", "")], [], "", "") for k, v in names.items()], NAMES)


def split(text):
    return [w for w in re.split(r"[^0-9a-z]+", text.lower()) if w]


def holds(names, run):
    return any(w[i:i + len(run)] == run for n in names or [] if n is not None for w in [split(n)] for i in range(len(w)))


def fits(names, q):
    parts = re.findall(r'-?"[^"]*"|[^\s"]+', q)
    minus = [r for p in parts if p[0] == "-" and (r := split(p))]
    phrases = [r for p in parts if p[0] == '"' and (r := split(p))]
    plus = [w for p in parts if p[0] not in '-"' for w in split(p)]
    good = all(holds(names, r) for r in phrases) if phrases else any(holds(names, [w]) for w in plus)
    return good and not any(holds(names, r) for r in minus)


QUERIES = ["a b", '"a b"', '"a b" "c"', '"a b a b"', '"b a" -c', "a -b", 'a -"b c"', "-a", '"a" d', 'd-a', '"a b', "- a", '"" b', '"a-b"', "a --d", '"d d d"', '"zz a"', "a -zz", '"c" -"c"']


def world(seed, n=60):
    r = random.Random(seed)
    names = {f"0{i:03}.000.000": [" ".join(r.choices(["a", "b", "c", "d", "B.", "A-b"], k=r.randint(1, 5))) for _ in range(r.randint(0, 3))] for i in range(n)}
    names["0900.000.000"], names["0901.000.000"], names["0902.000.000"] = None, [None, "a b", ""], ["d", "d d"]
    return names


def answers(hits):
    return sorted((r["query_id"], r["EnterpriseNumber"]) for r in hits.filter(F.col("source") == "token").collect())


def expected(names):
    return sorted((i, k) for i, q in enumerate(QUERIES) for k, v in names.items() if len(q) > 1 and fits(v, q))


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, q string")


def test_text_queries_of_plain_names(spark, batch):
    names = world(1)
    found = SE.search(companies(spark, names), batch, limit=1000)
    assert answers(found) == expected(names)
    # excluded companies do not use up the limit
    few = SE.search(companies(spark, names), batch, limit=2)
    by_query = {}
    for i, k in expected(names):
        by_query.setdefault(i, []).append(k)
    assert answers(few) == sorted((i, k) for i, ks in by_query.items() for k in ks[:2])


def test_index_follows_the_names(spark, batch, tmpdir_path):
    path, names = tmpdir_path + "/names", world(2)
    with pytest.raises(ValueError):
        SE.search_indexed(companies(spark, names), path, batch, limit=5)
    with pytest.raises(ValueError):
        NI.update_name_index(companies(spark, names), path)
    NI.build_name_index(companies(spark, names), path, buckets=4)
    assert not NI.update_name_index(companies(spark, names), path) and len(NI.live_segments(spark, path)) == 1

    def check(now):
        c = companies(spark, now)
        assert answers(SE.search_indexed(c, path, batch, limit=1000)) == expected(now)
        # the postings themselves are those of today's names, not only the candidates' share of them
        live = NI.live_segments(spark, path)
        stored = NI._alive(NI._postings(spark, path, live), spark, path, live)
        fresh = NI.postings(NI.company_names(c)).select(stored.columns)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, fresh.collect()))

    check(names)
    changed = names | {"0001.000.000": ["a b c"], "0950.000.000": ["b a"], "0902.000.000": []}
    del changed["0002.000.000"]
    assert NI.update_name_index(companies(spark, changed), path)
    last = NI.live_segments(spark, path)[-1]["segment"]
    assert {r[0] for r in NI._companies(spark, path, [last]).select("EnterpriseNumber").collect()} == {"0001.000.000", "0002.000.000", "0902.000.000", "0950.000.000"}
    check(changed)
    back = changed | {"0002.000.000": ["d a"], "0001.000.000": names["0001.000.000"]}
    assert NI.update_name_index(companies(spark, back), path) and len(NI.live_segments(spark, path)) == 3
    check(back)
    NI.merge_name_index(spark, path)
    assert len(NI.live_segments(spark, path)) == 1
    check(back)
    assert NI.update_name_index(companies(spark, names), path)
    NI.merge_name_index(spark, path)
    check(names)
    stored = {r[0] for r in spark.read.parquet(f"{path}/companies").select("segment").distinct().collect()}
    listed = {r["segment"] for r in NI._segments(spark, path)[1]}
    assert listed <= stored and len(listed) == 3                # the live one and the two it replaced


def test_two_writers_of_an_index(spark, tmpdir_path, monkeypatch):
    path, names = tmpdir_path + "/names", world(3, 5)
    NI.build_name_index(companies(spark, names), path, buckets=2)
    known, first = NI._write_postings, []

    def meanwhile(*args):
        if not first:
            first.append(1)
            NI.update_name_index(companies(spark, names | {"0990.000.000": ["other"]}), path)
        known(*args)

    monkeypatch.setattr(NI, "_write_postings", meanwhile)
    with pytest.raises(sinks.ConflictError):
        NI.update_name_index(companies(spark, names | {"0991.000.000": ["late"]}), path)


def test_empty_index_and_plan(spark, batch, tmpdir_path):
    none = companies(spark, {"0001.000.000": ["a"]}).limit(0)
    NI.build_name_index(none, tmpdir_path + "/none", buckets=2)
    assert SE.search_indexed(none, tmpdir_path + "/none", batch, limit=5).count() == 0
    NI.build_name_index(companies(spark, world(4)), tmpdir_path + "/some", buckets=4)
    plan = NI.stored_postings(spark, tmpdir_path + "/some", NI.asked_tokens(NI.query_terms(SE.classify(batch))))._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower() and "CartesianProduct" not in plan and "NestedLoop" not in plan
