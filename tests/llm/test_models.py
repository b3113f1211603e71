"""Language mixtures (3), quality rules (5), URL trees (8), subword lattices (9)."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid, lattice, quality, urls
from ledgerlake.llm.common import id_remainder, tokenizer_path

from .helpers import ODD_TEXTS, no_docs, odd_docs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(docs, id_remainder("doc_id", 3) != 1)


def test_language_held_out_accuracy(spark, languages):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(id_remainder("doc_id", 3) == 1)
    out = langid.identify(docs, languages).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert out[0] > 0.98 and 0 <= out[1] <= out[2] <= 1


def test_language_mixture_proportions(spark, languages):
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars BETWEEN 2000 AND 4000").orderBy("doc_id").collect()
    one = {lang: next(r.text for r in rows if r.lang == lang) for lang in ("en", "fr", "de")}
    mix = one["en"][:1500] + "\n" + one["fr"][:500]
    pi = dict(zip(languages.languages, langid.mixtures(languages, [mix, one["de"]])[0]))
    assert abs(pi["en"] - 0.75) < 0.08 and abs(pi["fr"] - 0.25) < 0.08 and pi["de"] < 0.03
    # the bound that spares iterations doesn't change what the penalised likelihood chooses
    free = langid.mixtures(languages, [one["de"]], penalty=0.0)[0]
    assert free.argmax() == languages.languages.index("de")


def test_language_odd_rows(spark, languages):
    got = {r.doc_id: r for r in langid.identify(odd_docs(spark), languages).collect()}
    for k, text in enumerate(ODD_TEXTS):
        assert (got[k].lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= got[k].score <= 1
    assert {"shard", "word", "label"} <= set(langid.identify(odd_docs(spark), languages).columns)
    assert langid.identify(no_docs(spark), languages).count() == 0
    untaught = langid.train(no_docs(spark), F.lit(True))
    assert {r.lang_pred for r in langid.identify(odd_docs(spark), untaught).collect()} == {"und"}


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.score(docs, labels, id_remainder("doc_id", 4) != 2).join(labels, "doc_id").filter(id_remainder("doc_id", 4) == 2).collect()
    good, bad = [r.score for r in out if r.quality == 1], [r.score for r in out if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95 and all(r.predicted == int(r.score >= 0.7) for r in out)


def test_quality_rules_are_the_columns(spark):
    """The compiled expression gives what the rules give by hand."""
    rules = ((((0, ">", 1.0),), 0.8), (((0, "<=", 3.0), (2, ">", 0.5)), -1.5))
    model = quality.RuleEnsemble(0.2, rules)
    n = len(quality.STATISTICS)
    rows = [[float((k * 7 + c) % 5) for c in range(n)] for k in range(20)]
    df = spark.createDataFrame(rows, ", ".join(f"{s} double" for s in quality.STATISTICS))
    got = [r[0] for r in df.select(model.score()).collect()]
    for row, score in zip(rows, got):
        total = 0.2 + sum(w for rule, w in rules if all(row[f] <= t if op == "<=" else row[f] > t for f, op, t in rule))
        assert abs(score - 1 / (1 + math.exp(-total))) < 1e-12


def test_labelled_rows_by_bitmap(spark, monkeypatch):
    """No labelled row is lost; with few bits others come along; texts are not shuffled."""
    docs = odd_docs(spark, [f"text {k}" for k in range(400)])
    labels = spark.createDataFrame([(k, (1, 0, None, 1)[k % 4]) for k in range(0, 300, 3)] + [(None, 1), (5, None)], "doc_id long, quality int")
    want = {k for k in range(0, 300, 3) if k % 4 != 2 and k % 5}
    use = F.col("doc_id") % 5 != 0
    got = quality.labelled(docs, labels, use)
    rows = [r.doc_id for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(quality, "LABEL_BITS", 64)
    rows = {r.doc_id for r in quality.labelled(docs, labels, use).collect()}
    assert want <= rows
    assert quality.labelled(no_docs(spark), labels, use).count() == 0 == quality.labelled(docs, labels.limit(0), use).count()


def test_tree_paths():
    text = "T\n  If (feature 1 <= 0.5)\n   If (feature 1 <= 0.2)\n    Predict: 1.0\n   Else (feature 1 > 0.2)\n    Predict: 0.0\n  Else (feature 1 > 0.5)\n   Predict: 0.0"
    assert quality.tree_paths(text) == {((1, "<=", 0.5),), ((1, "<=", 0.2),), ((1, "<=", 0.5), (1, ">", 0.2)), ((1, ">", 0.5),)}


def test_quality_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(5)] + [(3, 1, 0), (None, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    out = quality.score(docs, labels, F.lit(True)).collect()
    assert len(out) == docs.count() and {(r.score, r.predicted) for r in out} == {(1.0, 1)}
    assert {r.score for r in quality.score(docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert quality.score(no_docs(spark), labels, F.lit(True)).count() == 0
    both = spark.createDataFrame([(k, k % 2, 0) for k in range(12)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in quality.score(docs, both, F.lit(True)).collect())


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
@pytest.mark.parametrize("n", [30, 41, 55, 60, 61, 75, 80, 100, 119])
def test_windows_reach_the_end_and_across_borders(n):
    plain = [f"word{k}" for k in range(n)]
    at = {s: k for k, s in enumerate(quality.STATISTICS)}
    tail, share = min(10, n), min(40, n)
    got = quality.statistics(" ".join(plain[:-tail] + ["QUITE"] * tail).encode())
    letters = 4 * (share - tail) + 5 * tail
    assert got[at["worst_upper"]] >= 5 * tail / letters - 1e-12 and got[at["worst_repeats"]] >= (tail - 1) / share - 1e-12
    assert quality.statistics(" ".join(plain[:-tail] + ["{}"] * tail).encode())[at["worst_symbols"]] > 0
    if n >= 80:  # a burst on both sides of word 40
        assert quality.statistics(" ".join(plain[:30] + ["QUITE"] * 20 + plain[50:]).encode())[at["worst_upper"]] >= 100 / 180 - 1e-12


def test_long_symbol_words():
    got = quality.statistics(b"some words " + b"-" * 8 + b" and more " + b"=" * 80)
    assert got[quality.STATISTICS.index("single_symbols")] == 2 / 6


URLS = {
    0: ("HTTP://A.Example.ORG/es/x?y=1#z", "a.example.org", "/es/x", "example.org/es/"), 1: ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1"),
    2: ("http://notexample.org/es/", "notexample.org", "/es/", "org/"), 3: ("https://x.com/fr/", "x.com", "/fr/", "com/fr/"), 4: ("https://x.com/de/a", "x.com", "/de/a", "com/de/"),
    5: ("https://x.com?u=http://y.org/", "x.com", "", None), 6: ("https://org", "org", "", None), 7: (None, "", "", None), 8: ("no scheme/de/", "", "", None), 9: ("", "", "", None),
    10: ("a://b.org/p#q?r", "b.org", "/p", "org/"), 11: ("x://dorg/de/", "dorg", "/de/", None), 12: ("x://h://k.org/", "h:", "//k.org/", None), 13: ("x://" + "a" * 5000 + ".com/de/" + "b/" * 3000, None, None, "com/de/"),
}


def test_url_rules(spark):
    rows = [(k, u[0], "other", "host?") for k, u in URLS.items()] + [(0, URLS[0][0], "again", None), (None, "http://x.org/", None, None)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, verdict string, host string"), RULES).collect()
    assert len(got) == len(rows)
    verdict = {rule: v for v, rule in RULES}
    for r in got:
        if r.page_id in URLS:
            _, host, path, rule = URLS[r.page_id]
            assert r.rule == rule and (host is None or (r.host, r.path) == (host, path))
        assert r.verdict == (verdict[r.rule] if r.rule else r.verdict) and r.verdict in ("allow", "block")


def test_url_trees_learn(spark):
    rows = [(k, f"https://s{k % 7}.example.{'com' if k % 2 else 'org'}/{'de' if k % 3 else 'fr'}/{k}{'?a=1&b=2' if k % 3 else ''}") for k in range(300)]
    rows += [(1000 + k, f"https://s{k % 7}.example.net/{'de' if k % 2 else 'fr'}/{k + 100}{'?a=1&b=2' if k % 2 else ''}") for k in range(40)]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), [("allow", "com/fr/"), ("block", "com/de/"), ("allow", "org/fr/"), ("block", "org/de/")]).filter("rule IS NULL").collect()
    assert len(out) == 40 and sum((r.verdict == "block") == ("/de/" in r.path) for r in out) >= 38


def test_url_rates_of_many_domains(spark):
    """Thousands of domains, each with a rate of its own: only that tells the URLs without a rule apart."""
    kind = lambda k: "ab"[zlib.crc32(str(k).encode()) % 2]
    rows = [(k * 10 + j, f"https://d{10000 + k}.com/{kind(k)}{100000 + k * 10 + j}") for k in range(3000) for j in range(3)]
    rows += [(100_000 + k, f"https://d{10000 + k}.com/c{100000 + k}") for k in range(3000)]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), [("block", "com/a"), ("allow", "com/b")]).filter("rule IS NULL").collect()
    assert len(out) == 3000
    assert sum((r.verdict == "block") == (kind(r.page_id - 100_000) == "a") for r in out) >= 2990


def test_urls_without_labels(spark):
    some = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urls.judge(some, RULES).collect()} == {"allow"}
    assert {r.verdict for r in urls.judge(some, [("block", "a.net/")]).collect()} == {"block"}
    assert urls.judge(some.limit(0), RULES).count() == 0
    assert {r.verdict for r in urls.judge(some, []).collect()} == {"allow"}


PIECES = tokenizer_path("piece_bpe_32k.model")


def plain_lattice(log, word):
    text, f = b" " + word, [0.0]
    for j in range(1, len(text) + 1):
        parts = [f[i] + log[text[i:j]] for i in range(max(0, j - 40), j) if text[i:j] in log]
        top = max(parts)
        f.append(top + math.log(sum(math.exp(p - top) for p in parts)))
    return f[-1]


def test_lattice_recursion():
    v = lattice.Pieces.load(PIECES)
    log = dict(zip(v.pieces, v.logs))
    assert abs(sum(map(math.exp, log.values())) - 1) < 1e-9
    words = [b"the", b"thntinorsh", "éèaipa".encode(), b"a", b"\xff\xfe", b"x" * 300, b"the"]
    got, uses = lattice.lattices(v, words, counts=True)
    assert np.allclose(got, [plain_lattice(log, w) for w in words])
    # expected uses: every segmentation of a word has its bytes once
    sizes = np.array([len(p) for p in v.pieces])
    assert abs((uses * sizes).sum() - sum(len(w) + 1 for w in words)) < 1e-6


def test_expectation_maximisation_raises_likelihood(spark):
    words = spark.createDataFrame([(bytearray(w),) for w in (b"thntin", b"thnt", b"inthnt", b"tinth")], "word binary")
    v = lattice.Pieces.load(PIECES)
    learnt = lattice.learn(words, v, rounds=2)
    ws = [bytes(r.word) for r in words.collect()]
    assert lattice.lattices(learnt, ws)[0].sum() > lattice.lattices(v, ws)[0].sum()


@pytest.mark.parametrize("held", ["id", "all", "none"])
def test_lm_scores(spark, held, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK_WORDS", 3)
    docs = odd_docs(spark)
    flag = {"id": id_remainder("doc_id", 7) == 2, "all": F.lit(True), "none": F.lit(False)}[held]
    got = lattice.score(docs, flag, PIECES).collect()
    rows = docs.select("doc_id", "text", flag.alias("h")).collect()
    counts = Counter()
    for r in rows:
        if not r.h:
            counts.update((r.text or "").encode().lower().split())
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    want = {}
    for r in rows:
        tokens = [*(r.text or "").encode().lower().split(), None]
        want[r.doc_id] = (r.h, len(tokens), sum(counts[t] > 0 for t in tokens), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
    for r in got:
        h, tokens, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, tokens, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and math.isfinite(r.score) and r.score <= 0
        assert math.isfinite(r.mixed_score) and r.mixed_score <= 0
    assert lattice.score(no_docs(spark), F.lit(False), PIECES).count() == 0


def segmentations(log, text):
    """The log-probability of every way to cut ``text`` into pieces, one by one."""
    if not text:
        yield 0.0
    for n in range(1, len(text) + 1):
        if text[:n] in log:
            for rest in segmentations(log, text[n:]):
                yield log[text[:n]] + rest


@pytest.mark.parametrize("rounds", [0, 1])
def test_scores_are_sums_over_all_segmentations(spark, rounds):
    """The operator's ``score`` of whole texts against every segmentation listed singly
    (short texts) and a plain recursion over the whole text (odd and long ones)."""
    short = ["the hat", "a  b", "hat the hat", "", None, "the", "élan"]
    docs = odd_docs(spark, short + ODD_TEXTS)
    held = F.col("doc_id") % 3 == 2
    got = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): r for r in lattice.score(docs, held, PIECES, rounds).collect()}
    rows = docs.select("doc_id", "text", held.alias("h")).collect()
    taught = [(r.text or "").encode().lower().split() for r in rows if not r.h]
    v = lattice.Pieces.load(PIECES)
    if rounds:
        distinct = sorted({w for t in taught for w in t})
        v = lattice.learn(spark.createDataFrame([(bytearray(w),) for w in distinct], "word binary"), v, rounds)
    log = dict(zip(v.pieces, v.logs))
    stop = (len(taught) + 0.5) / (sum(len(t) + 1 for t in taught) + 1)
    checked = 0
    for r in got.values():
        texts = [x.text or "" for x in rows if x.doc_id == r.doc_id and len((x.text or "").encode().split()) + 1 == r.n_tokens]
        wants = set()
        for text in texts:
            words = text.encode().lower().split()
            whole = b"".join(b" " + w for w in words)
            total = plain_lattice(log, whole[1:]) if words else 0.0
            if words and len(whole) <= 14:
                assert abs(total - math.log(sum(map(math.exp, segmentations(log, whole))))) < 1e-9
                checked += 1
            wants.add(total / math.log(10) + len(words) * math.log10(1 - stop) + math.log10(stop))
        assert any(abs(r.score - w) < 1e-6 * max(1, abs(w)) for w in wants)
    assert checked >= 4


def test_remainder(spark):
    df = spark.createDataFrame([(k,) for k in range(50)] + [(None,)], "doc_id long").select("doc_id", id_remainder("doc_id", 7).alias("m"))
    assert all(r.m == (zlib.crc32(str(r.doc_id).encode()) % 7 if r.doc_id is not None else 0) for r in df.collect())


def test_numerals_are_no_letters(spark, languages):
    rows = odd_docs(spark, ["½ ② Ⅷ", "١٢٣ 4", "½ a"])
    got = {r.doc_id: r for r in langid.identify(rows, languages).filter("doc_id IS NOT NULL").collect()}
    assert [(got[k].lang_pred, got[k].score) for k in (0, 1)] == [("und", 0.0)] * 2 and got[2].lang_pred != "und"


def test_long_texts_are_counted_in_steps(spark, languages, monkeypatch):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdé  \n1.中")) for _ in range(n)) for n in (1, 3, 40, 400, 3000)] + ["a", "  a  ", "x" * 500, " " * 300 + "a"]
    texts = [t for t in texts if langid.LETTER.search(t)] + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).collect()]
    whole, shares = [langid.counts(t) for t in texts], langid.mixtures(languages, texts)
    monkeypatch.setattr(langid, "STEP", 7)
    assert all((langid.counts(t) == n).all() for t, n in zip(texts, whole))
    assert np.allclose(langid.mixtures(languages, texts), shares, atol=1e-4)
