"""Spelling variants by the trie's frontier (12)."""

import random
import re
from collections import Counter, defaultdict
from zlib import crc32

from pyspark.sql import functions as F

from ledgerlake.llm import spelling

from .helpers import no_docs, odd_docs


def plain_counts(rows, damage=31, min_chars=7):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_chars and n >= 2}


def plain_variants(words):
    """Contract from counts: near words by their strings with one code point left out."""
    near = defaultdict(set)
    shorter = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            shorter[w[:k], w[k + 1:]].add(w)  # replaced at k
            v = w[:k] + w[k + 1:]
            if v in words:
                near[w].add(v)
                near[v].add(w)
    for group in shorter.values():
        for w in group:
            near[w] |= group - {w}
    out = {}
    for w, n in words.items():
        best = min(((-words[v], v) for v in near[w]), default=None)
        form = best[1] if best and -best[0] >= 10 * n else None
        out[w] = (form, n, len(near[w]), words[form] if form else None)
    rows = []
    for w, (form, n, k, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, k, form_n))
    return sorted(rows, key=lambda r: r[0])


def found(docs, **more):
    got = spelling.variants(docs, **more)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()), key=lambda r: r[0])


def corpus():
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 12))) for _ in range(40)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaaaaab", "baaaaaaa", "ÀÉÎÕÜÿß", "ÀÉÎÕÜÿ", "abababab", "babababa", "bababababa"]
    words = []
    for w in base:
        words += [w] * rng.choice([1, 3, 40, 400])
        for _ in range(4):
            k, c = rng.randrange(len(w)), rng.choice("abcdeé")
            words += [rng.choice([w[:k] + w[k + 1:], w[:k] + c + w[k + 1:], w[:k] + c + w[k:]])] * rng.choice([1, 2, 5, 30])
    rng.shuffle(words)
    rows, lo = [], 0
    while lo < len(words):
        n = rng.randint(1, 60)
        rows.append((len(rows), rng.choice([" ", ", ", "1", "\n× "]).join(words[lo:lo + n])))
        lo += n
    return rows


def test_whole_operator_against_brute_force(spark):
    rows = corpus()
    docs = odd_docs(spark).union(spark.createDataFrame([(i + 100, t.title() if i % 3 == 0 else t, None, None, 1.0, "", 1, "", "", 0) for i, t in rows], odd_docs(spark).schema))
    words = plain_counts([(r.doc_id, r.text) for r in docs.collect()])
    want = plain_variants(words)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] != (r[1] or r[0]) for r in want)
    assert found(docs.repartition(3), damage=31) == want


def test_words_of_one_letter_and_long_ones(spark):
    """Beginnings shared to the end, edits at both ends and in the middle of long words."""
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(50))
    words = ["x" * n for n in range(7, 18)] + [long, long[:-1], long[1:], long[:25] + "z" + long[26:], long + "zz", "x" * 10 + "y" + "x" * 5]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    got = {tuple(sorted(r)) for r in spelling.neighbours(table).collect()}
    assert got == {(w, v) for w, *_ in plain_variants({w: 1 for w in words}) for v in words if w < v and near(w, v)}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def test_a_run_across_steps(monkeypatch, spark):
    monkeypatch.setattr(spelling, "STEP", 5)
    text = "abc defghijklmnop, qrstuvwxyzÀÿ7ijklmnop"
    assert [w for x in spelling.runs(text, 7) for w in x] == re.findall("[A-Za-zÀ-ÿ]{7,}", text)


def test_no_words(spark):
    assert found(no_docs(spark)) == []
    assert found(odd_docs(spark, ["short words only", "singular", None])) == []
    one = found(odd_docs(spark, ["singular singular", None]))
    assert one == [("singular", None, "singular", 2, 0, None)]
    counts = spelling.word_counts(odd_docs(spark, ["singular Singular", None]), 7, 1, None)
    assert counts.filter(F.col("word") == "singular").first().n == 2
