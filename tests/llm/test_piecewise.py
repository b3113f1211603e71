"""Context-triggered piecewise hashing (13)."""

import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import piecewise as P

from .helpers import ODD_TEXTS, no_docs, odd_docs


def plain_fingerprint(text: bytes) -> str:
    """A byte at a time, each block size anew."""
    def cut(size):
        out, chunk, h = [], b"", 0
        for k, c in enumerate(text):
            h = sum((b + 1) * P.BASE ** age for age, b in enumerate(reversed(text[max(0, k - P.WINDOW + 1):k + 1]))) % (1 << 32) * P.MIX % (1 << 32)
            chunk += bytes([c])
            if (h ^ h >> 15) % size == 0:
                out.append(chunk)
                chunk = b""
        return out, chunk

    if not text:
        return "3::"
    size = 3
    while (len(text) - 1) // (2 * P.LEAST) >= size:
        size *= 2
    while size > 3 and len(cut(size)[0]) < P.LEAST:
        size //= 2

    def signature(size):
        out, rest = cut(size)
        if len(out) >= P.LONGEST:
            out, rest = out[:P.LONGEST - 1], b"".join(out[P.LONGEST - 1:]) + rest
        return "".join(P.ALPHABET[xxhash.xxh32_intdigest(c) >> 26] for c in out + [rest] * bool(rest))

    return f"{size}:{signature(size)}:{signature(2 * size)}"


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = a.split(":"), b.split(":")
    if "" in (x[1], y[1]):
        return 0.0
    n, best = min(P.RUN, *map(len, x[1:] + y[1:])), 0.0
    for i in (1, 2):
        for j in (1, 2):
            if int(x[0]) * i == int(y[0]) * j:
                s, t = x[i], y[j]
                if {s[k:k + n] for k in range(len(s) - n + 1)} & {t[k:k + n] for k in range(len(t) - n + 1)}:
                    best = max(best, 1 - distance(s, t) / max(len(s), len(t)))
    return best


def texts():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    long = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 20, 60, 150, 400, 400, 900)]
    return [*(t[:5000] if t else t for t in ODD_TEXTS), *long, long[-1], "ab" * 2000, "é" * 700 + long[3], long[4][:900] + "X" + long[4][900:]]


def test_fingerprints_against_a_plain_loop(monkeypatch):
    plain = {t: plain_fingerprint(t.encode()) for t in texts() if t is not None}
    assert {t: P.fingerprint(t.encode()) for t in plain} == plain
    monkeypatch.setattr(P, "STEP", 64)  # a text read in many steps
    assert {t: P.fingerprint(t.encode()) for t in plain} == plain
    assert P.fingerprint(b"") == "3::" and len(P.fingerprint(b"ab" * 500_000)) < 600


def test_whole_operator_against_brute_force(spark):
    docs = odd_docs(spark, texts()).repartition(3)
    # descending ids, those without one last; rows of one id by the hash of the text
    rows = [(r.doc_id, r.text or "", r.tie) for r in docs.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary"))).collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want = []
    for k, (i, t, _) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + other[:half]
        f, e, o = (plain_fingerprint(x.encode()) for x in (t, edited, other))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, round(plain_likeness(f, e), 9), round(plain_likeness(f, o), 9)))
    for n in (1, 3, 40):  # tasks, most of them of one row at last
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = P.fingerprints(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.round("near_edited", 9), F.round("near_next", 9)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_and_single(spark):
    assert P.fingerprints(no_docs(spark)).collect() == []
    one = P.fingerprints(odd_docs(spark, ["alone here"]).filter("doc_id = 0")).first()
    assert one.n_chars == 10 and one.near_next == 1.0
    assert one.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()


def test_edits_are_near_and_others_far(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    base = [[rng.choice(words) for _ in range(600)] for _ in range(30)]
    pairs = [(" ".join(b), " ".join(b[:200] + ["inserted", "words"] + b[200:])) for b in base]
    marks = [(P.fingerprint(a.encode()), P.fingerprint(b.encode())) for a, b in pairs]
    near = [(a, b, True) for a, b in marks] + [(marks[k][0], marks[k - 1][0], False) for k in range(30)]
    got = spark.createDataFrame(near, "a string, b string, same boolean").select("same", P.likeness(F.col("a"), F.col("b")).alias("near")).collect()
    assert all(r.near > 0.9 if r.same else r.near < 0.2 for r in got)
