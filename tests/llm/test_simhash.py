"""SimHash near-duplicates (operator 10) against all pairs."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import simhash

from .helpers import no_docs, odd_docs


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def linked(spark, fps):
    """Component (smallest index) of each fingerprint by the operator's index and joins."""
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in sorted(set(signed))], "fp long").repartition(4)
    label = {r.node: r.label for r in simhash.components(simhash.links(df)).collect()}
    least = {}
    for i, f in enumerate(signed):
        least.setdefault(label.get(f, f), i)
    return [least[label.get(f, f)] for f in signed]


def test_links_of_random_families(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):  # chains and stars of one to four flipped bits
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            f ^= 1 << b
        fps.append(f)
    assert linked(spark, fps) == plain_components(fps)


def test_postings_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    rng = random.Random(4)
    base = rng.getrandbits(64)
    # one family that shares five bytes in hundreds of members, not all of them linked
    fps = [base ^ (rng.getrandbits(24) << 40) for _ in range(250)] + [base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)][:250]
    assert linked(spark, fps) == plain_components(fps)


def test_documents(spark):
    docs = odd_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = {(r.doc_id): plain_fingerprint(r.text) for r in rows}
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in got} == fps
    ids = [d for d in fps if d is not None]
    comp = plain_components([fps[d] for d in ids])
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {d: ids[c] for d, c in zip(ids, comp)}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_case_and_white_space(spark):
    docs = spark.createDataFrame([(5, "One TWO\tthree four\u00a0x"), (3, "one two\nthree   FOUR\u00a0x"), (9, "other words stand here now")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {5: 3, 3: 3, 9: 9}
    assert docs.filter(F.col("doc_id") == 5).count() == 1
