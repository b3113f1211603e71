"""SimHash near-duplicates over a byte-position inverted index (operator 10).

A text's fingerprint has bit b set if over half of its word-shingle hashes
(XXH64, seed 42) have it.  Two fingerprints within ``max_bits`` = 3 differing
bits differ in at most 3 of their 8 bytes, so they share at least 5 positional
bytes (position, value).  That is the minimum of the count filter.

Single bytes would give postings that grow with the square of the corpus, so
the index joins postings by pigeonhole: of the first 7 positions at least 4
are shared, and every set of 4 of those 7 positions with its bytes is a
posting (35 a fingerprint, 2^32 values each).  Members of a posting are compared
with each other: the shared positional bytes of a pair are tallied, pairs with
fewer than 5 are dropped, the rest verified by differing bits.

A posting with many members (a family of near copies) is cut into blocks, and
each pair of blocks is one group of bounded size.  A group returns a spanning
forest of its links, not all pairs: the links it leaves out join fingerprints
that are connected by links it returns, so components stay exactly the same.

Only distinct fingerprints are indexed; components of the fingerprint graph are
found by joins (each node takes the smallest label around it, and the label's
label) over tables in the shared folder, until nothing changes.

Nulls, ties and odd input: a null or empty text has fingerprint zero and is
linked like any other; texts of fewer words than a shingle are hashed as one
shingle.  Null ``doc_id`` rows get a fingerprint and, as they have no id, take
no part in the smallest id (component_id is null if a component has none).
Repeated rows share a component.  An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices

POSITIONS = [*combinations(range(7), 4)]
#: Members of a posting compared in one group; larger ones are cut into blocks of this size.
BLOCK = 2048
#: Shingles hashed at a time, so that a very long text needs little memory.
STEP = 65536


def fingerprint(text: bytes, words: int = 3) -> int:
    """Fingerprint of a UTF-8 text, as an unsigned 64-bit integer."""
    found = text.lower().split()  # bytes: lower() changes A-Z only, split() cuts at 20 and 09-0D
    if not found:
        return 0
    joined = b" ".join(found)
    n = max(1, len(found) - words + 1)
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    start = np.concatenate([[0], space + 1])[:n]
    end = np.concatenate([space, [len(joined)]])[-n:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, STEP):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(start[k:k + STEP].tolist(), end[k:k + STEP].tolist())], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of each document."""
    def hashed(batches):
        for b in slices(batches):
            fps = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(hashed, "doc_id long, fp long")


def _linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Where fingerprints share enough positional bytes and differ in few enough bits."""
    x = a ^ b
    shared = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(-1)
    at = np.flatnonzero(shared >= 8 - max_bits)
    return at[np.bitwise_count(x[at]) <= max_bits]


def _forest(fp: np.ndarray, block: np.ndarray, same: bool, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the members of a group: each member is compared with
    the later ones not yet in its tree (of other blocks, unless ``same``)."""
    tree, out, signed = np.arange(len(fp)), [], fp.view(np.int64)
    for r in range(len(fp) - 1):
        other = tree[r + 1:] != tree[r]
        if not same:
            other &= block[r + 1:] != block[r]
        rest = r + 1 + np.flatnonzero(other)
        for h in rest[_linked(fp[rest], fp[r], max_bits)].tolist():
            if tree[h] != tree[r]:
                out.append((int(signed[r]), int(signed[h])))
                tree[tree == tree[h]] = tree[r]
    return out


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) among the distinct fingerprints ``fps`` (column fp): pairs
    within ``max_bits`` differing bits, a spanning forest of them in each group
    of the index."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees 5 shared bytes for at most 3 bits")

    def postings(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            raw = fp.view(np.uint8).reshape(-1, 8)
            for k, four in enumerate(POSITIONS):
                key = np.ascontiguousarray(raw[:, list(four)]).view(np.uint32)[:, 0].astype(np.int64) << 6 | k
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], ["key", "fp"])

    index = fps.select("fp").mapInArrow(postings, "key long, fp long")
    # A posting of more than BLOCK members is cut into blocks by the fingerprint's hash; each pair of blocks is a group.
    large = index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK).select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    large = materialise(large, "large-postings")
    if large.isEmpty():
        groups = index.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"), "fp")
    else:
        cut = index.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        cut = cut.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        groups = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "key", F.least("block", "other").cast("int").alias("i"), F.greatest("block", "other").cast("int").alias("j"), "block", "fp")

    def compared(batches):
        """Runs of equal (key, i, j), sorted; a run crosses batches, so its
        tail is kept until the next one (a run has two blocks at most)."""
        kept = None

        def pairs(cols):
            key, i, j, block, fp = cols
            if not len(key):
                return
            fp = fp.view(np.uint64)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            first = np.flatnonzero(new)
            size = np.diff(np.concatenate([first, [len(key)]]))
            out: list[tuple[int, int]] = []
            small = size <= 32
            # short runs all at once: members at distance d of each other
            run = np.repeat(np.arange(len(first)), size)
            inside = np.repeat(small, size)
            for d in range(1, int(size[small].max(initial=1))):
                at = np.flatnonzero((run[d:] == run[:-d]) & inside[d:])
                hit = at[_linked(fp[at], fp[at + d], max_bits)]
                if len(hit):
                    out += zip(fp[hit].view(np.int64).tolist(), fp[hit + d].view(np.int64).tolist())
            for f, n in zip(first[~small].tolist(), size[~small].tolist()):
                out += _forest(fp[f:f + n], block[f:f + n], i[f] == j[f], max_bits)
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if kept is not None:
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            key, i, j = cols[:3]
            tail = int(np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))[-1]) + 1 if len(key) and ((key != key[-1]) | (i != i[-1]) | (j != j[-1])).any() else 0
            yield from pairs([c[:tail] for c in cols])
            kept = [c[tail:] for c in cols]
        if kept is not None:
            yield from pairs(kept)

    return (groups.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(compared, "a long, b long").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, label (the smallest node reachable) of each node of the links (a,
    b).  Each round a node takes the least label among itself and its
    neighbours, then that label's own label, so the rounds grow with the
    logarithm of a component's breadth."""
    both = materialise(edges.union(edges.select(F.col("b"), F.col("a"))).toDF("node", "other").distinct(), "links")
    labels = materialise(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        now = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("above"))
        now = materialise(now.join(up, "low").select("node", F.least("low", "above").alias("label"), (F.least("low", "above") < F.col("label")).alias("moved")), "labels")
        labels = now.select("node", "label")
        if now.filter("moved").isEmpty():
            return labels
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp (signed long), component_id (smallest doc_id reachable) of
    each row of ``docs`` (doc_id, text)."""
    found = materialise(fingerprints(docs, words), "fingerprints")
    first = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    label = components(links(first, max_bits))
    least = (first.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    of = least.groupBy("label").agg(F.min("first").alias("component_id"))
    of = least.select("fp", "label").join(of, "label").select("fp", "component_id")
    return found.join(of, "fp").select("doc_id", "fp", "component_id")
