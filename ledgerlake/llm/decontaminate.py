"""Benchmark decontamination (operator 1): rare n-gram seeds, then Smith-Waterman.

1. One pass over the texts looks up every word n-gram in a bitmap of the
   benchmark's n-gram hashes (a fixed 4 MB, whatever the benchmark's size) and
   keeps the passages around the hits: runs of words in which the next hit is
   never farther than ``2 x`` the longest item.
2. The hits of all documents give each benchmark n-gram's document frequency.
   Seeds of an item are its rare n-grams among those that occur in documents.
   An n-gram held by at most ``rare_items`` different items is a seed, in however
   many documents it is: its pairs grow with its hits, not with their square.
   Of n-grams shared by more items, seeds are those in at most ``rare_share`` of
   all documents and the rarer half of the item's n-grams that occur.
3. Passages join items on seeds; each (passage, item) pair is aligned by
   words with Smith-Waterman (match 2, mismatch -1, gap -1).  The score is
   the alignment's share of the item's score against itself, so exact copies
   get 1, edited or partly rewritten ones less.

Words are lower-cased runs of letters and digits (ASCII punctuation and white
space separate).  Nothing is capped: every hit, seed and pair is followed.

Nulls, ties and odd input: null or empty texts (of documents or items) match
nothing; items of fewer words than a seed are one n-gram of all their words, and
n-grams of that length are looked up in documents, too; a
null ``doc_id`` or ``item_id`` is kept as it is.  Repeated rows (same doc_id or
item_id) give one row a (doc_id, item_id): the best score, then the earliest
place.  Empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices

BITS = 25
MATCH, MISMATCH, GAP = 2, -1, -1
_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_WORDS).split()


class _Hashes(dict):
    """word -> 64-bit hash, kept while the worker lives, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


_HASHES = _Hashes()


def gram_hashes(words: list[bytes], n: int) -> np.ndarray:
    """Hash of each run of ``n`` words (of all words, if fewer; none for no words)."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * _MIX[k % len(_MIX)]
        out ^= out >> np.uint64(29)
    return out


def align(item: list[bytes], passage: list[bytes]) -> tuple[float, int, int, int]:
    """Smith-Waterman: score as a share of the item's own, first and end word
    in the passage, and matched words, of the best alignment (the earliest
    ending one in the item, then in the passage)."""
    code = {w: k for k, w in enumerate(dict.fromkeys(item))}
    a = [code[w] for w in item]
    b = np.array([code.get(w, -1) for w in passage], np.int64)
    slope = -GAP * np.arange(1, len(b) + 1)
    h = np.zeros((len(a) + 1, len(b) + 1), np.int64)
    for i, c in enumerate(a):
        t = np.maximum(h[i, :-1] + np.where(b == c, MATCH, MISMATCH), h[i, 1:] + GAP)
        np.maximum(t, 0, out=t)
        h[i + 1, 1:] = np.maximum.accumulate(t + slope) - slope
    i, j = divmod(int(h.argmax()), len(b) + 1)
    best, end, matched = int(h[i, j]), j, 0
    while h[i, j] > 0:
        same = b[j - 1] == a[i - 1]
        if h[i, j] == h[i - 1, j - 1] + (MATCH if same else MISMATCH):
            i, j, matched = i - 1, j - 1, matched + int(same)
        elif h[i, j] == h[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best / (MATCH * max(1, len(a))), j, end, matched


def within_reach(item: list[bytes], passage: list[bytes], threshold: float) -> bool:
    """Whether the words that the two have in common could give a score of ``threshold``."""
    own, most = Counter(item), threshold * len(item) - 1e-9
    return sum(min(c, own[w]) for w, c in Counter(w for w in passage if w in own).items()) >= most


def _passages(docs: DataFrame, bitmap, sizes: list[int], reach: int) -> DataFrame:
    """Hits of the n-grams of ``sizes`` words: passage (id), doc_id, first (word), text (its words), grams and places
    (hashes of hits and their words in the document), fresh (whether a hit is
    the document's first of its n-gram)."""
    names = ["passage", "doc_id", "first", "text", "grams", "places", "fresh"]
    n = max(sizes, default=0)

    def hits(words: list[bytes], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the n-grams that may be the benchmark's, by place."""
        got = []
        for m in sizes:
            if m <= len(words):
                g = gram_hashes(words, m)
                slot = g >> np.uint64(64 - BITS)
                at = np.flatnonzero(bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                got.append((g[at], at))
        g, at = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.argsort(at, kind="stable")
        return g[order], at[order]

    def found(batches):
        bits, count = bitmap.value, 0
        base = TaskContext.get().partitionId() << 40
        for b in slices(batches):
            rows: list[tuple] = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = words_of(text)
                g, at = hits(words, bits)
                if not len(at):
                    continue
                fresh = np.zeros(len(at), bool)
                fresh[np.unique(g, return_index=True)[1]] = True
                for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 2 * reach) + 1):
                    own = at[part]
                    lo, hi = max(0, int(own[0]) - reach), int(own[-1]) + n + reach
                    rows.append((base + count, doc, lo, b" ".join(words[lo:hi]).decode("utf-8", "replace"), g[part].view(np.int64).tolist(), own.tolist(), fresh[part].tolist()))
                    count += 1
            if rows:
                cols = zip(*rows)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        found, "passage long, doc_id long, first long, text string, grams array<long>, places array<long>, fresh array<boolean>")


def item_grams(items: DataFrame, n: int) -> DataFrame:
    """item, gram of the distinct n-grams of each item (item, text), words (a
    hash of all its words: items of equal words are one when counted) and size
    (words of the n-gram)."""
    def cut(batches):
        for b in slices(batches):
            rows = []
            for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words = words_of(t)
                whole = gram_hashes(words, len(words)).view(np.int64).tolist()
                rows += [(i, g, *whole, min(n, len(words))) for g in np.unique(gram_hashes(words, n)).view(np.int64).tolist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["item", "gram", "words", "size"])

    return items.mapInArrow(cut, "item long, gram long, words long, size long")


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, rare_share: float = 0.001, threshold: float = 0.5, rare_items: int = 64) -> DataFrame:
    """doc_id, item_id, score, word_start, word_end (in the document), matched
    (words) and passage (the aligned words) of each leak: a document that
    holds a passage aligned to an item with at least ``threshold`` of the
    item's own score."""
    spark = docs.sparkSession
    # items get a number of their own: ids may repeat
    items = materialise(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), "items")
    grams = materialise(item_grams(items, n), "item-grams")

    def mapped(batches):
        bits = np.zeros(1 << BITS - 3, np.uint8)
        any_ = False
        for b in batches:
            slot = b.column("gram").to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - BITS)
            np.bitwise_or.at(bits, (slot >> np.uint64(3)).astype(np.int64), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))
            any_ = True
        if any_:
            at = np.flatnonzero(bits)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(bits[at].astype(np.int16))], ["byte", "bits"])

    bits = np.zeros(1 << BITS - 3, np.uint8)
    # at most one row a byte of the bitmap comes to the driver, however many items there are
    got = grams.select("gram").mapInArrow(mapped, "byte int, bits smallint").groupBy("byte").agg(F.bit_or("bits").alias("bits")).toPandas()
    bits[got["byte"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.uint8)
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())  # n rows at most
    longest = items.agg(F.max(F.size(F.split(F.coalesce("text", F.lit("")), "[^\\p{L}\\p{N}]+")))).first()[0] or 0
    passages = materialise(_passages(docs, spark.sparkContext.broadcast(bits), sizes, 2 * longest + n), "passages")

    hits = passages.select("passage", F.explode(F.arrays_zip("grams", "fresh")).alias("h")).select("passage", F.col("h.grams").alias("gram"), F.col("h.fresh").alias("fresh"))
    seen = hits.filter("fresh").groupBy("gram").agg(F.count("*").alias("df"))
    total = docs.count()
    held = grams.groupBy("gram").agg(F.countDistinct("words").alias("items"))
    # only n-grams that occur are ranked: those that an edit broke everywhere must not push the others down
    grams.join(held, "gram").join(seen, "gram").createOrReplaceTempView("decontaminate_grams")
    # one item's n-grams are ranked together: as many rows as the item has words
    seeds = spark.sql("SELECT item, gram, items, df, percent_rank() OVER (PARTITION BY item ORDER BY df) AS at FROM decontaminate_grams")
    rare = (F.col("items") <= rare_items) | (F.col("df") <= rare_share * total) | (F.col("at") <= 0.5)
    seeds = materialise(seeds.filter(rare).select("item", "gram"), "seeds")
    pairs = hits.select("passage", "gram").distinct().join(seeds, "gram").groupBy("passage", "item").agg(F.count("*").alias("seeds"))
    pairs = materialise(pairs, "pairs")
    work = (pairs.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item")
            .join(passages.select("passage", "doc_id", "first", "text"), "passage").select("doc_id", "item_id", "first", "text", "item_text"))

    def aligned(batches):
        for b in slices(batches):
            rows = []
            for r in b.to_pylist():
                item, words = words_of(r["item_text"]), r["text"].encode().split(b" ")
                if not within_reach(item, words, threshold):
                    continue
                score, start, end, matched = align(item, words)
                if score >= threshold:
                    rows.append((r["doc_id"], r["item_id"], score, r["first"] + start, r["first"] + end, matched, b" ".join(words[start:end]).decode()))
            if rows:
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "item_id", "score", "word_start", "word_end", "matched", "passage"])

    out = work.mapInArrow(aligned, "doc_id long, item_id long, score double, word_start long, word_end long, matched long, passage string")
    best = F.max_by(F.struct("score", "word_start", "word_end", "matched", "passage"), F.struct("score", -F.col("word_start"), -F.col("word_end"), "passage"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
