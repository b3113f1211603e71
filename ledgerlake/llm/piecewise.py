"""Context-triggered piecewise hashing (operator 13).

A polynomial hash rolls over the last WINDOW bytes of a text.  A byte whose
hash divides by the block size ends a chunk, so chunks depend on what they hold and
not on where they lie: after an edit the next boundaries fall into step again.
Block sizes are 3 * 2^k; a text takes the one that its length lets expect LEAST to
twice as many chunk ends of, or the next smaller ones until it has LEAST (3, if none).  A chunk gives one character, of its own hash, and the
characters are the signature.  A fingerprint is ``size:signature:signature``, the
second at twice the block size, so that texts whose sizes are equal or one
step apart have signatures of one block size to compare.

Likeness is 1 - d / n of the two signatures of one block size, d their edit distance
and n the longer length, the best if there are two pairs; 0 if no block sizes are
compatible or the signatures have no run of RUN characters in common
(of all characters, if the shorter has fewer), which unrelated texts rarely
have.  Equal fingerprints are at 1.

Memory: a text is read in steps of STEP bytes.  A signature has at most LONGEST
characters, the last of them for all of the rest (texts of short periods may
have more chunk ends).

Nulls, ties and odd input: a null text counts as empty, and an empty one has the
fingerprint ``3::``.  Null ``doc_id`` rows come after all others.  Rows of the same id go by a
hash of their text; it doesn't matter which of equal rows comes first.  A single row is
its own next one; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, materialise

WINDOW, LEAST, LONGEST, RUN, STEP = 7, 32, 256, 4, 1 << 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Multiplier of the rolling hash (odd) and of the mix of its bits.
BASE, MIX = 0x2C1B3C6D, 0x9E3779B1


def rolled(data: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes up to each byte (of fewer at the start): the sum of byte * BASE^age."""
    h = data.astype(np.uint32) + np.uint32(1)  # a zero byte counts, too
    out = h.copy()
    for age in range(1, WINDOW):
        out[age:] += h[:-age] * np.uint32(pow(BASE, age, 1 << 32))
    out *= np.uint32(MIX)
    return out ^ (out >> np.uint32(15))


def ends(data: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions after the bytes whose hash divides by 3 * 2^k, and how many further times 2 divides it."""
    at, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(data), STEP):
        before = min(lo, WINDOW - 1)
        h = rolled(data[lo - before:lo + STEP])[before:]
        here = np.flatnonzero((h & np.uint32((1 << k) - 1)) == 0)
        here = here[h[here] % 3 == 0]
        top = h[here].astype(np.int64) | (1 << 32)
        at.append(here + (lo + 1))
        more.append(np.bitwise_count((top & -top) - 1).astype(np.int64) - k)
    return np.concatenate(at), np.concatenate(more)


def _signature(text: memoryview, at: np.ndarray) -> str:
    cuts = at[:LONGEST - 1].tolist()
    if not cuts or cuts[-1] != len(text):
        cuts.append(len(text))
    elif len(at) >= LONGEST:
        cuts[-1] = len(text)
    digest, lo, out = xxhash.xxh32_intdigest, 0, []
    for hi in cuts:
        out.append(ALPHABET[digest(text[lo:hi]) >> 26])
        lo = hi
    return "".join(out)


def fingerprint(text: bytes) -> str:
    """``size:signature:signature`` of a UTF-8 text."""
    if not text:
        return "3::"
    data, view = np.frombuffer(text, np.uint8), memoryview(text)
    most = k = ((len(text) - 1) // (6 * LEAST)).bit_length()  # by length alone: LEAST to 2 * LEAST ends on average
    while True:
        k = max(0, k - 4)
        at, more = ends(data, k)
        if k == 0 or len(at) >= LEAST:
            break
    many = np.cumsum(np.bincount(more, minlength=1)[::-1])[::-1][:most - k + 1]
    up = int(np.flatnonzero(many >= LEAST).max(initial=0))
    return f"{3 << k + up}:{_signature(view, at[more >= up])}:{_signature(view, at[more > up])}"


def likeness(a: Column, b: Column) -> Column:
    """Likeness (0 to 1) of two columns of fingerprints."""
    x, y = F.split(a, ":"), F.split(b, ":")
    size = [p[0].cast("double") for p in (x, y)]

    def runs(s: Column) -> Column:
        n = F.least(F.lit(RUN), F.length(x[1]), F.length(x[2]), F.length(y[1]), F.length(y[2]))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substring(s, i, n))

    def like(s: Column, t: Column) -> Column:
        return F.when(F.arrays_overlap(runs(s), runs(t)), 1 - F.levenshtein(s, t) / F.greatest(F.length(s), F.length(t))).otherwise(F.lit(0.0))

    found = (F.when(a == b, F.lit(1.0)).when((a == "3::") | (b == "3::"), F.lit(0.0))
             .when(size[0] == size[1], F.greatest(like(x[1], y[1]), like(x[2], y[2])))
             .when(size[0] == 2 * size[1], like(x[1], y[2])).when(2 * size[0] == size[1], like(x[2], y[1])).otherwise(F.lit(0.0)))
    return found.cast("double")


def _edited(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of a text, and the text with its last half replaced by as much of the start of the following one.
    Bytes that are no UTF-8 count as a code point each."""
    own, other = text.decode("utf-8", "surrogateescape"), following.decode("utf-8", "surrogateescape")
    half = len(own) // 2
    return len(own), (own[:len(own) - half] + other[:half]).encode("utf-8", "surrogateescape")


_ORDER = ("none boolean, doc_id long, tie long, row long", ["none", "doc_id", "tie", "row"])
_OUT = "n_chars long, edited_sha256 binary, fingerprint string, edited_fingerprint string, next_fingerprint string"
#: Beside results (border 0): the first (1) and last (2) row of each task, with their texts.
_SCHEMA = f"border int, {_ORDER[0]}, {_OUT}, text binary"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_NAMES)


def _pair(text: bytes, mark: str, following: bytes, next_mark: str) -> tuple:
    n, edited = _edited(text, following)
    return n, hashlib.sha256(edited).digest(), mark, mark if edited == text else fingerprint(edited), next_mark


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint, edited_sha256, edited_fingerprint, near_edited and
    near_next of each row of ``docs`` (doc_id, text): the text with its last half
    replaced by the start of the next one, in order of descending doc_id, the last's being the first.

    Rows are sorted over all tasks, each of which pairs its own; what the last row of a task needs
    of the next task's first comes from a second, small pass over the rows at the borders."""
    text = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    order = [F.asc("none"), F.desc("doc_id"), F.asc("tie"), F.asc("row")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def paired(batches):
        last = None
        for b in batches:
            for r in range(b.num_rows):
                key, data = tuple(b.column(c)[r].as_py() for c in range(4)), b.column(4)[r].as_py()
                mark = fingerprint(data)
                if last is None:
                    yield _batch([(1, *key, None, None, mark, None, None, data)])
                else:
                    out.append((0, *last[0], *_pair(last[2], last[1], data, mark), None))
                    if len(out) == 1000:
                        yield _batch(out)
                        out = []
                if last is None:
                    out = []
                last = key, mark, data
        if last is not None:
            yield _batch([*out, (2, *last[0], None, None, last[1], None, None, last[2])])
        give_back()

    found = rows.mapInArrow(paired, _SCHEMA)
    found = materialise(_liked(found), "piecewise")
    border = found.filter("border > 0")
    # two rows a task; in order, the row after a task's last is the first of the next task
    at = Window.orderBy(*order, "border")
    keys = border.select("border", "none", "doc_id", "tie", "row").withColumn("first", F.first("row").over(at)).withColumn("next", F.coalesce(F.lead("row").over(at), F.col("first")))
    keys = keys.filter("border = 2").select("row", "next")
    ends = border.filter("border = 2").select("none", "doc_id", "tie", "row", "fingerprint", "text").join(keys, "row")
    heads = border.filter("border = 1").select(F.col("row").alias("next"), F.col("fingerprint").alias("next_fingerprint"), F.col("text").alias("following"))

    def closed(batches):
        for b in batches:
            for r in b.to_pylist():
                yield _batch([(0, r["none"], r["doc_id"], r["tie"], r["row"], *_pair(r["text"], r["fingerprint"], r["following"], r["next_fingerprint"]), None)])

    rest = _liked(ends.join(heads, "next").mapInArrow(closed, _SCHEMA))
    return (found.filter("border = 0").unionByName(rest)
            .select("doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"))


def _liked(found: DataFrame) -> DataFrame:
    return (found.withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint")))
            .withColumn("near_next", likeness(F.col("fingerprint"), F.col("next_fingerprint"))).drop("next_fingerprint"))
