"""Spelling variants by a trie held as a table of edges (operator 12).

Words are the runs of letters of all texts that occur at least ``min_count``
times; two are near if one inserted, deleted or replaced code point
tells them apart.

Trie.  A node is a beginning of words, named by a hash; an edge (parent, ch, child)
is a row, so the trie is a distributed table.  An edge also says how many words
lie below its child, whether the child ends a word, and, where only one word is
left, that word and a hash of its rest.

Frontier.  A state is (word, position, node, edits): what has been read of a
word, up to where, and the node reached with so many edits.  The word side is the
node of the word's own beginning, so words that begin alike share a state until
they part.  States without an edit are the nodes with two or more words below.
A level joins the frontier with the edges:

* no edit yet: two edges of one node, replacing one letter by the other; or one
  edge on the word's side only, leaving that letter out (inserting it is the same pair seen from the
  other word).  Of a run of one letter, the last is left out, so a pair comes up once.
* one edit: the same letter on both sides.

Where both sides end a word, these are neighbours.  Where each side has one word
left, their rests are compared by hash and the state ends, so levels go no
deeper than the longest beginning that two words share.  Pairs found are checked on the words
themselves, so hashes that coincide add nothing; nor do they hide a pair.

Forms.  A word's form is its near word of largest count, if that is ``ratio`` times
its own; its root is where the forms lead.  Counts grow along forms, so chains are short.

Memory: texts are read a piece at a time and counted in a bounded dictionary; a word of n code
points is n edges, about 100 bytes each, made at once.  Hot words are summed in the tasks first.

Nulls, ties and odd input: a null text has no words; a null ``doc_id`` is
written ``null`` in the hash that decides deletions.  Of near words with equal counts the
smallest in code-point order is the form.  Repeated rows count each.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shared_path, slices

RUN = "[A-Za-zÀ-ÿ]"
#: Words held by a task before they go to the shuffle, and characters of a text matched at a time.
HELD, STEP = 200_000, 1 << 20
#: Multipliers of the hash of beginnings (odd).
BASE, MIX, DEEP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def runs(text: str, least: int):
    """Maximal runs of letters with at least ``least`` code points, lists of them at a time."""
    find = re.compile(RUN + "{%d,}" % least).findall
    letter = re.compile(RUN).match
    lo = 0
    while lo < len(text):
        hi = lo + STEP
        while hi < len(text) and letter(text[hi - 1]) and letter(text[hi]):
            hi += 1  # not within a run
        yield find(text, lo, hi)
        lo = hi


def word_counts(docs: DataFrame, min_chars: int, min_count: int, damage: int | None) -> DataFrame:
    """word, n of the texts of ``docs`` (doc_id, text): runs with A-Z lower-cased.  Where
    ``damage`` divides crc32 of ``<doc_id>:<run>``, the run loses the code point at crc32 mod its length."""
    def counted(batches):
        held: Counter[str] = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for b in slices(batches):
            for r in range(b.num_rows):
                data = b.column(1)[r]
                if not data.is_valid:
                    continue
                text = data.as_buffer().to_pybytes().lower().decode("utf-8", "replace")  # bytes: lower() changes A-Z only
                start = crc32(f"{b.column(0)[r].as_py() or 'null'}:".encode())
                for found in runs(text, min_chars):
                    for word, n in Counter(found).items():
                        if damage:
                            h = crc32(word.encode(), start)
                            if h % damage == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1:]
                                if len(word) < min_chars:
                                    continue
                        held[word] += n
                    if len(held) > HELD:
                        yield out()
        if held:
            yield out()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


_EDGE = "level int, parent long, ch int, child long, ends int, word long, rest long"


def _edges_of(words: pa.Array) -> dict[str, np.ndarray]:
    """The edges of some words: at each level the hash of the beginning before
    and after a code point, that of the whole word, and that of what follows."""
    data = words.to_pylist()
    size = np.array([len(w) for w in data])
    ch = np.frombuffer("".join(data).encode("utf-32-le"), np.uint32)
    end = np.cumsum(size)
    first = np.repeat(end - size, size)
    level = np.arange(len(ch)) - first
    with np.errstate(over="ignore"):
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(size.max(initial=1)), BASE))])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ch.astype(np.uint64) * power[level])])
        upto = total[1:] - total[first]  # sum of code point * BASE^position, from the word's start
        below = np.repeat(total[end] - total[end - size], size) - upto
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(size.max(initial=1)), inverse))])
        rest = below * back[level + 1]  # as if the rest were a word of its own

        def named(h, depth):
            x = (h + depth.astype(np.uint64) * DEEP) * MIX
            return (x ^ (x >> np.uint64(29))).view(np.int64)

        child = named(upto, level + 1)
        parent = np.where(level == 0, named(np.zeros(1, np.uint64), np.zeros(1, int)), np.concatenate([child[:1], child[:-1]]))
        return {"level": level.astype(np.int32), "parent": parent, "ch": ch.astype(np.int32), "child": child, "ends": (level + 1 == np.repeat(size, size)).astype(np.int32),
                "word": child[np.repeat(end, size) - 1], "rest": named(rest, np.repeat(size, size) - level - 1)}


def _batches(batches, points: int = 1 << 17):
    """Words of a task, so many at a time that they have about ``points`` code points (a longer word alone)."""
    for b in slices(batches, 10_000):
        words = b.column(0)
        at = np.cumsum(pa.compute.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)) // points
        for part in np.split(np.arange(len(words)), np.flatnonzero(np.diff(at)) + 1):
            if len(part):
                yield words.slice(int(part[0]), len(part))


def edge_table(words: DataFrame) -> DataFrame:
    """level, parent, ch, child, ends, words, word, rest, and of the parent: above (its words), above_ends."""
    def edges(batches):
        for b in _batches(batches):
            yield pa.RecordBatch.from_pydict(_edges_of(b))

    # words in order: a task's words begin alike, so most of its edges are merged before the shuffle
    each = words.select("word").repartitionByRange("word").mapInArrow(edges, _EDGE)
    by = ["level", "parent", "ch", "child"]
    once = materialise(each.groupBy(*by).agg(F.max("ends").alias("ends"), F.count("*").alias("words"), F.min("word").alias("word"), F.min("rest").alias("rest")), "trie-nodes")
    parent = once.groupBy(F.col("child").alias("parent")).agg(F.sum("words").alias("above"), F.max("ends").alias("above_ends"))
    whole = once.join(parent, "parent", "left").withColumn("above", F.when(F.col("level") == 0, F.lit(1 << 40)).otherwise(F.col("above"))).fillna(0, ["above_ends"])
    return materialise(whole.repartitionByRange("level", "parent").sortWithinPartitions("level", "parent"), "trie-edges")


def neighbours(words: DataFrame) -> DataFrame:
    """a, b: each pair of near words of ``words`` (word), once."""
    spark = words.sparkSession
    edges = edge_table(words)
    path, level = shared_path(spark, "trie-frontier"), 0
    deepest = edges.filter("above > 1").agg(F.max("level")).first()[0]
    side = {s: [F.col(f"{s}.{x}").alias(f"{s}_{x}") for x in ("ends", "words", "word", "rest")] for s in ("e", "f")}
    frontier = None
    while deepest is not None:
        here = edges.filter(F.col("level") == level)
        e, f = here.alias("e"), here.filter("above > 1").alias("f")
        same = F.lit(None).cast("int").alias("left_out")
        e2 = here.filter("above > 1").alias("e")
        replaced = e2.join(f, (F.col("e.parent") == F.col("f.parent")) & (F.col("e.ch") < F.col("f.ch"))).select(
            F.col("e.child").alias("p"), F.col("f.child").alias("q"), same, *side["e"], *side["f"])
        # the other side stays at the parent, which has two words or more
        omitted = e2.select(F.col("child").alias("p"), F.col("parent").alias("q"), F.col("ch").alias("left_out"), *side["e"],
                            F.col("above_ends").alias("f_ends"), F.col("above").alias("f_words"), F.lit(None).cast("long").alias("f_word"), F.lit(None).cast("long").alias("f_rest"))
        made = replaced.unionByName(omitted)
        if frontier is not None:
            # the other side is at this level (a letter replaced) or one above it (left out)
            both = edges.filter(F.col("level").between(level - 1, level)).alias("f")
            step = frontier.join(e, F.col("p") == F.col("e.parent")).filter(~F.col("ch").eqNullSafe(F.col("left_out"))).select("q", *[F.col(f"e.{x}") for x in ("ch", "child", "ends", "words", "word", "rest")]).alias("e")
            made = made.unionByName(step.join(both, (F.col("e.q") == F.col("f.parent")) & (F.col("e.ch") == F.col("f.ch"))).select(
                F.col("e.child").alias("p"), F.col("f.child").alias("q"), same, *side["e"], *side["f"]))
        alone = (F.col("e_words") == 1) & (F.col("f_words") == 1)
        ends = (F.col("e_ends") == 1) & (F.col("f_ends") == 1)
        found = F.when(alone, F.col("e_rest") == F.col("f_rest")).otherwise(ends)
        # where both sides end a word, their names are the nodes themselves
        made = made.withColumn("a", F.when(found, F.when(alone, F.col("e_word")).otherwise(F.col("p")))).withColumn("b", F.when(found, F.when(alone, F.col("f_word")).otherwise(F.col("q"))))
        made = made.withColumn("goes_on", ~alone).filter(F.col("goes_on") | F.col("a").isNotNull())
        made.select("p", "q", "left_out", "a", "b", "goes_on").write.parquet(f"{path}/level={level}")
        schema = "p long, q long, left_out int, a long, b long, goes_on boolean"
        frontier = spark.read.schema(schema).parquet(f"{path}/level={level}").filter("goes_on").select("p", "q", "left_out")
        level += 1
        if level > deepest and frontier.isEmpty():
            break
    if deepest is None:  # fewer than two words
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).filter(F.lit(False))
    found = spark.read.schema("a long, b long, level int").parquet(path).filter("a IS NOT NULL").select("a", "b").distinct()
    return _checked(found, words)


def _checked(found: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs of word hashes (a, b) as words, where the words themselves are one edit apart."""
    def ids(batches):
        for b in _batches(batches):
            x = _edges_of(b)
            yield pa.RecordBatch.from_arrays([b, pa.array(x["word"][x["level"] == 0])], ["word", "id"])

    named = words.select("word").mapInArrow(ids, "word string, id long")
    left, right = named.toDF("wa", "a"), named.toDF("wb", "b")
    return found.join(left, "a").join(right, "b").filter(F.levenshtein("wa", "wb", 1) == 1).select(F.col("wa").alias("a"), F.col("wb").alias("b")).distinct()


def variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, ratio: int = 10, damage: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of ``docs`` (doc_id, text)."""
    words = materialise(word_counts(docs, min_chars, min_count, damage), "words")
    pairs = materialise(neighbours(words), "near-words")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    found = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = found.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    out = words.join(best, "word", "left").withColumn("formed", F.col("best.near").isNotNull() & (-F.col("best.minus") >= ratio * F.col("n")))
    out = out.select("word", F.when(F.col("formed"), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("formed"), -F.col("best.minus")).alias("form_n"))
    out = materialise(out, "word-forms")
    # each round doubles how far a root lies from its word; a form's count is ``ratio`` times the word's, so chains are short
    roots, moved = out.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), True
    while moved:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("above"))
        new = materialise(roots.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "word-roots")
        roots, moved = new.select("word", "root"), not new.filter("moved").isEmpty()
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
