"""LM scoring by subword lattices (operator 9).

A word is the sum over all its segmentations into pieces of an existing
subword vocabulary: P(word) = sum over segmentations of the product of piece
probabilities, by a forward recursion in log space over the word's lattice.
No piece crosses a word's start mark, so a text's marginal probability is the
product over its words (and one end) of theirs.

Piece weights start from the vocabulary's own scores.  (The file's scores are
minus the piece's rank, not log-probabilities; rank r gets weight 1 / (r + 2.7).)
Then rounds of expectation-maximisation over all distinct training words give
each piece its expected number of uses.  Single bytes are always pieces, so
every text has a probability above 0.

After each word a text goes on or ends: it ends with probability
e = (ends + 1/2) / (N + 1), ends and N the training set's ends and tokens.  So

    score = sum over words of log10(P(word) * (1 - e)) + log10(e).

``mixed_score`` is another model beside it: a training word's whole-word count,
with absolute discounting, whose discounted mass goes to the lattice:
P(w) = max(c(w) - d, 0) / N + d * V / N * P(word), V distinct tokens of N,
d = 0.75.  The end is such a token too.

How it is spread: one pass cuts texts into blocks (a task's consecutive
documents, of bounded size) and writes, for each block, its distinct words with
training counts and each document as numbers of words in its block.  Word
counts are summed over blocks, each distinct word goes through its lattice once,
and its count and log-probability return to the blocks it occurs in; blocks and their
words then meet in tasks of bounded size.  No vocabulary is held whole anywhere.

Words are runs of bytes other than 20 and 09-0D, A-Z lower-cased.

Nulls, ties and odd input: a null or empty text is the end token alone.
Repeated rows are scored each (and trained on each); a null flag means not held out.  With an empty training
set the base score of a token is 0 (= log10(1/1)), e is 1/2 and the mixed model is the piece
lattice alone (its end has probability 1).  An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices

DISCOUNT = 0.75
#: Bytes of text and distinct words after which a task begins a new block.
BLOCK_BYTES, BLOCK_WORDS = 24 << 20, 400_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """The vocabulary: pieces as bytes (a leading space marks a word's start)
    and their natural log-probabilities, with a hash table of all prefixes."""
    pieces: list[bytes]
    logs: np.ndarray

    def __post_init__(self):
        number = {p: k for k, p in enumerate(self.pieces)}
        prefixes = {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}
        keys = np.array([self.key(p) for p in prefixes], np.uint64)
        values = np.array([number.get(p, -1) for p in prefixes], np.int32)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.longest = max(map(len, self.pieces))

    @staticmethod
    def key(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h + b + 1) * int(_MULTIPLIER) & (1 << 64) - 1
        return h

    @classmethod
    def load(cls, path: str) -> Pieces:
        """From a sentencepiece file: word starts are spaces, bytes its byte pieces."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        weight: dict[bytes, float] = {}
        for k in range(sp.get_piece_size()):
            if sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k):
                continue
            text = sp.id_to_piece(k)
            if sp.is_byte(k):
                piece, rank = bytes([int(text[3:-1], 16)]), sp.get_piece_size()
            else:
                piece, rank = text.replace("▁", " ").encode(), -sp.get_score(k)
            if b" " in piece[1:]:
                continue  # would cross a word's start
            weight[piece] = weight.get(piece, 0.0) + 1 / (rank + 2.7)
        for b in range(256):
            weight.setdefault(bytes([b]), 1 / (sp.get_piece_size() + 2.7))
        pieces = sorted(weight)
        w = np.array([weight[p] for p in pieces])
        return cls(pieces, np.log(w / w.sum()))


def lattices(vocabulary: Pieces, words: list[bytes], counts: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log of each word's probability over all segmentations; with
    ``counts`` also the expected uses of each piece, summed over the words."""
    text = b"".join([b" " + w for w in words])
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    size = np.array([len(w) + 1 for w in words])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    word = np.repeat(np.arange(len(words)), size)
    end = (start + size)[word]
    # arcs (from, length, piece): prefixes are followed a byte at a time
    begin, h = np.arange(len(raw)), np.zeros(len(raw), np.uint64)
    arcs_from, arcs_to, arcs_piece = [], [], []
    for n in range(1, vocabulary.longest + 1):
        h = (h + raw[begin + n - 1] + np.uint64(1)) * _MULTIPLIER
        slot = np.searchsorted(vocabulary.keys, h)
        slot[slot == len(vocabulary.keys)] = 0
        live = vocabulary.keys[slot] == h
        begin, h, slot = begin[live], h[live], slot[live]
        piece = vocabulary.values[slot]
        is_piece = piece >= 0
        arcs_from.append(begin[is_piece])
        arcs_to.append(begin[is_piece] + n)
        arcs_piece.append(piece[is_piece])
        more = begin + n < end[begin]
        begin, h = begin[more], h[more]
        if not len(begin):
            break
    a, b, p = np.concatenate(arcs_from), np.concatenate(arcs_to), np.concatenate(arcs_piece)
    w = word[a]
    # nodes: a word's bytes and its end; node of position x of word w is x + w
    a, b, logs = a + w, b + w, vocabulary.logs[p]
    nodes, first = len(raw) + len(words), start + np.arange(len(words))
    depth_to, depth_from = b - first[w], a - first[w]

    def passed(key: np.ndarray, source: np.ndarray, target: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Log-sums over paths from ``roots``, level by level of ``key``."""
        out = np.full(nodes, -np.inf)
        out[roots] = 0.0
        order = np.lexsort((target, key))
        key, source, target, lp = key[order], source[order], target[order], logs[order]
        levels = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        for lo, hi in zip(levels, [*levels[1:], len(key)]):
            t = target[lo:hi]
            x = out[source[lo:hi]] + lp[lo:hi]
            cut = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            top = np.maximum.reduceat(x, cut)
            parts = np.diff(np.concatenate([cut, [len(t)]]))
            out[t[cut]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, parts)), cut))
        return out

    forward = passed(depth_to, a, b, first)
    total = forward[first + size]
    if not counts:
        return total, None
    backward = passed(size[w] - depth_from, b, a, first + size)
    uses = np.exp(forward[a] + logs + backward[b] - total[w])
    return total, np.bincount(p, uses, len(vocabulary.pieces))


def _steps(words: list[bytes], most: int = 400_000) -> Iterator[tuple[list[int], list[bytes]]]:
    """Words in order of length, in steps of about ``most`` bytes, with their places."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    step, held = [], 0
    for k in order:
        step.append(k)
        held += len(words[k]) + 1
        if held >= most:
            yield step, [words[i] for i in step]
            step, held = [], 0
    if step:
        yield step, [words[i] for i in step]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


BLOCK_SCHEMA = "block long, word binary, number int, n long, doc_id long, held_out boolean, n_tokens long, body binary"


def _blocks(docs: DataFrame, held_out: Column) -> DataFrame:
    """Rows of two kinds: words of a block (word, number, n in training) and
    its documents (doc_id, held_out, n_tokens, body: zstd of the numbers of its
    distinct words, as sorted differences, and how often each occurs)."""
    names = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]

    def batch(block: int, **cols):
        size = len(next(iter(cols.values())))
        return pa.RecordBatch.from_arrays([pa.array([block] * size, t) if n == "block" else pa.array(cols[n], t) if n in cols else pa.nulls(size, t) for n, t in zip(names, types)], names)

    def cut(batches):
        zip_ = zstandard.ZstdCompressor(level=1).compress
        block = TaskContext.get().partitionId() << 32
        numbers, seen, held = _Numbers(), np.zeros(1 << 16, np.int64), 0

        def vocabulary():
            words = list(numbers)
            for k in range(0, len(words), 50_000):
                part = words[k:k + 50_000]
                yield batch(block, word=part, number=np.arange(k, k + len(part), dtype=np.int32), n=seen[k:k + len(part)])

        for b in slices(batches):
            bodies, sizes = [], []
            held_flags = b.column("held_out").to_pylist()
            for text, out in zip(b.column("text"), held_flags):
                words = text.as_buffer().to_pybytes().lower().split() if text.is_valid else []
                held += sum(map(len, words))
                ids, times = np.unique(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)), return_counts=True)
                if len(seen) < len(numbers):
                    seen = np.concatenate([seen, np.zeros(max(len(seen), len(numbers) - len(seen)), np.int64)])
                if not out:
                    seen[ids] += times
                bodies.append(zip_(np.diff(ids, prepend=np.uint32(0)).astype("<u4").tobytes() + times.astype("<u4").tobytes()))
                sizes.append(len(words) + 1)
            yield batch(block, doc_id=b.column("doc_id"), held_out=held_flags, n_tokens=sizes, body=bodies)
            if held > BLOCK_BYTES or len(numbers) > BLOCK_WORDS:
                yield from vocabulary()
                block, numbers, seen, held = block + 1, _Numbers(), np.zeros(1 << 16, np.int64), 0
        yield from vocabulary()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(cut, BLOCK_SCHEMA)


def learn(words: DataFrame, vocabulary: Pieces, rounds: int) -> Pieces:
    """The vocabulary with weights re-estimated from distinct words (column
    word), each counted once.  A round gathers one row a piece."""
    spark = words.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(vocabulary)

        def expected(batches, shared=shared):
            v, total = shared.value, 0.0
            for b in batches:
                for _, part in _steps(b.column("word").to_pylist()):
                    total = total + lattices(v, part, counts=True)[1]
            if np.ndim(total):
                at = np.flatnonzero(total > 1e-9)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["piece", "uses"])

        got = words.select("word").mapInArrow(expected, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.exp(vocabulary.logs)  # one use spread by the old weights: no piece gets weight 0
        uses[got["piece"].to_numpy(dtype=np.int64)] += got["uses"].to_numpy()
        vocabulary = Pieces(vocabulary.pieces, np.log(uses / uses.sum()))
    return vocabulary


def score(docs: DataFrame, held_out: Column, vocabulary_path: str, rounds: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    word unigram), score (marginal over all segmentations) and mixed_score (word
    counts and lattice), all log10, of each document; learnt from those not ``held_out``."""
    blocks = materialise(_blocks(docs, held_out), "lm-blocks")
    vocab = blocks.filter("word IS NOT NULL").select("block", "word", "number", "n")
    texts = blocks.filter("body IS NOT NULL").select("block", "doc_id", "held_out", "n_tokens", "body")
    words = materialise(vocab.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    ends, running = texts.filter(~F.col("held_out")).agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    distinct = words.filter("c > 0").count() + (1 if ends else 0)
    total = int(running)
    pieces = learn(words.filter("c > 0"), Pieces.load(vocabulary_path), rounds)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    smooth = DISCOUNT * distinct / total if total else 1.0

    def arcs(batches):
        for b in batches:
            known = b.column("word").to_pylist()
            logs = np.empty(len(known))
            for at, part in _steps(known):
                logs[at] = lattices(shared.value, part)[0]
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array(logs)], ["word", "c", "log"])

    scored = materialise(words.mapInArrow(arcs, "word binary, c long, log double"), "lm-scored")
    back = vocab.select("block", "word", "number").join(scored, "word").select(F.col("block").alias("of"), "number", "c", "log")
    end_base = float(np.log10((ends + 1) / (total + distinct + 1)))
    stop = (ends + 0.5) / (total + 1)
    stop_log, on_log = float(np.log10(stop)), float(np.log10(1 - stop))
    # of the mass of the end the discounted part is lost to the pieces, as for any token
    end_mixed = float(np.log10(max(ends - DISCOUNT, 0.25) / total)) if total else 0.0
    denominator = float(total + distinct + 1)

    def summed(key, left: pa.Table, right: pa.Table):
        count = right.num_rows
        c, logs = np.zeros(count, np.int64), np.zeros(count)
        at = right.column("number").to_numpy()
        c[at], logs[at] = right.column("c").to_numpy(), right.column("log").to_numpy()
        base = np.log10((c + 1) / denominator)
        # the whole word's share beside the lattice's, in log space
        whole = np.log(np.maximum(c - DISCOUNT, 0) / max(total, 1), where=c > 0, out=np.full(count, -np.inf))
        mixed = np.logaddexp(whole, np.log(smooth) + logs) / np.log(10)
        logs = logs / np.log(10) + on_log
        unzip = zstandard.ZstdDecompressor().decompress
        known, bases, scores, mixes = [], [], [], []
        for body in left.column("body").to_pylist():
            pairs = np.frombuffer(unzip(body), "<u4").reshape(2, -1)
            ids, times = np.cumsum(pairs[0], dtype=np.int64), pairs[1].astype(np.float64)
            known.append(int(times[c[ids] > 0].sum()) + (1 if ends else 0))
            bases.append(float(base[ids] @ times) + end_base)
            scores.append(float(logs[ids] @ times) + stop_log)
            mixes.append(float(mixed[ids] @ times) + end_mixed)
        n = left.num_rows
        return pa.table({"doc_id": left.column("doc_id"), "held_out": left.column("held_out"), "n_tokens": left.column("n_tokens"), "n_known": pa.array(known, pa.int64()),
                         "train_tokens": pa.array([total] * n, pa.int64()), "base_score": pa.array(bases, pa.float64()), "score": pa.array(scores, pa.float64()), "mixed_score": pa.array(mixes, pa.float64())})

    return texts.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(
        summed, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, mixed_score double")
