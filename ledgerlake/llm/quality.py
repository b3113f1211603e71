"""Quality classifier: a sparse rule ensemble over text statistics (operator 5).

1. One pass over whole texts computes the statistics of ``STATISTICS``.
2. Spark ML grows a random forest of shallow trees on labelled rows.  Every
   path from a root to a node is a rule: a conjunction of comparisons of
   statistics.  Equal rules are kept once.
3. A lasso logistic regression (Spark ML, elastic net 1) over the rules' 0/1
   values gives most of them weight zero.
4. The rules left become one Spark column expression: the logistic function
   of the intercept plus the weights of the rules that hold.

Training reads all labelled rows, spread over the cluster; the model (at most
``trees * (2 ** (depth + 1) - 2)`` rules) is of fixed size.

Nulls, ties and odd input: a null text is an empty one, whose statistics are
all 0, and is scored like any other.  Rows without a label are not trained on;
a doc_id labelled several times counts with its lowest label; repeated
documents are rows of their own.  With labels of one class only the score is
that class (0 or 1), without any label 0.5.  Other columns are kept as they
are, but for ones named like the results, which are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, slices

STATISTICS = (
    "n_words",            # log of 1 + words
    "n_lines",            # log of 1 + lines
    "word_length",        # mean bytes of a word
    "upper_share",        # capital ASCII letters of all ASCII letters
    "digit_share",        # digits of all bytes
    "stop_share",         # full stops and commas of all words
    "symbol_share",       # other ASCII punctuation of all bytes
    "top_word",           # share of the commonest word
    "distinct_words",     # distinct words a word
    "repeats",            # words equal to the one before them
    "repeated_fives",     # five-word runs that occurred before
    "repeated_lines",     # lines that occurred before
    "short_words",        # words of one or two bytes
    "single_symbols",     # words without a letter or digit
    "worst_upper",        # the largest upper_share of a 40-word window (they overlap by half)
    "worst_symbols",      # the largest symbol_share of a window
    "worst_repeats",      # the largest share of words of a window that occurred in it before
    "line_words",         # log of 1 + words a line
    "capital_words",      # words in capitals only
)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in b".,'-")
_KEEP_UPPER = bytes(b for b in range(256) if b not in _UPPER)
_KEEP_LOWER = bytes(b for b in range(256) if b not in _LOWER)
_KEEP_SYMBOLS = bytes(b for b in range(256) if b not in _SYMBOLS)
_KEEP_DIGITS = bytes(b for b in range(256) if b not in _DIGITS)
WINDOW = 40


def statistics(text: bytes) -> list[float]:
    """The values of STATISTICS for a whole UTF-8 text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = len(text)
    upper, lower = len(text.translate(None, _KEEP_UPPER)), len(text.translate(None, _KEEP_LOWER))
    symbols = len(text.translate(None, _KEEP_SYMBOLS))
    counts = Counter(words)
    code = {w: k for k, w in enumerate(counts)}
    ids = np.fromiter(map(code.__getitem__, words), np.int64, n)
    fives = 0
    if n >= 5:
        runs = ids[:-4].astype(np.uint64)
        for k in range(1, 5):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + ids[k:n - 4 + k].astype(np.uint64)
        fives = 1 - len(np.unique(runs)) / len(runs)
    lines = [x for x in text.split(b"\n") if x.strip()]
    worst_upper = worst_symbols = worst_repeats = 0.0
    # windows overlap by half; the last one holds the final words, so no word is left out
    for k in [*range(0, n - WINDOW, WINDOW // 2), max(0, n - WINDOW)]:
        part = words[k:k + WINDOW]
        raw = b" ".join(part)
        up, low = len(raw.translate(None, _KEEP_UPPER)), len(raw.translate(None, _KEEP_LOWER))
        worst_upper = max(worst_upper, up / max(1, up + low))
        worst_symbols = max(worst_symbols, len(raw.translate(None, _KEEP_SYMBOLS)) / len(raw))
        worst_repeats = max(worst_repeats, 1 - len(set(part)) / len(part))
    no_letters = sum(c for w, c in counts.items() if w.isascii() and not any(chr(b).isalnum() for b in w))
    capitals = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    return [
        float(np.log1p(n)), float(np.log1p(len(lines))), sum(map(len, words)) / n, upper / max(1, upper + lower), len(text.translate(None, _KEEP_DIGITS)) / size,
        (text.count(b".") + text.count(b",")) / n, symbols / size, max(counts.values()) / n, len(counts) / n,
        float((ids[1:] == ids[:-1]).sum()) / n, fives, 1 - len(set(lines)) / len(lines), sum(c for w, c in counts.items() if len(w) <= 2) / n, no_letters / n,
        worst_upper, worst_symbols, worst_repeats, float(np.log1p(n / len(lines))), capitals / n,
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each document's text, in one pass."""
    def counted(batches):
        for b in slices(batches):
            rows = [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column("text")]
            stats = np.array(rows, np.float64).reshape(-1, len(STATISTICS)).round(6)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(stats[:, k]) for k in range(len(STATISTICS)))], ["doc_id", *STATISTICS])

    schema = "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(counted, schema)


def add_statistics(docs: DataFrame, prefix: str) -> DataFrame:
    """``docs`` (any columns, text among them) with the statistics of each row's
    text, named with ``prefix``; columns of docs that have these names are replaced."""
    names = [prefix + s for s in STATISTICS]
    keep = docs.select([c for c in docs.columns if c not in names])

    def counted(batches):
        for b in slices(batches):
            rows = [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column("text")]
            stats = np.array(rows, np.float64).reshape(-1, len(STATISTICS)).round(6)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(stats[:, k]) for k in range(len(STATISTICS)))], [*b.schema.names, *names])

    return keep.mapInArrow(counted, T.StructType([*keep.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names)]))


Rule = tuple[tuple[int, str, float], ...]  # (statistic, "<=" or ">", threshold), sorted


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]  # with their weights, none zero
    constant: float | None = None  # the score where nothing could be learnt

    def score(self, prefix: str = "") -> Column:
        """The model as a column expression over the statistics (named with ``prefix``)."""
        if self.constant is not None:
            return F.lit(self.constant)
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule, prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def condition(rule: Rule, prefix: str = "") -> Column:
    return reduce(Column.__and__, [F.col(prefix + STATISTICS[f]) <= t if op == "<=" else F.col(prefix + STATISTICS[f]) > t for f, op, t in rule])


_SPLIT = re.compile(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def tree_paths(tree: str) -> set[Rule]:
    """The rules of a Spark ML tree, from its text: a line's depth is its indent."""
    out: set[Rule] = set()
    path: list[tuple[int, int, str, float]] = []
    for line in tree.splitlines():
        found = _SPLIT.search(line)
        if not found:
            continue
        depth = len(line) - len(line.lstrip())
        path = [p for p in path if p[0] < depth] + [(depth, int(found[2]), found[3], float(found[4]))]
        # of several comparisons of one statistic in one direction the tightest holds
        tight: dict[tuple[int, str], float] = {}
        for _, f, op, t in path:
            old = tight.get((f, op))
            tight[f, op] = t if old is None else (min(old, t) if op == "<=" else max(old, t))
        out.add(tuple(sorted((f, op, t) for (f, op), t in tight.items())))
    return out


def fit(rows: DataFrame, trees: int = 16, depth: int = 3, lasso: float = 5e-4, seed: int = 7) -> RuleEnsemble:
    """The ensemble of labelled rows (STATISTICS and ``label`` 0 or 1)."""
    classes = {int(r[0]): r[1] for r in rows.groupBy("label").count().collect()}  # two rows
    if len(classes) < 2:
        return RuleEnsemble(0.0, (), float(next(iter(classes))) if classes else 0.5)
    data = rows.select(array_to_vector(F.array(*STATISTICS)).alias("features"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=seed, featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(data)
    rules = sorted(set().union(*(tree_paths(t.toDebugString) for t in forest.trees)))
    if not rules:
        return RuleEnsemble(0.0, (), classes[1] / sum(classes.values()))
    values = rows.select(array_to_vector(F.array(*[condition(r).cast("double") for r in rules])).alias("features"), F.col("label").cast("double").alias("label"))
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(values)
    return RuleEnsemble(float(lr.intercept), tuple((r, float(w)) for r, w in zip(rules, lr.coefficients) if w))


#: Bits of the bitmap of labelled ids (8 MB at most, whatever the number of labels).
LABEL_BITS = 1 << 26


def labelled(docs: DataFrame, labels: DataFrame, use: Column) -> DataFrame:
    """doc_id and text of the rows of ``docs`` that ``learn`` could use: all rows whose doc_id
    has a label where ``use`` holds, and a few others whose hashed id falls on the bit of one.
    The bitmap has a fixed size and goes to the documents, so no text is shuffled."""
    def slot(doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(LABEL_BITS)) + 1  # from 1: bucket and bit count up together

    own = slot(F.col("doc_id"))
    marks = (labels.filter(use & F.col("quality").isin(0, 1)).groupBy(F.bitmap_bucket_number(own).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias("marks")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.bitmap_bucket_number(own).alias("bucket"), F.bitmap_bit_position(own).alias("bit"))
    byte = F.conv(F.hex(F.col("marks").substr((F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("bit") % 8)), F.lit(2)) == 1
    return rows.join(F.broadcast(marks), "bucket").filter(marked).select("doc_id", "text")


def learn(stats: DataFrame, labels: DataFrame, use: Column) -> RuleEnsemble:
    """The ensemble of ``stats`` (doc_id and STATISTICS) with ``labels`` (doc_id,
    quality), learnt where ``use`` (of doc_id) holds."""
    known = labels.filter(use & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("label"))
    return fit(materialise(stats.join(known, "doc_id").select(*STATISTICS, "label"), "quality-train"))


def score(docs: DataFrame, labels: DataFrame, use: Column, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 if score >= threshold) of each document;
    ``labels`` (doc_id, quality) are learnt from where ``use`` (of doc_id) holds."""
    stats = materialise(with_statistics(docs), "statistics")
    model = learn(stats, labels, use)
    return stats.select("doc_id", model.score().alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
