"""Hard negatives by the threshold algorithm (operator 11).

Scores are integer inner products: each component x becomes floor(scale * x).
An anchor's positives are its best other rows of the same label; a positive of
score s opens the window of scores from s * low to s * high, and the best rows
of other labels inside it are the hard negatives.

Rows are cut into blocks by a hash of their id.  A block keeps a list of its
rows for each dimension, sorted by that component.  For an anchor the lists are
read in steps, each from the end that its sign favours (a component of zero adds
nothing, so its list stays closed); every row met is scored in full.  What no list has
shown yet scores at most the sum of anchor x last component read: once this
threshold is strictly below the k-th score found for every window (or below the
window itself) the anchor is done with the block.  Strictly, because rows of the same score
and smaller id may still come.  The first pass finds positives (one window
without bounds), the second negatives, each merged from the blocks' lists.

Blocks of about ``block_values`` components meet blocks of as many of anchors:
a task holds one of each, whatever the sizes of labels, and copies of a vector
are spread by their ids.  Anchors are a stated set of queries against all rows.

Nulls, ties and odd input: rows with a null id, label or vector, an empty
vector, or a null or non-finite component take no part; zero vectors do.  Of
differing lengths the commonest takes part (the longer, if equal).  Equal scores
go to the smaller id, then the smaller label.  Repeated rows count once; rows of
the anchor's own id are not its positives or negatives.  Anchors that share id
and label but not the vector are one anchor, with the better score of each row.  A window without rows
gives none (a negative positive's window is empty, zero's holds zero alone).  Components
beyond the range of a long after scaling are the range's end, scores likewise; sums too large
for exact doubles are taken in Python integers.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Rows that a list shows in the first step; each step reads to twice the depth.
STEP = 32
LONG = np.iinfo(np.int64)


class Block:
    """Rows with their sorted lists, one for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        # rows by id: of equal scores the first is the one to keep
        by = np.lexsort((labels, ids))
        self.ids, self.labels, self.rows = ids[by], labels[by], rows[by]
        self.order = np.argsort(self.rows, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(self.rows.T, self.order, axis=1)

    def search(self, anchor: np.ndarray, takes: np.ndarray, windows: list[tuple[int, int]], k: int) -> tuple[list[np.ndarray], np.ndarray, int]:
        """Of each window (least and greatest score) the ``k`` best rows where
        ``takes`` holds; all scores found; the depth read."""
        n = len(self.ids)
        score = np.zeros(n, self.rows.dtype)
        seen = np.zeros(n, bool)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        depth, step = 0, STEP
        while True:
            if len(up) + len(down):
                upto = min(n, depth + step)
                met = np.zeros(n, bool)
                met[self.order[up, n - upto:n - depth]] = True
                met[self.order[down, depth:upto]] = True
                best = (anchor[up] * self.sorted[up, n - upto]).sum() + (anchor[down] * self.sorted[down, upto - 1]).sum()
            else:  # no list to read: every row scores zero
                upto, met, best = n, np.ones(n, bool), 0
            new = np.flatnonzero(met & ~seen)
            score[new] = self.rows[new] @ anchor
            seen[new] = True
            depth, step = upto, 2 * step
            found = np.flatnonzero(seen & takes)
            at = score[found]
            inside = [found[(at >= low) & (at <= high)] for low, high in windows]
            if depth == n or all(best < low or len(x) >= k and best < np.partition(score[x], len(x) - k)[len(x) - k]
                                 for (low, _), x in zip(windows, inside)):
                return [x[np.argsort(-score[x], kind="stable")[:k]] for x in inside], score, depth


def _numbers(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where these add without rounding, else as Python integers."""
    top = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    kind = np.float64 if top[0] * top[1] * a.shape[1] < 1 << 53 else object
    return a.astype(kind), b.astype(kind)


def _long(scores: list) -> pa.Array:
    return pa.array([min(max(int(s), LONG.min), LONG.max) for s in scores], pa.int64())


def _of_blocks(anchors: DataFrame, rows: DataFrame, ablocks: int, blocks: int, found, schema: str) -> DataFrame:
    """``found(anchors, rows)`` of every block of anchors with every block of rows."""
    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def meet(key, left: pa.Table, right: pa.Table):
        return found(left, right) if left.num_rows and right.num_rows else _rows([], schema)

    asked = anchors.withColumn("block", numbers(blocks)).groupBy("ablock", "block")
    return asked.cogroup(rows.withColumn("ablock", numbers(ablocks)).groupBy("ablock", "block")).applyInArrow(meet, schema)


_POSITIVE = "anchor_id long, anchor_label long, positive_id long, positive_label long, positive_score long"
_NEGATIVE = "anchor_id long, anchor_label long, positive_score long, negative_id long, negative_label long, negative_score long"
_TYPES = {s: [(x.split()[0], pa.int64()) for x in s.split(", ")] for s in (_POSITIVE, _NEGATIVE)}


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, scale: float = 256.0,
         low_percent: int = 50, high_percent: int = 95, block_values: int = 262_144) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    of ``vectors`` (vec_id, embedding, and what ``label`` and ``is_anchor`` read)."""
    v = F.col("embedding").cast("array<double>")
    finite = F.coalesce(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & (F.size("v") > 0))
            .withColumn("v", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("long"))))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim, total = (sizes["dim"], sizes["count"]) if sizes else (1, 1)
    block_rows = max(1, block_values // dim)
    blocks = -(-total // block_rows)

    def block(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.hash("label", "v"), F.lit(salt)), F.lit(n)).cast("int")

    rows = materialise(rows.filter(F.size("v") == dim).distinct().withColumn("block", block(1, blocks)), "negatives-rows")
    asks = rows.filter("asks")
    asking = max(1, -(-asks.count() // block_rows))
    asks = asks.select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("v").alias("anchor"), block(2, asking).alias("ablock"))
    rows = rows.select("vec_id", "label", "v", "block")

    def opened(left: pa.Table, right: pa.Table):
        a, b = _exact(_numbers(left.column("anchor"), dim), _numbers(right.column("v"), dim))
        return a, Block(right.column("vec_id").to_numpy(), right.column("label").to_numpy(), b)

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        a, held = opened(left, right)
        out: list[tuple] = []
        for own, lab, anchor in zip(left.column("anchor_id").to_numpy(), left.column("anchor_label").to_numpy(), a):
            (best,), score, _ = held.search(anchor, (held.labels == lab) & (held.ids != own), [(-np.inf, np.inf)], positives)
            out += [(own, lab, held.ids[x], held.labels[x], score[x]) for x in best]
        return _rows(out, _POSITIVE)

    found = _of_blocks(asks, rows, asking, blocks, near, _POSITIVE).groupBy("anchor_id", "anchor_label", "positive_id", "positive_label").agg(F.max("positive_score").alias("positive_score"))
    mine = Window.partitionBy("anchor_id", "anchor_label").orderBy(F.desc("positive_score"), "positive_id")
    best = materialise(found.withColumn("n", F.row_number().over(mine)).filter(F.col("n") <= positives).drop("n", "positive_label"), "negatives-positives")

    # an anchor's distinct positive scores, each a window; at most ``positives`` of them
    windows = best.groupBy("anchor_id", "anchor_label").agg(F.collect_set("positive_score").alias("scores"))
    asks = asks.join(windows, ["anchor_id", "anchor_label"])

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        a, held = opened(left, right)
        out: list[tuple] = []
        for own, lab, scores, anchor in zip(left.column("anchor_id").to_numpy(), left.column("anchor_label").to_numpy(), left.column("scores").to_pylist(), a):
            # least and greatest integers s with low * positive <= 100 s <= high * positive
            spans = [(-(-low_percent * s // 100), high_percent * s // 100, s) for s in scores]
            spans = [x for x in spans if x[0] <= x[1]]
            if spans:
                lists, score, _ = held.search(anchor, (held.labels != lab) & (held.ids != own), [x[:2] for x in spans], negatives)
                out += [(own, lab, s, held.ids[x], held.labels[x], score[x]) for (_, _, s), best in zip(spans, lists) for x in best]
        return _rows(out, _NEGATIVE)

    key = ["anchor_id", "anchor_label", "positive_score"]
    found = _of_blocks(asks, rows, asking, blocks, hard, _NEGATIVE).groupBy(*key, "negative_id", "negative_label").agg(F.max("negative_score").alias("negative_score"))
    rank = Window.partitionBy(*key).orderBy(F.desc("negative_score"), "negative_id", "negative_label")
    found = found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= negatives)
    return best.join(found, key).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _rows(out: list[tuple], schema: str) -> pa.Table:
    names, columns = _TYPES[schema], list(zip(*out)) or [[]] * len(_TYPES[schema])
    return pa.table({n: _long(c) for (n, _), c in zip(names, columns)})
