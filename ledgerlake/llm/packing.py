"""Packing token ids into training sequences (operator 6): best-fit decreasing.

Each document's ids, ended by an end id, are cut into full windows and one
rest shorter than a window.  A full window is a sequence of its own.  Rests
are packed best-fit decreasing: longest first, each into the open window with
the least remaining capacity that holds it.  A segment tree over remaining
capacities (a leaf a capacity, a node marks whether an open window lies below
it) finds that window in log2(window) steps.

Windows are filled by the task that encodes the documents, in blocks of at
most ``block_tokens`` ids of rests, so texts and ids are never shuffled and a
task holds one block.  A block wastes less than its last open windows; with
thousands of documents in a block that is far below a percent.

A null text is an empty one: its document is the end id alone.  Equal lengths
are taken in arrival order; repeated rows are packed as documents of their
own; an empty table gives no row.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions
from .encode import encoder


class OpenWindows:
    """Open windows by remaining capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.live = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, window: int, room: int) -> None:
        if room <= 0:
            return
        if not self.windows[room]:
            node = room + self.leaves
            while node and not self.live[node]:
                self.live[node] = 1
                node >>= 1
        self.windows[room].append(window)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns (window, room) of least room >= size."""
        node = size + self.leaves
        if not self.live[node]:
            # up to the first right sibling with a window, then down its left side
            while node > 1 and (node & 1 or not self.live[node ^ 1]):
                node >>= 1
            if node <= 1:
                return None
            node ^= 1
            while node < self.leaves:
                node = 2 * node if self.live[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            self.live[node] = 0
            while node > 1 and not self.live[node ^ 1]:
                node >>= 1
                self.live[node] = 0
        return window, room


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Window and offset of each length (1 to capacity), and how many windows."""
    window_of, offset_of = [0] * len(lengths), [0] * len(lengths)
    tree, count = OpenWindows(capacity), 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        if (got := tree.take(lengths[i])) is None:
            got, count = (count, capacity), count + 1
        window_of[i], offset_of[i] = got[0], capacity - got[1]
        tree.add(got[0], got[1] - lengths[i])
    return window_of, offset_of, count


SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 1024, block_tokens: int = 4_000_000) -> DataFrame:
    """One row a piece of ``docs`` (doc_id, text): doc_id, start (ids of its
    document before it), length, doc_tokens (with the end id), sequence_id,
    offset (in the sequence), ids (binary, little-endian uint32)."""
    def packed(batches):
        enc = encoder(tokenizer)
        end, width = enc.ids([end_id]), enc.width
        base, rests, held = (TaskContext.get().partitionId() << 32), [], 0

        def out(cols):
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())], [f.split()[0] for f in SCHEMA.split(", ")])

        def flush():
            nonlocal base, rests, held
            where, offset, count = best_fit_decreasing([len(r[3]) // 4 for r in rests], window)
            for k in range(0, len(rests), 20_000):
                part = slice(k, k + 20_000)
                doc, start, total, raw = zip(*rests[part])
                yield out([doc, start, [len(x) // 4 for x in raw], total, [base + w for w in where[part]], offset[part], raw])
            base, rests, held = base + count, [], 0

        for b in portions(batches, "text"):
            full: list[list] = [[] for _ in range(7)]
            ids = enc.batch(b.column("text"), end)
            edges = (np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1) // width).tolist()
            raw = np.frombuffer(ids.buffers()[2], f"<u{width}", edges[-1]).astype("<u4").tobytes()
            for doc, lo, hi in zip(b.column("doc_id").to_pylist(), edges, edges[1:]):
                total = hi - lo
                cut = total // window * window
                for k in range(0, cut, window):
                    for col, x in zip(full, (doc, k, window, total, base, 0, raw[4 * (lo + k):4 * (lo + k + window)])):
                        col.append(x)
                    base += 1
                if cut < total:
                    rests.append((doc, cut, total, raw[4 * (lo + cut):4 * hi]))
                    held += total - cut
            if full[0]:
                yield out(full)
            if held >= block_tokens:
                yield from flush()
        if rests:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(packed, SCHEMA)
