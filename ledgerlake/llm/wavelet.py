"""Token-id output as wavelet-matrix files (operator 2).

``write_tokens`` encodes whole texts, ends each document with an end id,
orders documents by ``doc_id`` over shards and writes one binary file a
shard.  A file is a run of segments, each at most about ``segment_tokens`` ids
(plus the document that crosses it); a segment is a wavelet matrix: for each
bit of the ids, highest first, one bit plane, the ids being stably split into
zeros and ones after each plane.  Planes are zstd-compressed in blocks of
PLANE_BLOCK bytes, each unpacked only when it is asked for, and come with a
directory of one-counts every 512 bits, so that one file answers

* ``access(i)``: the id at position ``i``,
* ``rank(c, i)``: how often ``c`` occurs before ``i`` (``count(c)``: in all),
* ``select(c, k)``: the position of the k-th ``c``,

each in one step (and one block or two) a plane, without another index.

Segment layout, little-endian: magic ``LWM2``; int64 shard; int64 segment;
uint64 documents; uint64 tokens; uint8 planes; uint8 0; then length-prefixed
(uint64) zstd blocks: doc ids (int64), null flags of doc ids (uint8), ids a
document (uint32), and for each plane its blocks (uint64 how many, then each of them) and its directory (uint32).
Spark's text writer puts the bytes of a segment and a line feed into the file
of its task, so files go through Spark's own commit on any file system;
``read_documents`` gets them back with the ``binaryFile`` source.

Nulls, ties and odd input: a null text is an empty one (its document holds the
end id only), a null ``doc_id`` sorts first, equal ``doc_id`` sort by their
ids, an empty table writes no segment.  Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, portions
from .encode import encoder

MAGIC = b"LWM2"
HEAD = struct.Struct("<4sqqQQBB")
BLOCK = 512  # bits a directory entry
PLANE_BLOCK = 1 << 14  # bytes of a plane compressed together


def _pack(raw: bytes) -> bytes:
    z = zstandard.ZstdCompressor(level=1).compress(raw)
    return struct.pack("<Q", len(z)) + z


class Plane:
    """Bits of a plane in compressed blocks; ``plane[i]`` is a byte, ``plane[a:b]``
    some of them, and only the blocks that hold them are unpacked."""

    def __init__(self, blocks: list[bytes]):
        self.blocks, self._open = blocks, {}

    def _block(self, k: int) -> np.ndarray:
        if k not in self._open:
            if len(self._open) > 8:
                self._open.clear()
            self._open[k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.blocks[k]), np.uint8)
        return self._open[k]

    def __getitem__(self, at):
        if isinstance(at, slice):
            lo, hi = at.start or 0, len(self.blocks) * PLANE_BLOCK if at.stop is None else at.stop
            first = lo // PLANE_BLOCK
            parts = [self._block(k) for k in range(first, min(len(self.blocks), max(first + 1, -(-hi // PLANE_BLOCK))))]
            return (np.concatenate(parts) if len(parts) != 1 else parts[0])[lo - first * PLANE_BLOCK:hi - first * PLANE_BLOCK] if parts else np.zeros(0, np.uint8)
        return self._block(at // PLANE_BLOCK)[at % PLANE_BLOCK]

    def whole(self) -> np.ndarray:
        unzip = zstandard.ZstdDecompressor()
        return np.frombuffer(b"".join(map(unzip.decompress, self.blocks)), np.uint8)


def _packed(plane: np.ndarray) -> bytes:
    zip_ = zstandard.ZstdCompressor(level=1)
    blocks = [zip_.compress(plane[lo:lo + PLANE_BLOCK].tobytes()) for lo in range(0, len(plane), PLANE_BLOCK)]
    return struct.pack("<Q", len(blocks)) + b"".join(struct.pack("<Q", len(b)) + b for b in blocks)


class WaveletMatrix:
    """Bit planes of a sequence of unsigned integers, highest bit first."""

    def __init__(self, n: int, planes: list[np.ndarray | Plane], ranks: list[np.ndarray]):
        self.n, self.planes, self.ranks = n, planes, ranks
        self.zeros = [n - int(r[-1]) for r in ranks]

    @classmethod
    def of(cls, values: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        if bits is None:
            bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        planes, ranks, now = [], [], values
        for b in range(bits - 1, -1, -1):
            one = (now >> b & 1).astype(bool)
            planes.append(np.packbits(one, bitorder="little"))
            ranks.append(_directory(planes[-1]))
            now = np.concatenate([now[np.flatnonzero(~one)], now[np.flatnonzero(one)]])
        return cls(len(values), planes, ranks)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position ``i``."""
        block = i // BLOCK
        part = self.planes[level][block * BLOCK // 8:(i + 7) // 8]
        bits = np.unpackbits(part, bitorder="little")[:i - block * BLOCK]
        return int(self.ranks[level][block]) + int(bits.sum())

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, c: int, i: int) -> tuple[int, int]:
        """Where the ``c`` among the first ``i`` positions stand after the last plane."""
        lo, hi, last = 0, i, len(self.planes) - 1
        if c < 0 or c >> len(self.planes):
            return 0, 0
        for level in range(last + 1):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if c >> last - level & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, c: int, i: int) -> int:
        lo, hi = self._range(c, i)
        return hi - lo

    def count(self, c: int) -> int:
        return self.rank(c, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that value in a plane."""
        ranks = self.ranks[level]
        before = ranks[:-1].astype(np.int64) if bit else np.arange(len(ranks) - 1) * BLOCK - ranks[:-1].astype(np.int64)
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8]
        bits = np.unpackbits(part, bitorder="little")[:self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def select(self, c: int, k: int) -> int:
        """Position of the k-th (from 0) ``c``; -1 if there are not so many."""
        lo, hi = self._range(c, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = c >> len(self.planes) - 1 - level & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def _bits(self, level: int) -> np.ndarray:
        plane = self.planes[level]
        return np.unpackbits(plane.whole() if isinstance(plane, Plane) else plane, count=self.n, bitorder="little").astype(bool)

    def positions(self, c: int) -> np.ndarray:
        """Every position of ``c``, ascending."""
        at = np.arange(*self._range(c, self.n), dtype=np.int64)
        for level in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            bit = bool(c >> len(self.planes) - 1 - level & 1)
            at = np.flatnonzero(self._bits(level) == bit)[at - self.zeros[level] if bit else at]
        return np.sort(at)

    def values(self) -> np.ndarray:
        """The whole sequence: planes undone from the last to the first."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            one = self._bits(level)
            up, zeros = np.empty_like(out), self.zeros[level]
            up[np.flatnonzero(~one)] = out[:zeros]
            up[np.flatnonzero(one)] = out[zeros:] | out.dtype.type(1 << len(self.planes) - 1 - level)
            out = up
        return out


def _directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane, and in all."""
    full = np.zeros(-(-len(plane) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
    full[:len(plane)] = plane
    return np.concatenate([[0], np.cumsum(np.bitwise_count(full.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64))]).astype(np.uint32)


def write_segment(shard: int, segment: int, doc_ids: list[int | None], lengths: list[int], values: np.ndarray, bits: int) -> bytes:
    wm = WaveletMatrix.of(values, bits)
    out = [HEAD.pack(MAGIC, shard, segment, len(doc_ids), len(values), bits, 0),
           _pack(np.array([d or 0 for d in doc_ids], "<i8").tobytes()), _pack(np.array([d is None for d in doc_ids], np.uint8).tobytes()),
           _pack(np.array(lengths, "<u4").tobytes())]
    for plane, ranks in zip(wm.planes, wm.ranks):
        out += [_packed(plane), _pack(ranks.astype("<u4").tobytes())]
    return b"".join(out)


def read_segments(content: bytes) -> Iterator[tuple[int, int, list[int | None], np.ndarray, WaveletMatrix]]:
    """(shard, segment, doc ids, ids a document, wavelet matrix) of each segment of a file."""
    at, unzip = 0, zstandard.ZstdDecompressor()

    def block(dtype: str) -> np.ndarray:
        nonlocal at
        (size,) = struct.unpack_from("<Q", content, at)
        raw = unzip.decompress(content[at + 8:at + 8 + size])
        at += 8 + size
        return np.frombuffer(raw, dtype)

    def plane() -> Plane:
        nonlocal at
        (many,) = struct.unpack_from("<Q", content, at)
        blocks, at = [], at + 8
        for _ in range(many):
            (size,) = struct.unpack_from("<Q", content, at)
            blocks.append(content[at + 8:at + 8 + size])
            at += 8 + size
        return Plane(blocks)

    while at < len(content):
        magic, shard, segment, docs, n, bits, _ = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += HEAD.size
        ids, null, lengths = block("<i8"), block("u1"), block("<u4")
        if len(ids) != docs:
            raise ValueError("torn token file")
        planes, ranks = zip(*[(plane(), block("<u4")) for _ in range(bits)])
        yield shard, segment, [None if z else int(d) for d, z in zip(ids, null)], lengths, WaveletMatrix(n, list(planes), list(ranks))
        at += 1  # the writer's line feed


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_bytes: int = 24 << 20, segment_tokens: int = 1 << 20) -> None:
    """Writes the ids of ``docs`` (doc_id, text) as wavelet-matrix files below
    ``path``: shards of about ``shard_bytes`` of text, cut at quantiles of
    ``doc_id``, so that files in shard order hold documents in id order."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    cuts = sorted({int(c) for c in docs.approxQuantile("doc_id", [i / shards for i in range(1, shards)], 0.2 / shards)}) if shards > 1 else []

    def encoded(batches):
        enc, ends = encoder(tokenizer), np.array(cuts, np.int64)
        end = enc.ids([end_id])
        for b in portions(batches, "text"):
            doc = b.column("doc_id")
            shard = np.searchsorted(ends, doc.fill_null(-2**63).to_numpy(), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), doc, enc.batch(b.column("text"), end)], ["shard", "doc_id", "ids"])

    def segments(batches):
        enc = encoder(tokenizer)
        width = np.dtype("<u2" if enc.width == 2 else "<u4")
        bits = enc.width * 8
        shard, segment, held, doc_ids, lengths, size = None, 0, [], [], [], 0

        def cut():
            nonlocal segment, held, doc_ids, lengths, size
            if not doc_ids:
                return
            raw = write_segment(shard, segment, doc_ids, lengths, np.frombuffer(b"".join(held), width), bits)
            segment, held, doc_ids, lengths, size = segment + 1, [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["value"])

        for b in batches:
            for s, doc, ids in zip(b.column("shard").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids")):
                if s != shard:
                    yield from cut()
                    shard, segment = s, 0
                ids = ids.as_py()
                held.append(ids)
                doc_ids.append(doc)
                lengths.append(len(ids) // width.itemsize)
                size += lengths[-1]
                if size >= segment_tokens:
                    yield from cut()
        yield from cut()

    (docs.mapInArrow(encoded, "shard int, doc_id long, ids binary")
     .repartition(shards, "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
     .mapInArrow(segments, "value binary")
     .select(F.col("value").cast("string").alias("value")).write.option("compression", "none").text(path))


def read_documents(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """One row a document read back from the files: shard, segment, position
    (of the document in its segment), doc_id, seg_start (ids of the segment
    before it), n_tokens, ids (binary, little-endian uint32); with ``digest``
    ids_crc32 in place of ids."""
    last = "ids_crc32" if digest else "ids"

    def decoded(batches):
        for b in batches:
            for content in b.column("content"):
                for shard, segment, doc_ids, lengths, wm in read_segments(content.as_py()):
                    ends = np.cumsum(lengths, dtype=np.int64)
                    raw = wm.values().astype("<u4").tobytes()
                    ids = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                    ids = pa.array([crc32(x) for x in ids], pa.int64()) if digest else pa.array(ids, pa.binary())
                    k = len(doc_ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, shard)), pa.array(np.full(k, segment)), pa.array(np.arange(k)), pa.array(doc_ids, pa.int64()),
                         pa.array(ends - lengths), pa.array(lengths.astype(np.int64)), ids],
                        ["shard", "segment", "position", "doc_id", "seg_start", "n_tokens", last])

    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(decoded, "shard long, segment long, position long, doc_id long, seg_start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Every place of a token: doc_id and offset (ids of its document before
    it), looked up with rank and select in each file."""
    def found(batches):
        for b in batches:
            for content in b.column("content"):
                for _, _, doc_ids, lengths, wm in read_segments(content.as_py()):
                    at = wm.positions(token)
                    ends = np.cumsum(lengths, dtype=np.int64)
                    of = np.searchsorted(ends, at, side="right")
                    yield pa.RecordBatch.from_arrays([pa.array([doc_ids[i] for i in of], pa.int64()), pa.array(at - (ends - lengths)[of])], ["doc_id", "offset"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(found, "doc_id long, offset long")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it over all files), n_tokens,
    ids_crc32 of each document in the files."""
    docs = materialise(read_documents(spark, path, digest=True), "token-digests")
    # ids before each segment in its shard, and before each shard: one row a shard is summed up in one task
    size = docs.groupBy("shard", "segment").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = size.groupBy("shard").agg(F.sum("size").alias("total")).withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    size = size.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).drop("size")
    out = docs.join(size, ["shard", "segment"]).join(shards, "shard")
    return out.select("doc_id", (F.col("base") + F.col("inside") + F.col("seg_start")).alias("start"), "n_tokens", "ids_crc32")
