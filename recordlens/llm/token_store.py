"""Token ids in wavelet matrices: a compressed file per shard with access, count and lookup."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlens.llm.common import reach_package, shared_folder
from recordlens.llm.transducer import in_blocks, transducer

_HEAD = struct.Struct("<4sIII")
_STEP = 512  # bits between two entries of a rank directory


class WaveletMatrix:
    """Sequence of ids as bit planes, highest bit first, each with a rank directory.

    Ids are first numbered by the alphabet of the sequence, so a block of a few
    thousand distinct ids needs about 12 planes. At each plane the symbols with a
    0 bit move to the front, in order; ``zeros`` is their number. ``access``,
    ``rank`` and ``select`` take a step per plane; ``decode`` reads all ids.
    """

    def __init__(self, n, alphabet, zeros, planes):
        self.n, self.alphabet, self.zeros, self.planes = n, alphabet, zeros, planes
        self._dirs: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        seen = np.zeros(int(ids.max()) + 1 if n else 1, bool)
        seen[ids] = True
        alphabet = np.flatnonzero(seen).astype("<u4")
        place = np.cumsum(seen, dtype=np.int64) - 1
        wide = np.uint16 if len(alphabet) <= 1 << 16 else np.uint32
        level = place.astype(wide)[ids] if n else np.zeros(0, wide)
        zeros, planes = [], []
        for b in range(max(0, len(alphabet) - 1).bit_length() - 1, -1, -1):
            bit = (level & wide(1 << b)).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            back = np.flatnonzero(bit)  # taking by place is faster than by mask
            zeros.append(n - len(back))
            level = np.concatenate([level[np.flatnonzero(~bit)], level[back]])
        return cls(n, alphabet, np.array(zeros, "<u4"), planes)

    def to_bytes(self) -> bytes:
        """Header, alphabet, zeros, rank directories, planes."""
        head = _HEAD.pack(b"WVM1", self.n, len(self.alphabet), len(self.planes))
        dirs = b"".join(d.astype("<u4").tobytes() for d in self.dirs)
        return b"".join(
            [head, self.alphabet.tobytes(), self.zeros.tobytes(), dirs, *(p.tobytes() for p in self.planes)]
        )

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        magic, n, sigma, levels = _HEAD.unpack_from(blob)
        if magic != b"WVM1":
            raise ValueError("not a wavelet matrix")
        at = _HEAD.size
        alphabet = np.frombuffer(blob, "<u4", sigma, at)
        at += 4 * sigma
        zeros = np.frombuffer(blob, "<u4", levels, at)
        at += 4 * levels
        steps, wide = n // _STEP + 1, (n + 7) // 8
        dirs = np.frombuffer(blob, "<u4", steps * levels, at).reshape(levels, steps)
        at += 4 * steps * levels
        out = cls(n, alphabet, zeros, [np.frombuffer(blob, np.uint8, wide, at + k * wide) for k in range(levels)])
        out._dirs = list(dirs)
        return out

    @property
    def dirs(self) -> list[np.ndarray]:
        """Ones before every ``_STEP``-th bit of each plane."""
        if self._dirs is None:
            self._dirs = []
            for p in self.planes:
                ones = np.bitwise_count(np.pad(p, (0, -len(p) % (_STEP // 8)))).reshape(-1, _STEP // 8)
                sums = np.concatenate([[0], np.cumsum(ones.sum(1, dtype=np.int64))])
                self._dirs.append(sums[: self.n // _STEP + 1])
        return self._dirs

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        at = i // _STEP
        part = self.planes[k][at * _STEP // 8 : (i + 7) // 8]
        count = int(np.bitwise_count(part).sum())
        if i % 8:
            count -= int(part[-1] >> (i % 8)).bit_count()
        return int(self.dirs[k][at]) + count

    def access(self, i: int) -> int:
        code = 0
        for k, p in enumerate(self.planes):
            bit = p[i >> 3] >> (i & 7) & 1
            ones = self._ones(k, i)
            i = int(self.zeros[k]) + ones if bit else i - ones
            code = code << 1 | int(bit)
        return int(self.alphabet[code])

    def _code(self, token: int) -> int:
        c = int(np.searchsorted(self.alphabet, token))
        return c if c < len(self.alphabet) and self.alphabet[c] == token else -1

    def _range(self, code: int, lo: int, hi: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            a, b = self._ones(k, lo), self._ones(k, hi)
            if code >> (len(self.planes) - 1 - k) & 1:
                lo, hi = int(self.zeros[k]) + a, int(self.zeros[k]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token among the first i ids."""
        code = self._code(token)
        if code < 0 or not self.n:
            return 0
        lo, hi = self._range(code, 0, i)
        return hi - lo

    def locate(self, token: int) -> np.ndarray:
        """All positions of the token, ascending: ``select`` of all its occurrences at once."""
        code = self._code(token)
        if code < 0 or not self.n:
            return np.zeros(0, np.int64)
        at = np.arange(*self._range(code, 0, self.n))
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").astype(bool)
            one = code >> (len(self.planes) - 1 - k) & 1
            at = np.flatnonzero(bit if one else ~bit)[at - (int(self.zeros[k]) if one else 0)]
        return at

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence, from 0."""
        return int(self.locate(token)[k])

    def decode(self) -> np.ndarray:
        """All ids: planes are undone from the lowest to the highest."""
        wide = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        level = np.zeros(self.n, wide)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            z = int(self.zeros[k])
            out = np.empty_like(level)
            out[np.flatnonzero(~bit)] = level[:z]
            out[np.flatnonzero(bit)] = level[z:] | wide(1 << (len(self.planes) - 1 - k))
            level = out
        return self.alphabet[level] if len(self.alphabet) else level.astype("<u4")


BLOCKS = (
    "shard long, block long, first_id long, n_ids long, doc_ids array<long>, "
    "n_tokens array<long>, matrix binary"
)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    block_ids: int = 1 << 18,
    shards: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encodes whole texts and writes one file per shard, in ascending order of ids.

    Shards are ranges of ``doc_id``; a file holds blocks of whole documents with at
    least ``block_ids`` token ids (the last may be smaller), each a wavelet matrix
    with the documents' ids and token counts. Ids come from pieces that
    the tokenizers library encodes. Files are Parquet, so any store that
    Spark writes will do. The text is shuffled once; memory holds a block.

    A null or empty text is the end id alone. Null ids come first; equal ids keep
    no set order among themselves. An empty table writes no blocks.
    """
    reach_package(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc, shard = transducer(tokenizer, None, False), TaskContext.get().partitionId()
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        ids, sizes, parts, total, first, block = [], [], [], 0, 0, 0

        def batch():
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(parts), "<u4"))
            cells = [[shard], [block], [first], [total], [ids], [sizes], [matrix.to_bytes()]]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=names)

        for rows in in_blocks(batches):
            for (i, _), got in zip(rows, enc.encode([t for _, t in rows])):
                ids.append(i)
                parts.append(got.tobytes() + end)
                sizes.append(len(got) + 1)
                total += sizes[-1]
                if total >= block_ids:
                    yield batch()
                    first, block = first + total, block + 1
                    ids, sizes, parts, total = [], [], [], 0
        if ids:
            yield batch()

    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(run, BLOCKS)
        .write.option("compression", "zstd").parquet(path)
    )


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of a store with ``base``: the number of ids in all shards before."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # one row per shard (a file), so the running sum over shards is small; broadcast, as the
    # matrices would be shuffled before Spark has seen how small it is
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(base), "shard")


def _per_block(blocks: DataFrame, work, schema: str) -> DataFrame:
    """Runs ``work(start, doc_ids, n_tokens, matrix)`` for every block."""
    reach_package(blocks.sparkSession)

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                first, ids, sizes, blob = (b.column(k)[r] for k in range(4))
                yield work(first.as_py(), ids.values, sizes.values.to_numpy(), blob.as_py())

    start = F.col("base") + F.col("first_id")
    return blocks.select(start, "doc_ids", "n_tokens", "matrix").mapInArrow(run, schema)


def digests(blocks: DataFrame) -> DataFrame:
    """Per document, from the decoded blocks: ``doc_id, start, n_tokens, ids_crc32``."""

    def work(first, ids, sizes, blob):
        raw = memoryview(WaveletMatrix.from_bytes(blob).decode().astype("<u4").tobytes())
        ends = np.cumsum(sizes)
        lows = ends - sizes
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(lows.tolist(), ends.tolist())]
        cols = [ids, pa.array(first + lows), pa.array(sizes), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _per_block(blocks, work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences(blocks: DataFrame, token: int) -> DataFrame:
    """Where a token stands: ``doc_id, position`` (in the document), without decoding blocks."""

    def work(first, ids, sizes, blob):
        at = WaveletMatrix.from_bytes(blob).locate(token)
        ends = np.cumsum(sizes)
        doc = np.searchsorted(ends, at, side="right")
        cols = [ids.take(pa.array(doc)), pa.array(at - (ends - sizes)[doc])]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "position"])

    return _per_block(blocks, work, "doc_id long, position long")


def count_token(blocks: DataFrame, token: int) -> DataFrame:
    """One row: how often a token stands in the whole store."""

    def work(first, ids, sizes, blob):
        m = WaveletMatrix.from_bytes(blob)
        return pa.RecordBatch.from_arrays([pa.array([m.rank(token, m.n)], pa.int64())], names=["n"])

    return _per_block(blocks, work, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def new_path(spark: SparkSession) -> str:
    import uuid

    return f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
