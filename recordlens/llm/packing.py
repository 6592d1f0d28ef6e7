"""Packing documents into training sequences of equal attention cost."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import give_back, reach_package
from recordlens.llm.transducer import forget, in_blocks, learned, transducer

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long, cost double"
)


def assign(lengths, capacity: int, linear: float, quadratic: float):
    """Pieces ``(document, start, length, sequence, offset)`` and the sequences' sizes and costs.

    Whole sequences' worth of a long document fill sequences of their own. The
    rests go in descending order to the cheapest sequence that has room; a rest
    that fits nowhere is cut over the cheapest sequences with room left. As many
    sequences are open as the rests fill exactly; what remains after the last full
    one is laid out as sequences of power-of-two sizes, which need no padding.
    """
    price = lambda n: linear * n + quadratic * n * n
    pieces, sizes = [], []
    rests = np.zeros(len(lengths), np.int64)
    for d, n in enumerate(lengths):
        for at in range(0, n - n % capacity, capacity):
            pieces.append((d, at, capacity, len(sizes), 0))
            sizes.append(capacity)
        rests[d] = n % capacity
    first = len(sizes)
    total = int(rests.sum())
    sizes += [capacity] * (total // capacity)
    sizes += [1 << b for b in range(capacity.bit_length(), -1, -1) if (total % capacity) >> b & 1]
    room = np.array(sizes[first:], np.int64)
    cost = np.zeros(len(room))
    fill = np.zeros(len(room), np.int64)
    for d in np.argsort(-rests, kind="stable").tolist():
        left = int(rests[d])
        at = lengths[d] - left
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room)
            s = int(fits[np.argmin(cost[fits])])
            n = min(left, int(room[s]))
            pieces.append((d, at, n, first + s, int(fill[s])))
            room[s] -= n
            fill[s] += n
            cost[s] += price(n)
            left -= n
            at += n
    return pieces, sizes, [price(capacity)] * first + cost.tolist()


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 4096,
    group_tokens: int = 1 << 21,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: bool = True,
) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``capacity`` tokens.

    Each input partition packs its own documents in groups of about
    ``group_tokens`` ids, so nothing is shuffled and a lost task repeats alone;
    ``sequence_id`` holds the partition in its high bits. ``capacity`` is a power
    of two. A sequence's cost is the sum over its pieces of
    ``linear * n + quadratic * n ** 2`` (attention within a document only).

    Ids come from pieces that the tokenizers library encodes. With ``keep`` a worker holds them for later
    tasks; without, each task begins with those of a bounded sample of texts, and drops them at its end.

    A null or empty text is the end id alone; a null id stays null; repeated rows
    are packed one by one; an empty table gives no rows; other columns are ignored.
    """
    reach_package(docs.sparkSession)
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.array([end_id], "<u4").tobytes()
    start = None if keep else learned(docs, tokenizer, text_col, False)

    def rows(group, base):
        pieces, sizes, costs = assign([len(b) // 4 for _, b in group], capacity, linear, quadratic)
        d, low, n, seq, offset = (np.array(x, np.int64) for x in zip(*pieces))
        crc = [zlib.crc32(group[i][1][4 * a : 4 * (a + k)]) for i, a, k in zip(d, low, n)]
        ids = [group[i][0] for i in d]
        whole = np.array([len(group[i][1]) // 4 for i in d], np.int64)
        out = [
            pa.array(ids, pa.int64()), low, n, np.array(crc, np.int64), whole, base + seq, offset,
            np.array(sizes, np.int64)[seq], np.array(costs)[seq],
        ]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names), len(sizes)

    def run(batches):
        enc = transducer(tokenizer, start, False)
        base = TaskContext.get().partitionId() << 40
        group, tokens = [], 0
        for block in in_blocks(batches):
            for (i, _), ids in zip(block, enc.encode([t for _, t in block])):
                group.append((i, ids.tobytes() + end))
                tokens += len(ids) + 1
                if tokens >= group_tokens:
                    batch, used = rows(group, base)
                    yield batch
                    base, group, tokens = base + used, [], 0
        if group:
            yield rows(group, base)[0]
        if not keep:
            forget(tokenizer)
            enc = block = ids = group = None  # what is still named here would not be freed
            give_back()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SCHEMA)
