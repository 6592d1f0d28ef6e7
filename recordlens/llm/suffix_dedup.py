"""Long repeated strings, by run-length indexes over windows that can share one.

Every string of ``length`` bytes is filed under the least hash of the short strings
inside it (its anchor), so equal strings have the same anchor. A run of strings with
one anchor is a window. Only anchors met more than once matter; equal windows are one
row with a count. The windows of an anchor go together into a run-length index (a
run-compressed Burrows-Wheeler transform with text positions sampled at the ends of its
runs), from which the lengths of matches are streamed along the windows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import give_back, reach_package, release, stored

_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def short_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` bytes from each position."""
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: len(sums) - k]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours."""
    n = len(x) - w + 1
    pad = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    pad[: len(x)] = x
    grid = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def windows(raw: np.ndarray, ends: np.ndarray, length: int, k: int):
    """``key, start, count, twice`` of the windows of texts laid end to end (``ends``: where each ends).

    ``twice``: the anchor stands more than once in the window, so the window may hold a
    string twice.
    """
    if len(raw) < length:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    w = length - k + 1
    small = short_hashes(raw, k)
    key = sliding_min(small, w)
    lows = np.concatenate([[0], ends[:-1]])
    change = np.flatnonzero(key[1:] != key[:-1]) + 1
    last = np.maximum(lows, ends - length + 1)  # strings start before this
    cuts = np.unique(np.concatenate([change, lows, last]))
    cuts = cuts[cuts <= len(key)]
    start, stop = cuts, np.append(cuts[1:], len(key))
    own = np.searchsorted(ends, start, side="right")
    fits = (own < len(ends)) & (stop > start)
    fits[fits] &= start[fits] < last[own[fits]]
    start, stop = start[fits], stop[fits]
    # a repeating text can have one anchor for long: cut such runs
    pieces = -(-(stop - start) // w)
    first = np.repeat(start, pieces)
    step = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = first + step * w
    count = np.minimum(w, np.repeat(stop, pieces) - first)
    # places of anchors: hashes that are the least of some w neighbours
    most = ~sliding_min(np.pad(~key, w - 1, constant_values=np.iinfo(np.uint64).max), w)
    place = np.flatnonzero(most == small)
    low, high = np.searchsorted(place, first), np.searchsorted(place, first + count + w - 1)
    own = np.repeat(np.arange(len(first)), high - low)
    near = place[np.arange(len(own)) - np.repeat(np.cumsum(high - low) - high, high - low)]
    same = np.bincount(own[small[near] == key[first][own]], minlength=len(first))
    return key[first], first, count, (same > 1).astype(np.int64)


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of strings, sampled at the ends of its runs.

    ``heads`` and ``sizes`` are the runs. ``matched`` has, for the sampled text
    positions, the length of the longest common prefix with the neighbouring suffix
    across a run boundary, where that is at least ``length``. Inside a run the match of
    a suffix is the match one byte earlier, less one; so these samples give the match
    of every position in one pass over the text.
    """

    def __init__(self, strings: list[bytes], length: int):
        self.length = length
        sizes = np.array([len(s) for s in strings], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1  # each string is followed by a mark
        self.starts = self.ends - sizes
        raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        text = raw.astype(np.int64) + 1
        text[self.ends] = 0
        n = len(text)
        most = int(sizes.max()) + 1
        sa, near, span = self._sort(text, most)
        before = np.where(sa > 0, text[sa - 1], 0)
        edge = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] == 0)) + 1
        first = np.concatenate([[0], edge])
        self.heads, self.sizes = before[first], np.diff(np.append(first, n))
        p, q = sa[edge - 1], sa[edge]
        self.left = np.repeat(self.ends, sizes + 1) - np.arange(n)
        ok = (self.left[p] >= length) & (self.left[q] >= length)
        p, q = p[ok], q[ok]
        if len(p):
            shift = length - span  # equal over ``length`` bytes: equal spans at both ends
            ok = (near[p] == near[q]) & (near[p + shift] == near[q + shift])
            p, q = p[ok], q[ok]
        size = np.full(len(p), length, np.int64)
        bound = np.minimum(self.left[p], self.left[q])
        active = np.flatnonzero(size < bound)
        while len(active):
            at = size[active]
            same = text[p[active] + at] == text[q[active] + at]
            active = active[same]
            size[active] += 1
            active = active[size[active] < bound[active]]
        self.matched = np.zeros(n, np.int64)
        np.maximum.at(self.matched, p, size)
        np.maximum.at(self.matched, q, size)

    def _sort(self, text: np.ndarray, most: int):
        """Suffix array; and for every position a number for the ``span`` symbols there (span <= length)."""
        n, span = len(text), 7
        key = np.zeros(n, np.int64)
        for j in range(7):
            key = key * 257
            key[: n - j] += text[j:]
        near, kept = None, 0
        while True:
            sa = np.argsort(key, kind="stable")
            fresh = np.empty(n, np.int64)
            fresh[0] = 0
            np.not_equal(key[sa[1:]], key[sa[:-1]], out=fresh[1:].view(np.int64), casting="unsafe")
            rank = np.empty(n, np.int64)
            rank[sa] = np.cumsum(fresh)
            if span <= self.length:
                near, kept = rank, span
            if span >= most or rank[sa[-1]] == n - 1:
                return sa, near, kept
            key = rank * (n + 1)
            key[: n - span] += rank[span:] + 1
            span *= 2

    def reach(self) -> np.ndarray:
        """For each position, the end of the longest match that covers it (itself: none)."""
        at = np.arange(len(self.matched))
        return np.maximum.accumulate(at + self.matched)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal matched runs: ``string, start, end`` within the string."""
        at = np.arange(len(self.matched))
        hit = np.concatenate([[False], self.reach() > at, [False]])
        hit[1:-1][self.ends] = False
        low, high = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:])
        own = np.searchsorted(self.ends, low, side="right")
        return own, low - self.starts[own], high - self.starts[own]


def _extract(length: int, k: int):
    """Windows of documents, without their bytes."""

    def run(batches):
        for batch in batches:
            ids, marks, texts = (batch.column(i) for i in range(3))
            row = 0
            while row < batch.num_rows:
                block, size, first = [], 0, row
                while row < batch.num_rows and (size < 1_000_000 or not block):
                    block.append(texts[row].as_buffer())
                    size += len(block[-1])
                    row += 1
                joined = b"".join(block)
                ends = np.cumsum([len(b) for b in block])
                key, start, count, twice = windows(np.frombuffer(joined, np.uint8), ends, length, k)
                doc = np.searchsorted(ends, start, side="right")
                view = memoryview(joined)
                digest = xxhash.xxh3_64_intdigest
                h = [digest(view[a : a + c + length - 1]) for a, c in zip(start.tolist(), count.tolist())]
                at = pa.array(first + doc)
                lows = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)), pa.array(np.array(h, np.uint64).view(np.int64)),
                        ids.take(at), marks.take(at), pa.array(start - lows[doc]),
                        pa.array(count.astype(np.int32)), pa.array(twice > 0),
                    ],
                    names=["key", "h", "doc_id", "mark", "start", "count", "twice"],
                )
        give_back()

    return run


def _mark(length: int, block: int):
    """Matched runs of windows that come sorted by key: ``key, h, low, high``."""

    def spans(rows):
        index = RunIndex([r[3] for r in rows], length)
        own, low, high = index.spans()
        many = [i for i, r in enumerate(rows) if r[2] > 1]
        own = np.concatenate([own, np.array(many, np.int64)])
        low = np.concatenate([low, np.zeros(len(many), np.int64)])
        high = np.concatenate([high, np.array([len(rows[i][3]) for i in many], np.int64)])
        keys, hashes = (np.array([r[c] for r in rows], np.int64)[own] for c in (0, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(hashes), pa.array(low), pa.array(high)], names=["key", "h", "low", "high"]
        )

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size >= block and r[0] != rows[-1][0]:
                    yield spans(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[3])
        if rows:
            yield spans(rows)
            rows.clear()
        give_back()

    return run


def _split(length: int, k: int, step: int):
    """Parts of windows with up to ``step`` strings each, filed under what all strings of the part share.

    A string lies at some distance from the anchor inside it; strings whose distance
    falls into the same ``step`` share the bytes between them, so equal strings still
    meet. ``key, h, low, high`` name the part in its window, ``part, hash`` are its own.
    """

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for key, h, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = np.frombuffer(raw, np.uint8)
                n = len(text) - length + 1
                if step == 1:
                    parts = [(q, q + 1, digest(raw[q : q + length])) for q in range(n)]
                else:
                    small = short_hashes(text, k)
                    at = np.flatnonzero(small == np.uint64(key % (1 << 64)))
                    anchor = at[np.searchsorted(at, np.arange(n))]
                    place = (anchor - np.arange(n)) // step
                    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(place) != 0)) + 1
                    parts = []
                    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), n]):
                        core = int(anchor[a]) - int(place[a]) * step
                        inner = raw[core : core + length - step + 1]
                        parts.append((a, b, digest(inner, seed=int(place[a]) + 1)))
                size = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, key)), pa.array(np.full(size, h)),
                        pa.array([a for a, _, _ in parts], pa.int64()),
                        pa.array([b + length - 1 for _, b, _ in parts], pa.int64()),
                        pa.array(np.array([p for _, _, p in parts], np.uint64).view(np.int64)),
                        pa.array(np.array([digest(raw[a : b + length - 1]) for a, b, _ in parts], np.uint64).view(np.int64)),
                    ],
                    names=["key", "h", "low", "high", "part", "hash"],
                )

    return run


MARKS = "key long, h long, low long, high long"


def _index(rows: DataFrame, length: int, block: int) -> DataFrame:
    """Run-length indexes over ``key, h, n, raw``; all windows of a key are in one task."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.select("key", "h", "n", "raw").repartition(n, "key").sortWithinPartitions("key", "h")
        .mapInArrow(_mark(length, block), MARKS)
    )


def _hot(rows: DataFrame, most: int) -> DataFrame:
    return rows.groupBy("key").count().filter(F.col("count") > most).select("key")


def _marks(rows: DataFrame, length: int, k: int, most: int, block: int, steps: tuple[int, ...]) -> DataFrame:
    """Matched runs of distinct windows ``key, h, n, raw``, in one task per at most ``most`` windows of a key.

    Windows of a hotter key are split into parts (``_split``) that are filed more
    narrowly; parts that stay hot are split into single strings, where all rows of a
    key are equal and the count alone decides.
    """
    hot = stored(_hot(rows, most), "hot-keys")
    if not steps or hot.isEmpty():
        return _index(rows, length, block)
    cold = _index(rows.join(hot, "key", "left_anti"), length, block)
    schema = "key long, h long, low long, high long, part long, hash long"
    large = rows.join(hot, "key")
    # hot windows may come from few tasks: deal them out anew
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(large.select("key", "h", "n", "raw").repartition(n, "h"), "hot-windows")
    parts = stored(dealt.select("key", "h", "raw").mapInArrow(_split(length, k, steps[0]), schema), "parts")
    weighted = parts.join(dealt.select("key", "h", "n"), ["key", "h"])
    files = weighted.groupBy("part").agg(
        F.sum("n").alias("rows"), F.min("hash").alias("one"), F.max("hash").alias("other")
    ).filter("rows > 1")
    met = stored(parts.join(files, "part").select(parts.columns + ["one", "other"]), "met-parts")
    # all rows of the file are equal: matched as a whole
    marks = met.filter("one = other").select("key", "h", "low", "high")
    mixed = met.filter("one <> other")
    sums = mixed.join(dealt.select("key", "h", "n"), ["key", "h"]).groupBy("part", "hash").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "h", "low", "high")).alias("at")
    )
    raws = sums.select("part", "hash", F.col("n").alias("m"), "at.*").join(
        dealt.select("key", "h", "raw"), ["key", "h"]
    ).select(
        F.col("part").alias("key"), F.col("hash").alias("h"), F.col("m").alias("n"),
        F.expr("substring(raw, int(low) + 1, int(high - low))").alias("raw"),
    )
    inner = _marks(stored(raws, "part-windows"), length, k, most, block, steps[1:])
    inner = inner.toDF("part", "hash", "a", "b")
    lower = mixed.join(inner, ["part", "hash"]).select(
        "key", "h", (F.col("low") + F.col("a")).alias("low"), (F.col("low") + F.col("b")).alias("high")
    )
    return cold.unionAll(marks).unionAll(lower)


def repeats(
    docs: DataFrame,
    length: int = 400,
    k: int = 32,
    most: int = 4000,
    block: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, mark, low, high``: byte ranges covered by strings of ``length`` bytes that start elsewhere too.

    Ranges of a document may overlap. ``mark`` is a hash of the text, which tells rows
    of one id apart. A range may repeat; rows with equal id and text share their ranges.
    """
    reach_package(docs.sparkSession)
    return _repeats(_texts(docs, id_col, text_col), length, k, most, block)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.hash(text_col).alias("mark"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )


def _word_names(batches):
    """Texts as a string of eight bytes for each word."""
    for batch in batches:
        names = [
            b"".join([xxhash.xxh3_64_digest(w) for w in bytes(cell.as_buffer()).split()]) for cell in batch.column(2)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names, pa.binary())], names=["doc_id", "mark", "text"]
        )


def repeated_words(
    docs: DataFrame, words: int, k: int = 32, most: int = 4000, block: int = 1_000_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, mark, low, high``: runs of words covered by ``words`` successive words that start elsewhere too.

    As ``repeats``, over the names of the words (hashes of eight bytes) in place of the
    bytes; ``low`` and ``high`` count words. What stands between words does not matter.
    """
    reach_package(docs.sparkSession)
    names = _texts(docs, id_col, text_col).mapInArrow(_word_names, "doc_id long, mark int, text binary")
    found = _repeats(names, 8 * words, k, most, block)
    # a byte of the next word may be equal by chance: only whole names count
    whole = found.select("doc_id", "mark", F.expr("cast(ceil(low / 8) as long)").alias("low"), F.expr("high div 8").alias("high"))
    return whole.filter(F.col("high") - F.col("low") >= words)


def _repeats(texts: DataFrame, length: int, k: int, most: int, block: int) -> DataFrame:
    schema = "key long, h long, doc_id long, mark int, start long, count int, twice boolean"
    found = stored(texts.filter(F.octet_length("text") >= length).mapInArrow(_extract(length, k), schema), "windows")
    keys = found.groupBy("key").agg(
        F.count("*").alias("rows"), F.min("h").alias("one"), F.max("h").alias("other"), F.max("twice").alias("twice")
    ).filter("rows > 1 or twice").select("key", F.expr("one = other and rows > 1").alias("single"))
    met = stored(found.drop("twice").join(keys, "key"), "met-windows")
    release(found)
    # equal windows only: matched as a whole
    whole = met.filter("single").select(
        "doc_id", "mark", F.col("start").alias("low"), (F.col("start") + F.col("count") + (length - 1)).alias("high")
    )
    mixed = met.filter("not single")
    distinct = mixed.groupBy("key", "h").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "start", "count")).alias("at")
    ).select("key", "h", "n", "at.*")
    wanted = distinct.groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("key", "h", "n", "start", "count")).alias("cut")
    ).toDF("own_id", "own_mark", "cut")
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))
    raws = texts.join(wanted, same).select(F.col("text").cast("binary").alias("raw"), F.inline("cut")).select(
        "key", "h", "n", F.expr(f"substring(raw, int(start) + 1, count + {length - 1})").alias("raw")
    ).dropDuplicates(["key", "h"])
    raws = stored(raws, "window-bytes")
    marks = stored(_marks(raws, length, k, most, block, (16, 1)), "marks")
    release(raws)
    parts = mixed.join(marks, ["key", "h"]).select(
        "doc_id", "mark", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high")
    )
    return whole.unionAll(parts)


def _merge(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def with_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int | None = None, **how) -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with ``ranges`` to remove (null: none).

    With ``words`` there are ``word_ranges``, too: runs of words as of ``repeated_words``.
    """
    span = F.struct("low", "high")
    found = repeats(docs, id_col=id_col, text_col=text_col, **how).select("doc_id", "mark", span.alias("r"))
    lists = [F.collect_set("r").alias("ranges")]
    if words is not None:
        more = repeated_words(docs, words, id_col=id_col, text_col=text_col).select("doc_id", "mark", span.alias("w"))
        found = found.withColumn("w", F.lit(None).cast(more.schema["w"].dataType)).unionByName(
            more.withColumn("r", F.lit(None).cast(found.schema["r"].dataType))
        )
        lists.append(F.collect_set("w").alias("word_ranges"))
    found = found.groupBy("doc_id", "mark").agg(*lists)
    names = found.columns[2:]
    found = found.toDF("own_id", "own_mark", *names)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = F.col(f"row.{id_col}").cast("long").eqNullSafe(F.col("own_id")) & (
        F.hash(F.col(f"row.{text_col}")) == F.col("own_mark")
    )
    return rows.join(found, same, "left").select("row", *names)


def digests(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row after removal of long repeats.

    A byte goes if any string of ``length`` bytes over it also starts anywhere else in
    the table, the same document included; judged on the input. Null texts are empty,
    texts shorter than ``length`` stay whole. Repeated rows are documents of their own,
    so all their long strings go. Null ids stay null; an empty table gives no rows; other
    columns are ignored.
    """

    def run(batches):
        for batch in batches:
            out = []
            for i, text, spans in zip(*(batch.column(c).to_pylist() for c in range(3))):
                raw, cuts = (text or "").encode(), _merge(spans)
                sha, at = hashlib.sha256(), 0
                for low, high in cuts:
                    sha.update(raw[at:low])
                    at = high
                sha.update(raw[at:])
                out.append((i, len(raw), sum(b - a for a, b in cuts), len(cuts), sha.hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            cols = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    rows = with_ranges(docs, id_col, text_col, length=length)
    cells = [F.col(f"row.{id_col}").cast("long").alias("doc_id"), F.col(f"row.{text_col}").alias("text"), "ranges"]
    return rows.select(*cells).mapInArrow(run, schema)


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _passages(raw: bytes, spans) -> list[dict]:
    """Byte ranges of runs of words, with the blanks beside them."""
    at = [m.span() for m in _WORD.finditer(raw)]
    return [
        {"low": at[low - 1][1] if low else 0, "high": at[high][0] if high < len(at) else len(raw)}
        for low, high in _merge(spans)
    ]


def remove(
    docs: DataFrame, length: int = 400, text_col: str = "text", size_col: str = "n_chars", words: int | None = None
) -> DataFrame:
    """``docs`` with long repeats cut out of the text and ``n_chars`` set anew; the same rows and columns.

    A character of which a byte is removed goes as a whole. With ``words``, a word goes as
    well if any string of so many whole words over it also starts anywhere else, whatever
    stands between the words, and with it the blanks beside the run of removed words.
    """

    @F.pandas_udf("string")
    def cut(texts, ranges, word_ranges):
        import pandas as pd

        out = []
        for text, spans, more in zip(texts, ranges, word_ranges):
            if spans is None or text is None:
                out.append(text)
                continue
            raw, at, parts = text.encode(), 0, []
            for low, high in _merge([*spans, *(_passages(raw, list(more)) if more is not None and len(more) else [])]):
                parts.append(raw[at:low].decode(errors="ignore"))
                at = high
            out.append("".join([*parts, raw[at:].decode(errors="ignore")]))
        give_back()
        return pd.Series(out, dtype=object)

    rows = with_ranges(docs, text_col=text_col, length=length, words=words)
    if words is None:
        rows = rows.withColumn("word_ranges", F.slice("ranges", 1, 0))
    rows = rows.withColumn("kept", cut(f"row.{text_col}", "ranges", "word_ranges"))
    new = {text_col: F.col("kept")}
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        new[size_col] = F.when(F.col("ranges").isNull(), F.col(f"row.{size_col}")).otherwise(F.length("kept").cast(kind))
    return rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
