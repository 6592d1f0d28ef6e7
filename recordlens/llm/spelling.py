"""Spelling variants: words one edit apart, by a bit-sliced position index over blocks of the vocabulary.

Two words of which one is the other with one code point inserted, deleted or replaced
share their first or their last half (half of the shorter one), so the vocabulary is dealt
out by halves and only words that share one are compared. For every block of 64 words and
every place and letter the index holds a 64-bit set of the words with that letter there. A
query word runs along its letters for all words of a block at once and keeps the sets of
words without an error, with one replaced letter, and with one more letter (whose places
are shifted by one).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import reach_package, release, stored

_RUN = re.compile("[a-zÀ-ÿ]+")
_KEY = ["side", "short", "half", "ib", "qb"]


def _count(shortest: int, edit: int, limit: int):
    """Words of the rows with how often they occur; a word may come more than once."""

    def flush(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            for i, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not cell.is_valid:
                    continue
                # bytes.lower changes A-Z alone
                runs = Counter(_RUN.findall(bytes(cell.as_buffer()).lower().decode("utf-8", "replace")))
                start = zlib.crc32(f"{i}:".encode())
                for word, n in runs.items():
                    h = zlib.crc32(word.encode(), start) if edit and i is not None else 1
                    if edit and h % edit == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        seen[word] += n
                if len(seen) >= limit:
                    yield flush(seen)
                    seen.clear()
        yield flush(seen)

    return run


def vocabulary(
    docs: DataFrame, shortest: int = 5, rarest: int = 3, edit: int = 0,
    id_col: str = "doc_id", text_col: str = "text", limit: int = 200_000,
) -> DataFrame:
    """``word, n``: runs of Latin letters with ``shortest`` code points that occur ``rarest`` times at least.

    A-Z are lower-cased. With ``edit`` a run whose crc32 ``h`` of ``<id>:<run>`` it divides
    first loses its code point ``h % length``; rows without an id keep their runs. A task
    holds ``limit`` distinct words before it passes their counts on.
    """
    reach_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(_count(shortest, edit, limit), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rarest)


def _units(words: DataFrame, block: int) -> DataFrame:
    """Words by the halves they may share with a variant, large groups as blocks against blocks.

    ``role``: 1 the word is in the index of the unit, 2 it is a query, 3 both. Queries are
    the words of the shorter length of the group.
    """
    m = F.length("word")
    halves = F.inline(F.expr(
        "flatten(transform(array(length(word), length(word) - 1), s -> array("
        "struct('first' as side, s as short, left(word, int(s div 2)) as half),"
        "struct('last' as side, s as short, right(word, int(s div 2)) as half))))"
    ))
    keyed = words.select("word", "n", m.alias("m"), halves)
    sizes = keyed.groupBy("side", "short", "half").agg(F.count("*").alias("size"), F.min("m").alias("least"))
    # a group of one word, or without a word of the shorter length, has no pair
    sizes = sizes.filter("size > 1 and least = short").select(
        "side", "short", "half", F.ceil(F.col("size") / block).cast("int").alias("cuts")
    )
    dealt = keyed.join(sizes, ["side", "short", "half"]).withColumn("own", F.expr("cast(pmod(xxhash64(word), cuts) as int)"))
    return dealt.select("word", "n", "m", "side", "short", "half", F.inline(F.expr(
        "concat("
        "transform(sequence(0, cuts - 1), j -> struct(own as ib, j as qb, if(j = own and m = short, 3, 1) as role)),"
        "if(m = short, transform(filter(sequence(0, cuts - 1), j -> j <> own), j -> struct(j as ib, own as qb, 2 as role)), array()))"
    )))


def _letters(words: list[str], width: int) -> np.ndarray:
    """Code points by word and place; 0 after the end."""
    out = np.zeros((len(words), width), np.int64)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w.encode("utf-32-le"), "<u4")
    return out


def near_pairs(words: list[str], unit: np.ndarray, short: np.ndarray, last: np.ndarray, index: np.ndarray, query: np.ndarray):
    """Rows ``(q, w)`` of one unit that are one edit apart, ``q`` not longer than ``w``.

    ``unit`` numbers the units in ascending order, ``short`` is the length of queries;
    where ``last`` is set the words share their last half, and pairs that share the first
    half, too, are left to the unit of that half. ``index`` and ``query`` mark the rows that
    are in the index of their unit and that are queries.
    """
    rows = np.flatnonzero(index)
    asked = np.flatnonzero(query)
    if not len(rows) or not len(asked):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    width = int(sizes.max()) + 2
    letters = _letters(words, width)
    alphabet, codes = np.unique(letters, return_inverse=True)
    codes = codes.reshape(letters.shape)
    if alphabet[0] != 0:
        raise AssertionError("every row ends before the width")
    # places of the words: units in blocks of 64
    begin = np.flatnonzero(np.append(True, unit[rows][1:] != unit[rows][:-1]))
    inside = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows))))
    new = (inside % 64) == 0
    block, bit = np.cumsum(new) - 1, (inside % 64).astype(np.uint64)
    blocks, members = int(block[-1]) + 1, np.full((int(block[-1]) + 1, 64), -1, np.int64)
    members[block, inside % 64] = rows
    # index: set of the block's words that have a letter at a place (0: the word has ended)
    table = np.zeros(blocks * width * len(alphabet), np.uint64)
    flat = (block[:, None] * width + np.arange(width)) * len(alphabet) + codes[rows]
    np.bitwise_or.at(table, flat.reshape(-1), np.repeat(np.uint64(1) << bit, width))
    # lanes: each query against each block of its unit
    first_block = block[begin]
    many = np.diff(np.append(first_block, blocks))
    which = np.searchsorted(unit[rows][begin], unit[asked])
    which = np.minimum(which, len(begin) - 1)
    there = unit[rows][begin][which] == unit[asked]
    asked, which = asked[there], which[there]
    per = many[which]
    lane_query = np.repeat(asked, per)
    lane_block = np.repeat(first_block[which] - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
    order = np.argsort(-short[lane_query], kind="stable")
    lane_query, lane_block = lane_query[order], lane_block[order]
    ends = short[lane_query]
    base = lane_block * width * len(alphabet)
    none = np.zeros(len(lane_query), np.uint64)
    exact, replaced, longer = ~none, none.copy(), none.copy()
    beside = none.copy()  # words that agree in the first half
    for i in range(int(ends[0]) if len(ends) else 0):
        on = int(np.searchsorted(-ends, -i, side="left"))  # lanes with more than i letters
        letter = codes[lane_query[:on], i]
        at = base[:on] + i * len(alphabet)
        here, after = table[at + letter], table[at + len(alphabet) + letter]
        over = table[at]  # words that end before this place
        z, r, g = exact[:on], replaced[:on], longer[:on]
        replaced[:on] = (r & here) | (z & ~here & ~over)
        longer[:on] = (g | z) & after
        exact[:on] = z & here
        half = np.flatnonzero(ends[:on] // 2 == i + 1)
        beside[half] = exact[half]
    stop = base + ends * len(alphabet)
    ended, one_more = table[stop], ~table[stop] & table[stop + len(alphabet)]
    got = (replaced & ended) | ((longer | exact) & one_more)
    got[last[lane_query]] &= ~beside[last[lane_query]]
    some = np.flatnonzero(got)
    lane, place = np.nonzero((got[some, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
    lane = some[lane]
    return lane_query[lane], members[lane_block[lane], place]


def _compare(limit: int):
    """Per unit and word: how many variants it has there, and the most frequent (ties: smallest) of them."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def judge(cols):
        words, n, short, side, role, unit = cols
        q, w = near_pairs(words, unit, short, side == "last", (role & 1) > 0, (role & 2) > 0)
        # words of one length see each other; a shorter query is told to the longer word, too
        sizes = np.array([len(x) for x in words], np.int64)
        longer = sizes[w] > sizes[q]
        x, y = np.concatenate([q, w[longer]]), np.concatenate([w, q[longer]])
        near = np.bincount(x, minlength=len(words))
        by_rank = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
        rank = np.empty(len(words), np.int64)
        rank[by_rank] = np.arange(len(words))
        best = np.full(len(words), len(words), np.int64)
        np.minimum.at(best, x, rank[y])
        some = np.flatnonzero(near)
        chosen = by_rank[best[some]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in some.tolist()], pa.string()), pa.array(near[some], pa.int64()),
                pa.array(n[chosen], pa.int64()), pa.array([words[i] for i in chosen.tolist()], pa.string()),
            ],
            schema=schema,
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0

        def cut(table: pa.Table, whole: bool):
            """The table up to the start of its last unit, and the rest."""
            keys = [table.column(k).combine_chunks() for k in _KEY]
            change = np.zeros(table.num_rows, bool)
            for k in keys:
                v = k.to_numpy(zero_copy_only=False)
                change[1:] |= v[1:] != v[:-1]
            unit = np.cumsum(change)
            end = table.num_rows if whole else int(np.searchsorted(unit, unit[-1]))
            return end, unit

        def work(table: pa.Table, end: int, unit: np.ndarray):
            col = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)[:end]
            words = table.column("word").to_pylist()[:end]
            n, short, side, role = col("n"), col("short").astype(np.int64), col("side"), col("role")
            lo = 0
            while lo < end:  # slices of whole units of bounded size, fewer words where they are long
                wide = max(24, 2 * int(short[lo]))
                top = min(lo + max(1, limit * 24 // wide), end)
                top = lo + int(np.argmax(np.append(short[lo:top] > wide, True)))
                first_end = int(np.searchsorted(unit, unit[lo], side="right"))
                hi = top if top == end else int(np.searchsorted(unit, unit[top], side="left"))
                hi = min(max(hi, first_end), end)
                part = slice(lo, hi)
                yield judge((words[part], n[part], short[part], side[part], role[part], unit[part]))
                lo = hi

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * limit:
                table = pa.Table.from_batches(held)
                end, unit = cut(table, False)
                yield from work(table, end, unit)
                held = table.slice(end).combine_chunks().to_batches()
                rows = table.num_rows - end
        if rows:
            table = pa.Table.from_batches(held)
            end, unit = cut(table, True)
            yield from work(table, end, unit)

    return run


def variants(words: DataFrame, block: int = 2048, slice_rows: int = 4096) -> DataFrame:
    """``word, n, n_near, best, best_n``: each word with the number of words one edit apart and the most frequent of them.

    ``words`` has ``word`` (distinct, two code points at least) and ``n``. Ties of the most
    frequent go to the smallest word in code-point order; a word without a near word has 0
    and nulls. Groups of more than ``block`` words that share a half are compared block by
    block, so no task holds more than two blocks; nothing is dropped. Words of less than
    two code points and nulls are near nothing.
    """
    reach_package(words.sparkSession)
    usable = words.filter(F.length("word") >= 2)
    units = _units(usable, block)
    sorted_units = units.repartition(*_KEY).sortWithinPartitions(*_KEY)
    told = sorted_units.select("word", "n", *_KEY, "role").mapInArrow(
        _compare(slice_rows), "word string, near long, best_n long, best string"
    )
    near = told.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    )
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("top.best").alias("best"),
        (-F.col("top.less")).alias("best_n"),
    )


def spelling_groups(words: DataFrame, ratio: int = 2, block: int = 2048) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: the usual spelling of each word.

    The form of a word is its most frequent near word (``variants``) if that one occurs at
    least ``ratio`` (2 or more) times as often; the root is where the forms lead. Frequencies
    at least double along forms, so there are no circles and a path has some dozens of steps
    at most; paths are followed by doubling.
    """
    near = variants(words, block)
    held = stored(
        near.select(
            "word", "n", "n_near",
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n"),
        ),
        "spelling",
    )
    paths, old = held.filter("form is not null").select("word", F.col("form").alias("root")), None
    while True:
        step = stored(
            paths.join(paths.select(F.col("word").alias("root"), F.col("root").alias("far")), "root", "left")
            .select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")),
            "paths",
        )
        if old is not None:
            release(old)
        paths, old = step.select("word", "root"), step
        if step.filter("moved").isEmpty():
            break
    return held.join(paths, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
