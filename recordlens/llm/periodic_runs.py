"""Periodic runs of words inside documents, by seeds of equal word k-grams that are extended along a diagonal.

A run of period ``q`` and length ``L`` is ``L - q`` words that equal the word ``q`` places
on, so it holds equal k-grams at a distance of ``q`` for every ``k <= L - q`` (the
guaranteed overlap). Distances are cut into levels, each with the least overlap of its
distances as ``k``; ``k`` is never below a distance of its level. An equal k-gram that long
cannot recur inside the run before ``q`` places, as the run would have a smaller period, so
the next occurrence of a k-gram is the only one that has to be paired with it: pairs number
at most the words of a document, however often a word repeats.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import reach_package

WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit name of each pair of names."""
    h = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(31)))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _stretch(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, in the direction of ``step``, equal the word ``lag`` places later."""
    room = len(words) - lag - at if step > 0 else at + 1
    done, size = 0, 64
    while done < room:
        size = min(size, room - done)
        low = at + done if step > 0 else at - done - size + 1
        differ = np.flatnonzero(words[low : low + size] != words[low + lag : low + lag + size])
        if len(differ):
            return done + int(differ[0] if step > 0 else size - 1 - differ[-1])
        done, size = done + size, size * 4
    return done


def find_runs(words: np.ndarray, least: int = 6, power: int = 4) -> list[tuple[int, int, int]]:
    """All ``(start, length, period)`` of maximal runs, by start, then period.

    A run is a stretch with smallest period ``q`` and at least ``max(least, power * q)``
    words that no neighbouring word extends; ``power`` is 2 or more. Equal words have equal
    numbers in ``words``.
    """
    n, found = len(words), []
    overlap = lambda q: max(least, power * q) - q
    k, above = min(overlap(q) for q in range(1, least + 1)), 0
    grams, width = words.astype(np.uint64), 1
    while power * (above + 1) <= n and k <= n:
        while 2 * width <= k:
            grams = _pairs(grams[: len(grams) - width], grams[width:])
            width *= 2
        # two overlapping grams cover k words
        index = _pairs(grams[: n - k + 1], grams[k - width : n - width + 1])
        order = np.argsort(index, kind="stable")
        same = np.flatnonzero(index[order[1:]] == index[order[:-1]])
        if not len(same):
            break  # no k-gram occurs twice, nor does a longer one
        at, lag = order[same], order[same + 1] - order[same]
        fits = (lag > above) & (lag <= k)
        at, lag = at[fits], lag[fits]
        by_lag = np.lexsort((at, lag))
        at, lag = at[by_lag], lag[by_lag]
        # a seed right after a seed of its lag lies in what that one covers
        fresh = np.ones(len(at), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        covered: dict[int, int] = {}
        for i, q in zip(at[fresh].tolist(), lag[fresh].tolist()):
            if i < covered.get(q, 0):
                continue
            ahead = _stretch(words, i, q, 1)
            start = i - (_stretch(words, i - 1, q, -1) if i else 0)
            covered[q] = i + max(ahead, 1)
            length = i + ahead - start + q
            if ahead >= k and length >= max(least, power * q):
                found.append((start, length, q))
        above, k = k, overlap(k + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def _search(least: int, power: int):
    def run(batches):
        for batch in batches:
            runs, kept, counts = [], [], []
            for cell in batch.column(1):
                words = _WORD.findall(cell.as_py() or "")
                numbers: dict[str, int] = {}
                got = find_runs(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), least, power)
                if got:
                    drop = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in got:
                        drop[start + period] += 1
                        drop[start + length] -= 1
                    words = [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]
                counts.append(len(words))
                runs.append([{"start": s, "length": m, "period": q} for s, m, q in got])
                kept.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(runs, pa.list_(_RUN)), pa.array(kept, pa.string()), pa.array(counts, pa.int64())],
                names=["doc_id", "runs", "collapsed", "n_kept"],
            )

    return run


def periodic_runs(
    docs: DataFrame, least: int = 6, power: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, runs, collapsed, n_kept`` of every row, in one pass without a shuffle.

    ``runs`` are the maximal runs of words (see ``find_runs``) by start, then period;
    ``collapsed`` is the text without the repetitions: the words that no run contains after
    its first period, joined by one space; ``n_kept`` counts them. Words are runs of
    characters other than blanks. Null, empty and blank texts have no runs and an empty
    ``collapsed``. Rows with equal ids or without an id are judged one by one; an empty table
    gives no rows; other columns are ignored.
    """
    reach_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _search(least, power),
        "doc_id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string, n_kept long",
    )


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the rows, a tenth of the texts made periodic from some word on.

    With ``h`` the crc32 of the decimal id and ``g = h div 10``: where 10 divides ``h``, word
    ``i >= a`` becomes word ``a + (i - a) % p``, for ``a = g % n`` and
    ``p = 1 + (n - a) div (3 + g % 8)``. Rows without an id or without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        block = F.slice(w, a + 1, p)
        again = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", F.slice(w, F.lit(1), a), F.slice(again, F.lit(1), n - a)))

    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    # the list is made once and named by the lambda
    edited = F.transform(F.array(words), periodic)[0]
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(edited, "text")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of runs and collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.l div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
