"""Quality and toxicity by co-training: a text view and a page-metadata view teach each other."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlens.llm.common import give_back, reach_package

_SIGNS = np.zeros(256, np.int64)  # 0 other, 1 upper case, 2 digit, 3 blank, 4 punctuation of prose, 5 any other sign
for _chars, _k in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t\n\r\f\x0b", 3), (".,;:'\"-?()", 4)):
    _SIGNS[[ord(c) for c in _chars]] = _k
_SIGNS[[c for c in range(33, 127) if not chr(c).isalnum() and not _SIGNS[c]]] = 5
_TRIM = ".,;:!?\"'()[]{}%$&*#|"
LANGS, SOURCES = 16, 64
ROWS = 256  # so many texts of a batch stand as Python strings at once


def _hash(text: str | None, size: int) -> int:
    return sum((i + 1) * b for i, b in enumerate((text or "").encode())) % size


def text_features(text: str | None, place: dict[str, int]) -> np.ndarray:
    """Whether each marked word (or "abcd*", a word's begin) stands in the text, then shares of signs and repeats."""
    text = text or ""
    x = np.zeros(len(place) + 8, np.float32)
    tokens = text.lower().split()
    distinct = set(tokens)
    bare = {t if t.isalpha() else t.strip(_TRIM) for t in distinct}
    begins = {w[:4] + "*" for w in bare} | {w[:5] + "*" for w in bare}
    for w in place.keys() & (bare | begins):
        x[place[w]] = 1.0
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(1, len(raw))
    kinds = np.bincount(_SIGNS[raw], minlength=6) / n
    lines = text.split("\n")
    x[len(place) :] = (
        *(10 * kinds[[1, 2, 3, 4, 5]]),
        1 - len(set(lines)) / len(lines),
        min(1.0, 5 * text.count("!") / n),
        1 - len(distinct) / max(1, len(tokens)),
    )
    return x


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    x = np.zeros(LANGS + SOURCES + 2, np.float32)
    x[_hash(lang, LANGS)] = 1.0
    x[LANGS + _hash(source, SOURCES)] = 1.0
    size = np.log1p(max(0.0, float(n_chars or 0)))
    x[-2:] = size / 10, (size / 10) ** 2
    return x


def _cells(*columns: pa.Array) -> Iterator[tuple]:
    """Rows of Arrow columns as Python values, a few at a time."""
    for at in range(0, len(columns[0]), ROWS):
        yield from zip(*(c.slice(at, ROWS).to_pylist() for c in columns))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + shrink * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return w


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1].astype(np.float32) + np.float32(w[-1])


def _odds(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    """Both views, their calibration and the combination; ``None`` weights keep everything."""

    place: dict[str, int] = field(default_factory=dict)
    text: np.ndarray | None = None
    meta: np.ndarray | None = None
    text_scale: np.ndarray | None = None
    meta_scale: np.ndarray | None = None
    both: np.ndarray | None = None

    def views(self, x_text: np.ndarray, x_meta: np.ndarray):
        """Calibrated logits of the views."""
        a = _logit(x_text, self.text) * self.text_scale[0] + self.text_scale[1]
        b = _logit(x_meta, self.meta) * self.meta_scale[0] + self.meta_scale[1]
        return a, b

    def score(self, texts, langs, sources, sizes):
        """Probabilities that a document is bad: by text, by metadata, by both; Arrow columns of a batch."""
        if self.text is None or not len(texts):
            return (np.zeros(len(texts)),) * 3
        x = np.empty((len(texts), len(self.place) + 8), np.float32)
        m = np.empty((len(texts), LANGS + SOURCES + 2), np.float32)
        for i, (text, *meta) in enumerate(_cells(texts, langs, sources, sizes)):
            x[i], m[i] = text_features(text, self.place), meta_features(*meta)
        a, b = self.views(x, m)
        return _odds(a), _odds(b), _odds(_logit(np.stack([a, b], 1), self.both))


def marked_words(rows: DataFrame, most: int, least_docs: int = 5, z: float = 2.3, odds: float = 2.0) -> list[str]:
    """Words and begins of words that stand far more often in bad documents of the sample than in good ones, or the reverse."""
    words = F.array_distinct(F.transform(
        F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), lambda w: F.btrim(w, F.lit(_TRIM))
    ))
    begin = lambda n: F.transform("w", lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))
    each = rows.select("bad", words.alias("w")).select(
        "bad", F.explode(F.array_distinct(F.concat("w", begin(4), begin(5)))).alias("word")
    ).filter("word not in ('', '*')")
    total = rows.agg(F.count("*").alias("n"), F.sum("bad").alias("b")).first()
    n_bad, n_good = total["b"] or 0, total["n"] - (total["b"] or 0)
    counts = each.groupBy("word").agg(F.count("*").alias("n"), F.sum("bad").alias("b")).filter(F.col("n") >= least_docs)
    in_bad, in_good = F.col("b") + 0.5, F.col("n") - F.col("b") + 0.5
    log_odds = F.log(in_bad / (n_bad - F.col("b") + 0.5)) - F.log(in_good / (n_good - F.col("n") + F.col("b") + 0.5))
    strength = F.abs(log_odds) / F.sqrt(1 / in_bad + 1 / in_good)
    best = counts.filter((F.abs(log_odds) >= odds) & (strength >= z)).select("word", strength.alias("z"))
    return [r["word"] for r in best.orderBy(F.desc("z"), "word").limit(most).collect()]  # at most ``most`` words


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, size_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"), F.col(size_col).cast("long").alias("n_chars"),
    )


def _gather(rows: DataFrame, place: dict[str, int], labels: list[str]):
    """Features of a bounded set of rows as arrays on the driver."""

    def run(batches):
        for batch in batches:
            x, m = [], []
            for text, *meta in _cells(*batch.columns[:4]):
                x.append(text_features(text, place).tobytes())
                m.append(meta_features(*meta).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(m, pa.binary()), *batch.columns[4:]], names=["x", "m", *labels])
        batch = x = m = None
        give_back()

    schema = "x binary, m binary, " + ", ".join(f"{c} double" for c in labels)
    cells = rows.select("text", "lang", "source", "n_chars", *(F.col(c).cast("double") for c in labels))
    got = cells.mapInArrow(run, schema).collect()
    stack = lambda c, n: np.array([np.frombuffer(r[c], np.float32) for r in got]).reshape(len(got), n)
    return (
        stack("x", len(place) + 8), stack("m", LANGS + SOURCES + 2),
        *(np.array([r[c] for r in got], float) for c in labels),
    )


def _confident(rows: DataFrame, model: Model, most: int, sure: float) -> DataFrame:
    """``doc_id, view, guess``: per view and class at most ``most`` documents that the view is surest of."""

    def run(batches):
        for batch in batches:
            a, b, _ = model.score(*(batch.column(c) for c in ("text", "lang", "source", "n_chars")))
            ids = batch.column("doc_id").to_numpy()
            for view, p in (("text", a), ("meta", b)):
                for guess, q in ((1, p), (0, 1 - p)):
                    at = np.flatnonzero(q >= sure)
                    at = at[np.lexsort((ids[at], -q[at]))[:most]]  # ties by id, as below: batches do not matter
                    cells = [pa.array(ids[at]), pa.array([view] * len(at), pa.string()), pa.array([guess] * len(at), pa.int32()), pa.array(q[at], pa.float64())]
                    yield pa.RecordBatch.from_arrays(cells, names=["doc_id", "view", "guess", "q"])
        batch = a = b = p = q = None
        give_back()

    found = rows.filter("doc_id is not null").mapInArrow(run, "doc_id long, view string, guess int, q double")
    order = Window.partitionBy("view", "guess").orderBy(F.desc("q"), "doc_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 12_000,
    max_words: int = 256,
    rounds: int = 2,
    exchanged: int = 300,
    sure: float = 0.98,
    ridge: float = 1.0,
    columns: tuple[str, ...] = ("doc_id", "text", "lang", "source", "n_chars"),
) -> Model:
    """Co-training over a bounded sample of labelled rows and all unlabelled documents.

    ``max_labelled`` rows (chosen by a hash of the id) are used for fitting; a third of
    them is held out for calibration and combination. In each round both views score
    every document; of those that a view gives at least ``sure`` probability, the
    ``exchanged`` surest of each class join the other view's training rows. A document
    is bad if its quality label is 0 or its toxic label 1. The driver holds
    ``max_labelled + 4 * rounds * exchanged`` rows of ``max_words`` numbers at most.

    Null labels are left out; of repeated labels of an id the worst counts; ids
    without a document are left out. With no label of either class nothing is rejected.
    """
    reach_package(docs.sparkSession)
    rows = _rows(docs, *columns)
    known = (
        labels.filter("doc_id is not null and quality is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
        .withColumn("held", (F.abs(F.xxhash64("doc_id", F.lit(1)) % 3) == 0).cast("int"))
    )
    spark = docs.sparkSession
    known = spark.createDataFrame([tuple(r) for r in known.collect()], "doc_id long, bad int, held int")
    sample = rows.join(F.broadcast(known), "doc_id")  # at most ``max_labelled`` short rows
    model = Model()
    words = marked_words(sample.filter("held = 0"), max_words)
    place = {w: i for i, w in enumerate(words)}
    x, m, bad, held = _gather(sample, place, ["bad", "held"])
    use, test = held == 0, held == 1
    if len(set(bad[use])) < 2 or len(set(bad[test])) < 2:
        return model
    model.place = place
    own = {"text": (x[use], bad[use], np.ones(use.sum())), "meta": (m[use], bad[use], np.ones(use.sum()))}
    pool = rows.join(F.broadcast(known.select("doc_id")), "doc_id", "left_anti")
    for turn in range(rounds + 1):
        model.text, model.meta = fit(*own["text"], ridge), fit(*own["meta"], ridge)
        even = np.ones(test.sum())
        model.text_scale = fit(_logit(x[test], model.text)[:, None], bad[test], even, 1e-2)
        model.meta_scale = fit(_logit(m[test], model.meta)[:, None], bad[test], even, 1e-2)
        a, b = model.views(x[test], m[test])
        model.both = fit(np.stack([a, b], 1), bad[test], even, 10.0)
        if turn == rounds:
            return model
        found = _confident(pool, model, exchanged, sure).select(
            "doc_id", (F.col("view") == "text").cast("int").alias("by_text"), "guess"
        )
        chosen = spark.createDataFrame([tuple(r) for r in found.collect()], "doc_id long, by_text int, guess int")
        px, pm, by_text, guess = _gather(rows.join(F.broadcast(chosen), "doc_id"), place, ["by_text", "guess"])
        for view, more, given in (("text", px, by_text == 0), ("meta", pm, by_text == 1)):
            old = own[view]
            own[view] = (
                np.vstack([old[0], more[given]]), np.append(old[1], guess[given]),
                np.append(old[2], np.full(given.sum(), 0.5)),
            )
    return model


def verdict(model: Model, threshold: float = 0.5):
    """A function of text, lang, source and n_chars: struct of the three probabilities and ``keep``."""

    @F.arrow_udf("text double, meta double, bad double, keep boolean")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            a, b, both = (np.asarray(p, np.float64) for p in model.score(*columns))
            yield pa.StructArray.from_arrays([pa.array(a), pa.array(b), pa.array(both), pa.array(both < threshold)], names=["text", "meta", "bad", "keep"])
        columns = a = b = both = None
        give_back()

    return judge


def classify(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``doc_id, p_text, p_meta, p_bad, keep`` of every row.

    Null or empty texts have no words; null metadata counts as its own value; null ids
    stay null; repeated rows are scored alike; an empty table gives no rows; other
    columns are ignored.
    """
    reach_package(docs.sparkSession)
    judged = _rows(docs, "doc_id", "text", "lang", "source", "n_chars").select(
        "doc_id", verdict(model, threshold)("text", "lang", "source", "n_chars").alias("v")
    )
    return judged.select("doc_id", F.col("v.text").alias("p_text"), F.col("v.meta").alias("p_meta"), F.col("v.bad").alias("p_bad"), "v.keep")
