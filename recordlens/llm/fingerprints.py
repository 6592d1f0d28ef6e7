"""Fingerprints by consistent weighted sampling: equal samples estimate generalised Jaccard similarity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\x0b"
_BITS = 25
BROADCAST_RANGES = 1_000_000  # rows of two longs each: 16 MB


def _uniform(bits: Column) -> Column:
    """A number inside (0, 1) from ``_BITS`` bits."""
    return (F.shiftrightunsigned(bits, 0).bitwiseAND((1 << _BITS) - 1).cast("double") + 0.5) / float(1 << _BITS)


def _gammas(term: Column, k: int) -> tuple[Column, Column, Column]:
    """For a term and sample: r ~ Gamma(2, 1), ln of c ~ Gamma(2, 1), beta ~ U(0, 1); the same everywhere."""
    one, two = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.ln(_uniform(one) * _uniform(F.shiftrightunsigned(one, _BITS)))
    c = F.ln(-F.ln(_uniform(two) * _uniform(F.shiftrightunsigned(two, _BITS))))
    beta = _uniform(F.shiftrightunsigned(one.bitwiseXOR(F.shiftleft(two, 11)), 64 - _BITS))
    return r, c, beta


def _value(weight_ln: Column, r: Column, c: Column, beta: Column) -> Column:
    """ln a of a weighted term; the term with the least value is the sample."""
    return c - r * (F.floor(weight_ln / r + beta) - beta + 1.0)


def signature(terms: DataFrame, keys: list[str], samples: int) -> DataFrame:
    """``keys, print`` per group: the fingerprint of its weighted terms.

    ``terms`` has one row per group and term (``term`` long, ``weight`` > 0). The least
    value stands for the sampled term and its level, as both follow from it, so plain
    minima are enough; they combine before any shuffle. Each minimum holds its whole
    expression: so Spark compiles them into methods small enough for the JVM's compiler.
    """
    least = [F.min(_value(F.ln("weight"), *_gammas(F.col("term"), k))).alias(f"m{k}") for k in range(samples)]
    text = lambda c: F.lpad(F.lower(F.hex(F.xxhash64(c).bitwiseAND(0xFFFFFFFF))), 8, "0")
    return terms.groupBy(*keys).agg(*least).select(
        *keys, F.concat(*(text(F.col(f"m{k}")) for k in range(samples))).alias("print")
    )


def counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, term, weight``: distinct words of each row's array ``words`` and their counts.

    Counted inside the row, by the ends of runs of its sorted hashes: no map of all
    terms of a task, no shuffle.
    """
    hashed = rows.select(*keys, F.array_sort(F.transform("words", lambda w: F.xxhash64(w))).alias("h"))
    ends = hashed.select(*keys, "h", F.expr(
        "filter(sequence(1, size(h)), i -> i = size(h) or h[i - 1] <> h[least(i, size(h) - 1)])"
    ).alias("ends"))
    runs = "transform(ends, (e, j) -> struct(h[e - 1] as term, e - if(j = 0, 0, ends[greatest(j - 1, 0)]) as weight))"
    return ends.select(*keys, F.inline(F.expr(runs)))


def likeness(a: Column, b: Column, samples: int) -> Column:
    """Share of equal samples of two fingerprints."""
    same = [F.when(a.substr(8 * k + 1, 8) == b.substr(8 * k + 1, 8), 1).otherwise(0) for k in range(samples)]
    return reduce(lambda x, y: x + y, same) / F.lit(float(samples))


def in_order(docs: DataFrame) -> DataFrame:
    """``part, rank, real, doc_id, text, next_text``: each document with the text of the next by id.

    Ids are cut into ranges of a few thousand rows (``part``); ranges are halved
    where ids crowd. Each range also holds the first document of the next range
    as a last row that is not ``real``; the last range holds the first of all. So no
    order over all rows is needed; only one short row per range is sorted in one task.
    """
    ids = docs.select("doc_id")
    n, lo, hi = ids.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    lo, hi = lo or 0, hi or 0
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    want = min(max(n // parts, 64), 20_000)
    width = max(1, (hi - lo + 1) * want // max(n, 1))
    place = lambda w: F.coalesce(F.floor((F.col("doc_id") - lo) / F.lit(w)), F.lit(-1)).cast("long")
    sizes = lambda w: ids.groupBy(place(w).alias("p")).count().agg(F.max("count"), F.count("*")).first()
    most, ranges = sizes(width)
    while width > 1 and (most or 0) > 4 * want:
        width = max(1, width // 8)
        most, ranges = sizes(width)
    rows = docs.select(place(width).alias("part"), F.lit(True).alias("real"), "doc_id", "text")
    heads = ids.groupBy(place(width).alias("part")).agg(F.min("doc_id").alias("doc_id"))
    every = Window.orderBy("part")
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = heads.select(
        F.coalesce(F.lag("part").over(every), F.last("part").over(first)).alias("part"),
        F.col("doc_id").alias("head_id"),
    )
    if ranges <= BROADCAST_RANGES:
        before = F.broadcast(before)
    texts = (
        docs.join(before, docs["doc_id"].eqNullSafe(before["head_id"]))
        .groupBy("part", "doc_id").agg(F.min("text").alias("text"))
        .select("part", F.lit(False).alias("real"), "doc_id", "text")
    )
    order = Window.partitionBy("part").orderBy(F.desc("real"), F.asc_nulls_first("doc_id"), "text")
    return rows.unionAll(texts).select(
        "part", F.row_number().over(order).alias("rank"), "real", "doc_id", "text",
        F.lead("text").over(order).alias("next_text"),
    )


def fingerprints(
    docs: DataFrame, samples: int = 32, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and the next text.

    The edited text has its last floor(n_chars / 2) code points replaced by as many
    from the start of the next document (ascending ids; after the last the first).
    Terms are words between blanks, weighted by their count. ``fingerprint`` is
    ``samples`` times 8 hex digits.

    A null text is empty; an empty text has the one term ''. Null ids come first;
    equal ids are ordered by text; repeated rows are all returned; a single document
    is its own next one; an empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = in_order(docs).select(
        "part", "rank", "real", "doc_id", "text", F.length("text").cast("long").alias("n_chars"),
        F.when(F.col("real"), F.concat(
            F.expr("left(text, length(text) - int(length(text) div 2))"),
            F.expr("left(next_text, int(length(text) div 2))"),
        )).alias("edited"),
    )
    both = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")),
    )
    words = rows.select("part", "rank", F.inline(both)).filter("t is not null").select(
        "part", "rank", "side", F.split(F.btrim("t", F.lit(BLANKS)), "[ \\t\\n\\r\\f\\x0b]+").alias("words")
    )
    terms = counted(words, ["part", "rank", "side"])
    signs = signature(terms, ["part", "rank", "side"], samples)
    # the sides of a document, then the next document
    order = Window.partitionBy("part").orderBy("rank", "side")
    signs = signs.select(
        "part", "rank", "side", F.col("print").alias("f_plain"),
        F.lead("print", 1).over(order).alias("f_changed"), F.lead("print", 2).over(order).alias("f_next"),
    ).filter("side = 0").drop("side")
    base = rows.filter("real").select("part", "rank", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    return base.join(signs, ["part", "rank"]).select(
        "doc_id", "n_chars", "edited_sha256",
        F.col("f_plain").alias("fingerprint"), F.col("f_changed").alias("edited_fingerprint"),
        likeness(F.col("f_plain"), F.col("f_changed"), samples).alias("near_edited"),
        likeness(F.col("f_plain"), F.col("f_next"), samples).alias("near_next"),
    )
