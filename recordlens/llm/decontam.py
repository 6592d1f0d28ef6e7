"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
SHINGLE = 5
BROADCAST_SHINGLES = 500_000  # rows of a few longs each: some tens of MB


def words(text: Column) -> Column:
    """Words between blanks, A-Z lower-cased; none for a null or blank text."""
    bare = F.btrim(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t\\n\\x0b\\f\\r]+"))


def _shingles(w: str) -> Column:
    """Structs of the words at each position and the four after it."""
    return F.arrays_zip(*(F.expr(f"slice({w}, {k + 1}, size({w}))").alias(f"w{k}") for k in range(SHINGLE)))


def hashed(rows: DataFrame, keys: list[str], w: str = "w") -> DataFrame:
    """``keys, pos, hash`` of every run of five words; a shorter sequence is one run as a whole."""
    parts = rows.select(*keys, F.posexplode(_shingles(w)).alias("pos", "s"))
    return parts.filter(F.col(f"s.w{SHINGLE - 1}").isNotNull() | (F.col("pos") == 0)).select(
        *keys, "pos", F.xxhash64(*(F.col(f"s.w{k}") for k in range(SHINGLE))).alias("hash")
    )


def simhash(rows: DataFrame, keys: list[str], w: str = "w") -> DataFrame:
    """``keys, print``: bit b is set if most words of the group have bit b in their hash."""
    bits = rows.select(*keys, F.explode(w).alias("word")).select(*keys, F.xxhash64("word").alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(1)).alias(f"b{b}") for b in range(64)]
    voted = bits.groupBy(*keys).agg(F.count("*").alias("n_bits"), *sums)
    set_bits = [F.when(2 * F.col(f"b{b}") > F.col("n_bits"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")) for b in range(64)]
    return voted.select(*keys, reduce(lambda x, y: x.bitwiseOR(y), set_bits).alias("print"))


def blocks(prints: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint once per block of bits; within ``radius`` bits, one of radius + 1 blocks is equal."""
    count = radius + 1
    cuts = [64 * k // count for k in range(count + 1)]
    parts = [
        F.struct(
            F.lit(k).alias("block"),
            F.shiftrightunsigned("print", a).bitwiseAND((1 << (b - a)) - 1 if b - a < 64 else -1).alias("bits"),
        )
        for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]
    return prints.select("*", F.inline(F.array(*parts)))


def similarity(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """``keys, similarity``: weighted Jaccard of the five-word shingles of two word sequences, weights are counts."""
    def runs(w):
        n = f"greatest(size({w}) - {SHINGLE - 1}, 1)"
        return F.expr(f"transform(sequence(1, {n}), i -> array_join(slice({w}, i, {SHINGLE}), ' '))")

    sides = F.array(
        F.struct(F.lit(1).alias("in_a"), F.lit(0).alias("in_b"), runs(a).alias("s")),
        F.struct(F.lit(0).alias("in_a"), F.lit(1).alias("in_b"), runs(b).alias("s")),
    )
    counts = (
        pairs.select(*keys, F.inline(sides)).select(*keys, "in_a", "in_b", F.explode("s").alias("s"))
        .groupBy(*keys, "s").agg(F.sum("in_a").alias("na"), F.sum("in_b").alias("nb"))
    )
    return counts.groupBy(*keys).agg(
        (F.sum(F.least("na", "nb")) / F.sum(F.greatest("na", "nb"))).alias("similarity")
    )


def passages(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    radius: int = 15,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words``: the best window of each document and item.

    A window has as many words as an item and may start anywhere. Only windows that hold
    enough runs of five words of the items of their size, in whatever order, can be
    similar, and all of those are built: runs come from a join of all runs of five words
    of all documents with those of the items. Equal
    windows are then one row. Each gets a SimHash of its words; blocks of bits find all
    items of the window's size within ``radius`` bits; the weighted shingle similarity
    of window and item decides. The items' runs are counted: up to
    ``BROADCAST_SHINGLES`` they are broadcast, beyond that joined by a shuffle.

    Documents with fewer than five words are one run, and match an item of the same
    words only. Windows are cut at the ends of a document. Null or blank texts and items
    match nothing; null ids stay null; rows with the same id and text give one result;
    empty tables give no rows; other columns are ignored.
    """
    items = (
        benchmark.select(F.col(item_col).cast("long").alias("item_id"), words(F.col(text_col)).alias("w"))
        .filter("size(w) > 0").withColumn("n", F.size("w"))
    )
    runs = hashed(items, ["n"]).select("hash", "n").distinct()
    few = runs.count() <= BROADCAST_SHINGLES
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col), F.lit(1)).alias("mark"),
        F.col(text_col).alias("text"),
    )
    keys = ["doc_id", "mark"]
    hits = hashed(texts.select(*keys, words(F.col("text")).alias("w")), keys).join(F.broadcast(runs) if few else runs, "hash")
    # A window of ``a`` runs and an item of ``m`` share at least t / (1 + t) * (a + m) runs: 2 * t / (1 + t) * m
    # for whole windows, t * m for those cut at an end of the document.
    at = hits.groupBy(*keys, "n").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    at = at.withColumn("m", F.greatest(F.col("n") - (SHINGLE - 1), F.lit(1)))
    shares = F.array(*(
        F.struct(F.lit(cut).alias("cut"), F.greatest(F.ceil(F.lit(share) * F.col("m") - 1e-9), F.lit(1)).cast("int").alias("need"))
        for cut, share in ((False, 2 * threshold / (1 + threshold)), (True, threshold))
    ))
    # the windows that hold both the k-th run and the one ``need - 1`` runs after it
    spans = at.select(*keys, "n", "m", "at", F.inline(shares)).filter("need <= size(at)").select(
        *keys, "n", "cut", F.explode(F.expr(
            "filter(transform(slice(at, 1, size(at) - need + 1), (low, k) -> "
            "named_struct('low', at[k + need - 1] - m + 1, 'high', low)), x -> x.low <= x.high)"
        )).alias("x")
    )
    by_doc = spans.groupBy(*keys).agg(F.collect_set(F.struct("x.low", "x.high", "n", "cut")).alias("places"))
    by_doc = by_doc.toDF("hit_id", "hit_mark", "places")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("mark") == F.col("hit_mark"))
    # texts are joined as they are and cut into words after: that shuffles fewer bytes
    found = texts.join(by_doc, same).select("doc_id", "places", words(F.col("text")).alias("w"))
    found = found.select("doc_id", "w", F.inline("places")).select(
        "doc_id", "w", "n", "cut", F.explode(F.expr("sequence(low, high)")).alias("start")
    ).filter("not cut or start < 0 or start + n > size(w)")
    found = found.select(
        "doc_id", "n", F.greatest("start", F.lit(0)).alias("start"),
        F.expr("slice(w, greatest(start, 0) + 1, n + least(start, 0))").alias("v"),
    ).withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(7), "v")})
    window = ["n", "h1", "h2"]
    windows = found.groupBy(*window).agg(F.first("v").alias("v"))
    left = blocks(simhash(windows.withColumnRenamed("v", "w"), window), radius)
    right = blocks(simhash(items, ["item_id", "n"]), radius).withColumnRenamed("print", "item_print")
    near = (
        left.join(right, ["n", "block", "bits"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select(*window, "item_id").distinct()
    )
    pairs = near.join(windows, window).join(items.select("item_id", F.col("n"), "w"), ["item_id", "n"])
    alike = similarity(pairs, [*window, "item_id"], "v", "w").filter(F.col("similarity") >= threshold)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n"))
    return (
        found.select("doc_id", "start", *window).join(alike, window)
        .groupBy("doc_id", "item_id").agg(best.alias("m"))
        .select("doc_id", "item_id", "m.similarity", (-F.col("m.s")).alias("start_word"), F.col("m.n").alias("n_words"))
    )


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), items AS (
  SELECT item_id, len(w) AS n, w FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark)
), doc_runs AS (
  SELECT doc_id, pos, w[pos + 1 : pos + 5] AS s FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS pos FROM texts WHERE len(w) > 0)
), item_runs AS (
  SELECT item_id, n, pos, w[pos + 1 : pos + 5] AS s FROM (SELECT item_id, n, w, unnest(range(greatest(n - 4, 1))) AS pos FROM items)
), windows AS (
  SELECT DISTINCT doc_id, unnest(range(pos - greatest(n - 4, 1) + 1, pos + 1)) AS start, n
  FROM (SELECT DISTINCT d.doc_id, d.pos, i.n FROM doc_runs d JOIN item_runs i USING (s))
), window_counts AS (
  SELECT v.doc_id, v.start, v.n, d.s, count(*) AS c FROM windows v JOIN doc_runs d
    ON d.doc_id = v.doc_id AND d.pos >= v.start AND d.pos <= greatest(v.start + v.n - 5, 0) GROUP BY ALL
), item_counts AS (SELECT item_id, n, s, count(*) AS c FROM item_runs GROUP BY ALL),
window_sums AS (SELECT doc_id, start, n, sum(c) AS total FROM window_counts GROUP BY ALL),
item_sums AS (SELECT item_id, sum(c) AS total FROM item_counts GROUP BY ALL),
common AS (
  SELECT w.doc_id, w.start, w.n, i.item_id, sum(least(w.c, i.c)) AS c
  FROM window_counts w JOIN item_counts i USING (n, s) GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, start, n, c / (a.total + b.total - c) AS similarity
  FROM common JOIN window_sums a USING (doc_id, start, n) JOIN item_sums b USING (item_id)
)
SELECT doc_id, item_id, max(similarity)::DOUBLE AS similarity,
  greatest(arg_max(start, struct_pack(a := similarity, b := -start)), 0)::INTEGER AS start_word,
  any_value(n)::INTEGER AS n_words
FROM scored WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""
