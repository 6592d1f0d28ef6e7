"""Near duplicates by an LSH forest of MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlens.llm.common import components, give_back, reach_package, release, stored
from recordlens.llm.suffix_dedup import _powers

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word runs of each text; a shorter text is one run."""
    joined = b" ".join(texts) + b" "
    raw = _LOWER[np.frombuffer(joined, np.uint8)]
    gap = _BLANK[raw]
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    first = [] if gap[0] else [0]
    cuts = np.concatenate([np.array(first, np.int64), edge])
    low, high = cuts[0::2], cuts[1::2]
    low = low[: len(high)]
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    word = _mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))
    bounds = np.concatenate([[0], np.searchsorted(low, ends_at)])
    run = word.copy()
    for j in range(1, min(words, len(word))):
        run[: len(word) - j] = _mix(run[: len(word) - j] * np.uint64(0x9E3779B97F4A7C15) + word[j:])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        elif b > a:
            h = word[a : a + 1]
            for j in range(a + 1, b):
                h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + word[j : j + 1])
            out.append(_mix(h + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Least 32-bit hash of the set under each seed (odd multipliers)."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024, None] * seeds[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def parity(shingles: np.ndarray) -> np.ndarray:
    """Whether each residue of the hashes stands for an odd number of the set's shingles, 64 bits a number.

    The modulus is the power of two from twice the set's size on, at least 512. The two
    halves combine by XOR to the parities for half the modulus.
    """
    bits = max(512, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else 512
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _sign(words: int, trees: int, seed: int):
    """Set size, a 128-bit name of the set, the forest labels (8 values of 16 bits per tree) and the parities."""

    def run(batches):
        rng = np.random.default_rng(seed)
        seeds = rng.integers(0, 1 << 63, 8 * trees, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for ids, sets in _sets(batches, words):
            names = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            labels = [(signature(s, seeds) >> np.uint32(16)).astype(">u2").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(names), pa.array(labels),
                    pa.array([parity(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "name", "labels", "parity"],
            )

    return run


def _sets(batches, words: int, rows: int = 256, size: int = 1_000_000):
    """Ids and shingle sets of texts in blocks of bounded size."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            texts, used, first = [], 0, at
            while at < batch.num_rows and len(texts) < rows and (used < size or not texts):
                cell = batch.column(1)[at]
                texts.append(bytes(cell.as_buffer()) if cell.is_valid else b"")
                used += len(texts[-1])
                at += 1
            yield batch.column(0)[first:at].to_pylist(), shingle_sets(texts, words)
    batch = cell = texts = None
    give_back()


def _neighbours(width: int):
    """Pairs of one tree's sorted order that are at most ``width`` rows apart and share the first four values.

    A pair of a node with itself has in ``crowd`` how many rows have its whole label, if
    there are three or more.
    """

    def run(batches):
        tail = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if tail is not None:
                cols = [np.concatenate([t, c]) for t, c in zip(tail, cols)]
            old = 0 if tail is None else len(tail[0])
            tree, label, deep, node, n = cols
            run = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (label[1:] != label[:-1]) | (deep[1:] != deep[:-1])]))
            size = np.repeat(np.diff(np.append(run, len(tree))), np.diff(np.append(run, len(tree))))
            many = np.arange(len(tree))[old:][size[old:] >= 3]
            a, b = [node[many]], [node[many]]
            for w in range(1, width + 1):
                i = np.arange(max(w, old), len(tree))
                j = i - w
                near = (label[i] == label[j]) & (tree[i] == tree[j]) & (node[i] != node[j])
                near &= 5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j])
                a.append(np.minimum(node[i], node[j])[near])
                b.append(np.maximum(node[i], node[j])[near])
            tail = [c[-width:] for c in cols]
            a, b = np.concatenate(a), np.concatenate(b)
            crowd = np.zeros(len(a), np.int64)
            crowd[: len(many)] = size[many]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(crowd)], names=["a", "b", "crowd"])

    return run


def forest_pairs(nodes: DataFrame, trees: int, width: int, partitions: int) -> DataFrame:
    """``a, b, votes, crowd``: candidate pairs and in how many trees they are neighbours (at least two).

    Rows with ``a = b`` give in ``crowd`` how many rows share the node's labels, summed over trees.

    Each tree sorts the sets by their label of eight hash values, over all tasks by
    range, so a region of equal prefixes may lie in several tasks. Neighbours share four
    values at least; in a crowded region the rows next to a row are those with the
    longest common prefix, so the depth there is as large as the crowd asks for.
    """
    part = lambda t, a: F.conv(F.hex(F.substring("labels", 16 * t + a, 8)), 16, -10).cast("long")
    rows = nodes.select("node", "n", F.inline(F.array(*(
        F.struct(F.lit(t).alias("tree"), part(t, 1).alias("label"), part(t, 9).alias("deep")) for t in range(trees)
    ))))
    order = ["tree", "label", "deep", "node"]
    ranged = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    near = ranged.select("tree", "label", "deep", "node", "n").mapInArrow(_neighbours(width), "a long, b long, crowd long")
    return near.groupBy("a", "b").agg(F.count("*").alias("votes"), F.sum("crowd").alias("crowd")).filter("votes > 1 or a = b")


def can_link(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs without those whose parities show that their similarity is below 0.8.

    A shingle of one set only turns one parity, so the sets differ in at least as many
    shingles as parities. Linked sets differ in a ninth of both sizes at most. No link is lost.
    """
    side = nodes.select("node", "n", "parity")
    both = pairs.join(side.toDF("a", "na", "pa"), "a").join(side.toDF("b", "nb", "pb"), "b")

    def cut(p, other):  # sizes are at most a quarter apart, so one modulus is the other or its double
        half = f"zip_with(slice({p}, 1, size({p}) div 2), slice({p}, size({p}) div 2 + 1, size({p}) div 2), (x, y) -> x ^ y)"
        return f"if(size({p}) > size({other}), {half}, {p})"

    differ = f"aggregate(zip_with({cut('pa', 'pb')}, {cut('pb', 'pa')}, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)"
    return both.filter("5 * least(na, nb) >= 4 * greatest(na, nb)").filter(f"9 * {differ} <= na + nb").select(*pairs.columns)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets have 100 * intersection >= 80 * union."""
    left, right = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.withColumn("common", common).filter(
        "100 * common >= 80 * (size(set_a) + size(set_b) - common)"
    ).select("a", "b").distinct()


def _usual(words: int):
    """Each shingle of each set, one a row."""

    def run(batches):
        for _, sets in _sets(batches, words):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["token"])

    return run


def _couples(shingles: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Names of the first couples of a set: a shingle and the next one, by rank and then by hash.

    A couple of a set ``a`` is no couple of ``b`` if its first shingle is not in ``b`` or if a shingle of
    one set only stands between. With ``c`` shingles in common at most 2 * (na - c) + (nb - c) couples are
    lost; a similarity of 0.8 needs 9 * c >= 4 * (na + nb), so a third of na + nb remains, which is 60 %
    of either: the first couple in common is among the first 40 % and one of both. The last
    shingle is a couple by itself.
    """
    order = shingles[np.argsort(rank, kind="stable")]
    n = len(order) - -(-3 * len(order) // 5) + 1
    return _mix(order[:n] * np.uint64(0x9E3779B97F4A7C15) + np.append(order, np.uint64(0))[1 : n + 1]).view(np.int64)


def _prefixes(words: int, usual):
    """Ids, set sizes and the first couples of each set, its usual shingles (the list ``usual``) last."""

    def run(batches):
        tokens, ranks = usual.value
        for ids, sets in _sets(batches, words):
            rows = [(i, s) for i, s in zip(ids, sets) if len(s)]
            heads = []
            for _, s in rows:
                rank = np.zeros(len(s), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    rank = np.where(tokens[at] == s, ranks[at], 0)
                heads.append(_couples(s, rank))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64()), pa.array(heads, pa.list_(pa.int64()))],
                names=["node", "n", "tokens"],
            )

    return run


def _listed(counts: DataFrame, most: int):
    """The most frequent tokens as two arrays, by token: all from a count on, so that there are ``most`` of them or less."""
    sizes = counts.groupBy("count").agg(F.count("*").alias("n")).orderBy(F.desc("count")).collect()  # a row for each count
    total, least = 0, None
    for r in sizes:
        total += r["n"]
        if total > most:
            break
        least = r["count"]
    top = counts.filter(F.col("count") >= least if least else F.lit(False)).toPandas()  # ``most`` rows at most
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(tokens)
    return tokens[by_hash], top["count"].to_numpy(np.int64)[by_hash]


def prefix_pairs(texts: DataFrame, nodes: DataFrame, roots: DataFrame, words: int, block: int, listed: int = 300_000) -> DataFrame:
    """``a, b`` of different components: all pairs that can have a similarity of 0.8 (an exact prefix join).

    Sets are joined by couples of shingles that follow each other in the order (``_couples``); texts of one
    language share many shingles, but few couples. The order only decides how many pairs are compared, not
    which are found, so it comes from an eighth of the documents. Couples met in one component only are
    dropped. A couple of more than ``block`` sets is dealt out in blocks against blocks, so no task has all
    its pairs.
    """
    spark = texts.sparkSession
    some = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(8)) == 0).select("doc_id", "text")
    counts = stored(some.mapInArrow(_usual(words), "token long").groupBy("token").count().filter("count > 1"), "counts")
    usual = spark.sparkContext.broadcast(_listed(counts, listed))
    heads = texts.select("doc_id", "text").mapInArrow(_prefixes(words, usual), "node long, n long, tokens array<long>")
    heads = stored(heads.join(nodes.select("node", "n"), ["node", "n"], "left_semi").join(roots, "node", "left"), "heads")
    posts = heads.select("node", F.coalesce("root", "node").alias("root"), "n", F.posexplode("tokens").alias("pos", "token"))
    mixed = stored(posts.groupBy("token").agg(
        F.min("root").alias("one"), F.max("root").alias("other"), F.ceil(F.count("*") / block).cast("int").alias("cuts")
    ).filter("one <> other").select("token", "cuts"), "mixed")
    live = stored(posts.join(mixed, "token"), "posts")
    own, every = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"), F.explode(F.expr("sequence(0, cuts - 1)"))
    side = ["token", "node", "root", "n", "pos"]
    left = live.select(*side, own.alias("i"), every.alias("j")).toDF("token", "a", "ra", "na", "pa", "i", "j")
    right = live.select(*side, own.alias("j"), every.alias("i")).toDF("token", "b", "rb", "nb", "pb", "j", "i")
    # couples in common >= (na + nb) / 3, and no more than the rest of either set's are
    pairs = left.join(right, ["token", "i", "j"]).filter(
        "a < b and ra <> rb and 5 * least(na, nb) >= 4 * greatest(na, nb) and 3 * least(na - pa, nb - pb) >= na + nb"
    )
    pairs = stored(pairs.select("a", "b").distinct(), "rest")
    release(counts, heads, mixed, live)
    return pairs


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    trees: int = 24,
    width: int = 12,
    hubs: int = 3,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = 500,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; documents of a component reach each other by links.

    A link is a pair of shingle sets with Jaccard similarity of 0.8 or more, always
    confirmed on the full sets. Equal sets are one node, so copies are never paired.
    Candidates come from the forest (``forest_pairs``). First each node is compared
    with its most frequent neighbour; then all pairs whose nodes are not in one
    component yet; then nodes beside a component with the ``hubs`` nodes of it that are
    most like the others, until no link is added. So a large group costs a few
    comparisons per member, not all pairs.

    Words are runs of bytes other than blanks, A-Z lower-cased. A text with fewer words
    than a shingle is one shingle; null, empty and blank texts have none and link with
    nothing. Rows without an id are alone (null component, kept). Rows with the same id
    and words are equal rows of one component. An empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    reach_package(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n long, name binary, labels binary, parity array<long>"
    signed = stored(texts.mapInArrow(_sign(words, trees, seed), schema), "signed")
    known = signed.filter("n > 0 and doc_id is not null")
    nodes = stored(
        known.groupBy("name").agg(
            F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("labels").alias("labels"), F.first("parity").alias("parity")
        ),
        "nodes",
    )
    forest = stored(forest_pairs(nodes, trees, width, partitions), "forest")
    weight = forest.filter("a = b").select(F.col("a").alias("node"), "crowd")
    pairs = stored(can_link(forest.filter("a <> b").drop("crowd"), nodes), "pairs")
    members = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()
    set_schema = "node long, shingles array<long>"

    def full(batches):
        for ids, sets in _sets(batches, words):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    def sets_of(members):
        rows = texts.join(members, "doc_id").select("doc_id", "text")
        return stored(rows.mapInArrow(full, set_schema), "sets")

    # the list of members outgrows any broadcast: plan for that at every size
    sets = sets_of(members.hint("merge"))
    ends = pairs.select("a", "b", "votes", F.inline(F.array(F.struct(F.col("a").alias("x")), F.struct(F.col("b").alias("x")))))
    best = Window.partitionBy("x").orderBy(F.desc("votes"), "a", "b")
    first = ends.withColumn("place", F.row_number().over(best)).filter("place = 1").select("a", "b").distinct()
    links = stored(confirm(first, sets), "links")
    found = [links]
    roots = components(links)
    # pairs that are in one component stay so: each round goes on from those the one before has left
    apart = stored(_apart(pairs, roots), "apart")
    left = stored(confirm(apart.select("a", "b"), sets), "links")
    # the text that others were copied from has the label that is most common among them, in every tree
    order = Window.partitionBy("root").orderBy(F.desc("crowd"), "node")
    while True:
        found.append(left)
        if not left.isEmpty():
            links = links.unionAll(left)
            old, roots = roots, components(links)
            release(old)
        whole = roots.unionAll(roots.select("root", "root").distinct())  # a root is a node, too
        large = whole.groupBy("root").count().filter(F.col("count") >= 3).select("root")
        top = (
            whole.join(weight, "node", "left").na.fill(0, ["crowd"]).join(large, "root").withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= hubs).select("root", F.col("node").alias("hub"))
        )
        old, apart = apart, stored(_apart(apart.select("a", "b"), roots), "apart")
        release(old)
        beside = apart.select(F.col("a").alias("x"), F.col("rb").alias("root")).unionAll(apart.select("b", "ra")).distinct()
        asked = beside.join(top, "root").select(F.least("x", "hub").alias("a"), F.greatest("x", "hub").alias("b")).distinct()
        left = stored(confirm(can_link(asked, nodes), sets), "links")
        if left.isEmpty():
            break
    release(left, forest, sets, pairs, apart)
    rest = prefix_pairs(texts.filter("doc_id is not null"), nodes, roots, words, block)
    # whole sets are shuffled, so only for pairs that can be links
    near = stored(can_link(rest, nodes), "near")
    release(rest)
    rest = near
    if not rest.isEmpty():
        sets = sets_of(rest.select(F.col("a").alias("doc_id")).unionAll(rest.select("b")).distinct())
        # first one pair a node, which joins most of what is left; then all pairs still apart
        one = rest.groupBy("a").agg(F.min("b").alias("b"))
        for asked in (lambda: one, lambda: _apart(rest, roots).select("a", "b")):
            left = stored(confirm(asked(), sets), "links")
            found.append(left)
            if not left.isEmpty():
                links = links.unionAll(left)
                old, roots = roots, components(links)
                release(old)
        release(sets)
    release(*found, rest)
    named = nodes.select("name", "node").join(roots, "node", "left").select(
        "name", F.coalesce("root", "node").alias("root")
    )
    return signed.join(named, "name", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components, and those (``ra``, ``rb``)."""
    ra, rb = roots.toDF("a", "ra"), roots.toDF("b", "rb")
    return pairs.join(ra, "a", "left").join(rb, "b", "left").select(
        "a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb")
    ).filter("ra <> rb")


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) END AS s
  FROM texts
), sized AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b
)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM sized JOIN reach ON a = doc_id GROUP BY doc_id
"""
