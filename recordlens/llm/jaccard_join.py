"""Components of an n-gram Jaccard join, by vertical partitioning of the global n-gram order.

The distinct n-grams of a corpus have one order, and cuts through it split every set into
fragments. What is known of a fragment alone is counted for the fragment alone and summed:

* The first fragment (a part of the hashes) shows which n-grams stand in one set only. A
  set cannot link if more of its n-grams are lonely than a link may leave out, so most sets
  end there.
* Of the other sets all n-grams are counted. They are ordered by how many sets hold them,
  lonely ones first. Two sets that link share an n-gram among the first of each; those
  make the candidate pairs.
* Candidates meet once per fragment between cuts of that order; partial overlaps are
  counted there and summed per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import components, reach_package, release, stored
from recordlens.llm.near_dedup import _sets


def _name(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def _signed(words: int):
    """Set size and a 64-bit name of the set of each row."""

    def run(batches):
        for ids, sets in _sets(batches, words):
            names = np.array([_name(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(names)],
                names=["doc_id", "n", "node"],
            )

    return run


def _posts(words: int, part: int, asked: bool):
    """N-grams below the cut at one ``part``-th of the hashes, with the name of their set.

    Where sets were ``asked`` for by their names, other sets under the same id are left out.
    """

    def run(batches):
        for ids, sets in _sets(batches, words):
            names = np.array([_name(s) for s in sets], np.uint64).view(np.int64)
            if asked:
                sets = [s if i == name else s[:0] for i, name, s in zip(ids, names.tolist(), sets)]
            if part > 1:
                sets = [s[: np.searchsorted(s, np.uint64((1 << 64) // part))] for s in sets]
            many = np.array([len(s) for s in sets], np.int64)
            token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            cols = [token.view(np.int64), np.repeat(names, many)] + ([np.repeat(many, many)] if asked else [])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "node", "n"][: len(cols)])

    return run


def _shared(limit: int):
    """Rows of n-grams that stand in two sets or more, with their place in the global order.

    Rows come sorted by n-gram, each (n-gram, set) once. The order is by the number of sets
    (from ``limit`` on all are equal), then by hash; a number with the sets before the point
    and the hash behind it says both. Only ``limit`` rows are held back.
    """

    def run(batches):
        held = None

        def out(token, node, n, count):
            place = np.minimum(count, limit) + (token.view(np.uint64) >> np.uint64(24)) / float(1 << 40)
            live = count > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c[live]) for c in (node, n, place, token)], names=["node", "n", "place", "token"]
            )

        def counted(token, more):
            edge = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            size = np.diff(np.append(edge, len(token)))
            size[0] += more if len(size) else 0
            return edge, size

        passed, passed_token = 0, None  # rows of the first held n-gram that have left already
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            if not len(cols[0]):
                continue
            held = cols if held is None else [np.concatenate([h, c]) for h, c in zip(held, cols)]
            token, node, n = held
            edge, size = counted(token, passed if passed_token == token[0] else 0)
            count = np.repeat(size, np.diff(np.append(edge, len(token))))
            # the last n-gram may go on: its rows wait, unless it is past the limit anyway
            end = int(edge[-1]) if size[-1] < limit else len(token)
            if end:
                yield out(token[:end], node[:end], n[:end], count[:end])
                if end == len(token):
                    passed, passed_token = int(size[-1]), token[-1]
                held = [c[end:] for c in held] if end < len(token) else None
        if held is not None and len(held[0]):
            token, node, n = held
            edge, size = counted(token, passed if passed_token == token[0] else 0)
            count = np.repeat(size, np.diff(np.append(edge, len(token))))
            yield out(token, node, n, count)

    return run


PARITY = [f"p{k}" for k in range(8)]


def _parities() -> list[Column]:
    """Parities of 512 small fragments of a set (by hash), as bits of eight numbers."""
    bit = F.expr("shiftleft(1L, int(token & 63))")
    word = F.expr("int(shiftright(token, 6) & 7)")
    return [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0))).alias(name) for k, name in enumerate(PARITY)]


def _may_link(percent: int) -> str:
    """Whether a pair of rows of ``firsts`` that share an n-gram may reach the threshold, in SQL.

    Nothing is common before the first common n-gram. Lonely n-grams, and one more wherever
    the parities of a fragment differ, stand in one of the two sets only.
    """
    apart = " + ".join(["la", "lb", *(f"bit_count(a{p} ^ b{p})" for p in PARITY)])
    return (
        f"{100 + percent} * least(na - pa, nb - pb) >= {percent} * (na + nb)"
        f" and {100 + percent} * (na + nb - ({apart})) >= {2 * percent} * (na + nb)"
    )


def _adjacent(percent: int, width: int):
    """Pairs ``a, b`` of rows at most ``width`` places apart that share an n-gram and may link (see ``_may_link``)."""

    def run(batches):
        tail = None
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            old = 0 if tail is None else len(tail[0])
            if tail is not None:
                cols = [np.concatenate([t, c]) for t, c in zip(tail, cols)]
            tail = [c[-width:] for c in cols]
            token, n, pos, lonely, node, *parity = cols
            pairs = []
            for w in range(1, width + 1):
                j = np.arange(max(w, old), len(token))
                i = j - w
                alike = token[i] == token[j]
                i, j = i[alike], j[alike]
                both = n[i] + n[j]
                apart = lonely[i] + lonely[j]
                for p in parity:
                    apart += np.bitwise_count((p[i] ^ p[j]).view(np.uint64)).astype(np.int64)
                fits = (100 + percent) * np.minimum(n[i] - pos[i], n[j] - pos[j]) >= percent * both
                fits &= (100 + percent) * (both - apart) >= 2 * percent * both
                pairs.append((np.minimum(node[i], node[j])[fits], np.maximum(node[i], node[j])[fits]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([p[k] for p in pairs])) for k in (0, 1)], names=["a", "b"]
            )

    return run


def linked(pairs: DataFrame, pieces: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose partial overlaps, summed over the fragments, reach ``percent`` of the union."""
    side = lambda x: pieces.select(
        F.col("node").alias(x), "fragment", F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}")
    )
    partial = pairs.join(side("a"), "a").join(side("b"), ["b", "fragment"])
    common = F.sum(F.size(F.array_intersect("ta", "tb")))
    summed = partial.groupBy("a", "b", (F.col("na") + F.col("nb")).alias("both")).agg(common.alias("common"))
    return summed.filter(F.lit(100 + percent) * F.col("common") >= F.lit(percent) * F.col("both")).select("a", "b")


def jaccard_components(
    docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text",
    part: int = 5, limit: int = 1000, cuts: int = 8, block: int = 500, width: int = 8,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the smallest id reachable by links.

    Two rows link when 100 * intersection >= ``percent`` * union of their sets of ``words``
    successive words (hashes of 64 bits). Equal sets are one node, so copies are never
    paired. Neighbours in the lists of first n-grams are compared first; then, of the candidate
    pairs that are not in one component yet, one of any two components, and at last all whose
    components are still apart; lists of more than ``block`` sets as blocks against blocks. No list, pair or n-gram is capped or dropped: ``part``, ``limit``,
    ``cuts``, ``block`` and ``width`` only decide how much is compared where.

    Words are runs of bytes other than blanks, A-Z lower-cased. A text with fewer words than
    ``words`` is one n-gram; null, empty and blank texts have none, are linked with nothing
    and their own component. Rows without an id link with nothing (null component). Rows
    with the same id are one document whose links are those of all its texts. An empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    reach_package(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(texts.mapInArrow(_signed(words), "doc_id long, n long, node long"), "sized")
    known = signed.filter("n > 0 and doc_id is not null")
    # n-grams that a set may leave out of a link; the places among which two linked sets share one
    spare = F.expr(f"n - cast(ceil({percent} * n / 100) as long)")

    # first fragment: partial counts of lonely n-grams, each of which names its set
    heads = texts.filter("doc_id is not null").mapInArrow(_posts(words, part, False), "token long, node long")
    alone = heads.groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
    counted = known.select("node", "doc_id", "n", F.lit(0).alias("lonely")).unionAll(
        alone.select("node", F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(1))
    )
    kept = (
        counted.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.sum("lonely").alias("lonely"))
        .filter(F.col("lonely") <= spare).select("node", "doc_id")
    )

    # all n-grams of the sets that are left, those of several sets with their place in the order
    asked = texts.join(kept.hint("merge"), "doc_id").select("node", "text")
    posts = asked.mapInArrow(_posts(words, 1, True), "token long, node long, n long")
    order = posts.repartition("token").sortWithinPartitions("token")
    live = order.mapInArrow(_shared(limit), "node long, n long, place double, token long")
    grams = F.array_sort(F.collect_list(F.struct("place", "token"))).alias("grams")
    ordered = live.groupBy("node").agg(F.first("n").alias("n"), grams, *_parities())
    ordered = stored(
        ordered.withColumn("lonely", F.col("n") - F.size("grams")).filter(F.col("lonely") <= spare), "ordered"
    )
    first = F.slice("grams", F.lit(1), (spare + 1 - F.col("lonely")).cast("int"))
    firsts = ordered.select("node", "n", "lonely", *PARITY, F.posexplode(first).alias("at", "gram"), first.alias("all")).select(
        F.col("gram.token").alias("token"), "node", "n", "lonely", (F.col("lonely") + F.col("at")).alias("pos"), *PARITY,
        F.coalesce(F.get("all.token", F.col("at") + 1), F.lit(0)).alias("next"),
    )
    pivots = ordered.select(F.explode("grams.place").alias("place")).approxQuantile("place", [i / cuts for i in range(1, cuts)], 0.01)
    ends = [float("-inf"), *sorted(set(pivots)), float("inf")]
    bounds = F.array(*(F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in zip(ends, ends[1:])))
    pieces = ordered.select("node", "n", "grams", F.posexplode(bounds).alias("fragment", "cut")).select(
        "node", "n", "fragment", F.expr("filter(grams, g -> g.place >= cut.lo and g.place < cut.hi).token").alias("tokens")
    )
    by = ["token", "next", "n", "pos", "node"]
    near = (
        firsts.repartitionByRange(partitions, *by).sortWithinPartitions(*by).select("token", "n", "pos", "lonely", "node", *PARITY)
        .mapInArrow(_adjacent(percent, width), "a long, b long").distinct()
    )
    links = stored(linked(near, pieces, percent), "links")
    roots = components(links)
    release(links)
    rest = stored(_apart(firsts, roots, percent, block), "rest")
    for all_pairs in (False, True):
        if rest.isEmpty():
            break
        # one pair of two components at first: where it links, no other pair between them matters
        tried = stored(rest.select("a", "b") if all_pairs else _one_each(rest), "tried")
        links = stored(linked(tried, pieces, percent), "links")
        merged, left = _merged(roots, rest, tried, links)
        release(roots, rest, tried, links)
        roots, rest = merged, left
    release(rest, ordered)
    named = signed.join(roots, "node", "left").withColumn("root", F.when(
        (F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("root", "node")
    ))
    least = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def _apart(firsts: DataFrame, roots: DataFrame, percent: int, block: int) -> DataFrame:
    """All pairs ``a, b`` that share one of their first n-grams and can reach the threshold, with their different components ``ra, rb``."""
    posts = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = posts.groupBy("token").agg(
        F.min("root").alias("one"), F.max("root").alias("other"), F.ceil(F.count("*") / block).cast("int").alias("cuts")
    ).filter("one <> other").select("token", "cuts")
    dealt = posts.join(mixed, "token").withColumn("own", F.expr("cast(pmod(xxhash64(node), cuts) as int)"))
    every = F.explode(F.expr("sequence(0, cuts - 1)"))
    side = lambda x, own, other: dealt.select(
        "token", F.col("own").alias(own), every.alias(other), F.col("node").alias(x), F.col("root").alias(f"r{x}"),
        F.col("n").alias(f"n{x}"), F.col("pos").alias(f"p{x}"), F.col("lonely").alias(f"l{x}"),
        *(F.col(p).alias(f"{x}{p}") for p in PARITY),
    )
    pairs = side("a", "i", "j").join(side("b", "j", "i"), ["token", "i", "j"])
    return pairs.filter("a < b and ra <> rb").filter(_may_link(percent)).select("a", "b", "ra", "rb").distinct()


def _one_each(rest: DataFrame) -> DataFrame:
    """The smallest pair ``a, b`` of any two components."""
    two = F.least("ra", "rb").alias("low"), F.greatest("ra", "rb").alias("high")
    return rest.groupBy(*two).agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.a", "pair.b")


def _merged(roots: DataFrame, rest: DataFrame, tried: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Roots after ``links`` between components, and the pairs not ``tried`` whose components are still apart."""
    over = components(rest.join(links, ["a", "b"], "left_semi").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    top = lambda x: over.select(F.col("node").alias(x), F.col("root").alias(f"top_{x}"))
    moved = roots.join(top("root"), "root", "left").select("node", F.coalesce("top_root", "root").alias("root"))
    merged = stored(moved.unionAll(over.select("node", "root")), "roots")
    left = rest.join(tried, ["a", "b"], "left_anti").join(top("ra"), "ra", "left").join(top("rb"), "rb", "left").select(
        "a", "b", F.coalesce("top_ra", "ra").alias("ra"), F.coalesce("top_rb", "rb").alias("rb")
    )
    left = stored(left.filter("ra <> rb"), "rest")
    release(over)
    return merged, left


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) END AS s
  FROM texts
), sized AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b
)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(b) AS component_id
FROM sized JOIN reach ON a = doc_id GROUP BY doc_id
"""
