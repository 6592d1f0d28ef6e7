"""The exact join behind the forest: texts of one vocabulary are not paired by single shingles."""

import random

import numpy as np

from recordlens.llm import near_dedup


def test_linked_sets_share_one_of_their_first_couples():
    rng = np.random.default_rng(3)
    rank = lambda s: (s % np.uint64(5)).astype(np.int64)
    linked = 0
    for _ in range(4000):
        base = rng.choice(400, int(rng.integers(1, 60)), replace=False).astype(np.uint64) * np.uint64(2**50 + 7)
        a = np.unique(np.append(base, rng.choice(400, int(rng.integers(0, 6)), replace=False).astype(np.uint64) * np.uint64(2**50 + 9)))
        b = np.unique(np.append(rng.choice(base, max(1, len(base) - int(rng.integers(0, 6))), replace=False), rng.choice(9, 2).astype(np.uint64)))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            linked += 1
            x, y = near_dedup._couples(a, rank(a)).tolist(), near_dedup._couples(b, rank(b)).tolist()
            # the first couple in common leaves room for a third of both sizes
            assert any(3 * min(len(a) - x.index(c), len(b) - y.index(c)) >= len(a) + len(b) for c in set(x) & set(y))
    assert linked > 300


def test_texts_of_one_vocabulary_are_not_paired(spark):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(80)]
    texts = [" ".join(rnd.choices(words, k=120)) for _ in range(300)]
    texts.append(texts[7] + " w1 w1")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = [len(x) for x in near_dedup.shingle_sets([t.encode() for t in texts], 2)]
    near_dedup.reach_package(spark)
    nodes = spark.createDataFrame(list(enumerate(sizes)), "node long, n long")
    pairs = near_dedup.prefix_pairs(docs, nodes, spark.createDataFrame([], "node long, root long"), 2, 500).collect()
    assert (7, 300) in [tuple(r) for r in pairs]
    assert len(pairs) < 2000


def test_list_of_usual_shingles_is_bounded(spark):
    counts = spark.createDataFrame([(k, 9) for k in range(3)] + [(k, 4) for k in range(3, 10)] + [(10, 2)], "token long, count long")
    assert [len(near_dedup._listed(counts, most)[0]) for most in (2, 3, 9, 10, 99)] == [0, 3, 3, 10, 11]
