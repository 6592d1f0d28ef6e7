"""What candidate pairs cost: pairs already in one component are left out, unlike sets are not compared whole."""

import random

import numpy as np

from recordlens.llm import near_dedup


def test_rounds_go_on_from_the_pairs_left(spark, monkeypatch):
    rnd = random.Random(2)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(200):
        text = list(base)
        for p in rnd.sample(range(200), 3 + 9 * (i % 2)):
            text[p] = f"n{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(text)))
    sizes, real = [], near_dedup._apart
    monkeypatch.setattr(near_dedup, "_apart", lambda pairs, *a, **k: sizes.append(pairs.count()) or real(pairs, *a, **k))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert {r.component_id for r in got} == {0}
    assert len(sizes) >= 2 and all(n < sizes[0] for n in sizes[1:])


def test_unlike_sets_are_ruled_out_and_links_are_not(spark):
    rng = np.random.default_rng(4)
    sets, n = [], 0
    for size in (1, 5, 200, 250, 257, 300, 1000, 2050):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for share in (1.0, 0.95, 0.89, 0.8, 0.3):
            more = rng.integers(0, 1 << 63, size - int(share * size), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([base[: int(share * size)], more])))
        sets.append(np.unique(np.concatenate([base, rng.integers(0, 1 << 63, size // 5, dtype=np.uint64)])))
    nodes = spark.createDataFrame([(i, len(s), near_dedup.parity(s).tolist()) for i, s in enumerate(sets)], "node long, n long, parity array<long>")
    pairs = [(i, j) for j in range(len(sets)) for i in range(j)]
    both = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i, j in pairs}
    links = {(i, j) for (i, j), c in both.items() if 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c)}
    got = {tuple(r) for r in near_dedup.can_link(spark.createDataFrame(pairs, "a long, b long"), nodes).collect()}
    assert len(links) > 20 and links <= got
    assert not any(both[p] == 0 and min(len(sets[i]) for i in p) >= 200 for p in got)
