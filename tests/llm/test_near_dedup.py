import random

import numpy as np
from compare import connect, diff

from recordlens.llm import near_dedup, queries


def shingles(text, words):
    w = (text or "").translate(str.maketrans(near_upper, near_upper.lower())).split()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


near_upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute(rows, words):
    """Smallest reachable id of each id, by comparing all pairs."""
    sets = [(i, shingles(t, words)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def test_query_against_sql(spark, sf_dir):
    frame = queries.op4_near_dedup(spark, sf_dir)
    assert diff(frame, connect(sf_dir), near_dedup.ORACLE) == []


def test_large_group_around_one_text(spark):
    """Copies that are near the first text, and many of them near nothing else."""
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 260):
        text = list(base)
        for p in rnd.sample(range(200), rnd.randint(2, 10)):
            text[p] = f"n{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(i, rows[5][1]) for i in range(300, 330)]
    rows += [(400 + i, " ".join(f"u{rnd.randint(0, 500)}" for _ in range(50))) for i in range(60)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    want = brute(rows, 2)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_odd_rows(odd, odd_rows):
    got = near_dedup.near_duplicates(odd, words=5).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].component_id == by_id[6].component_id == 1 and not by_id[6].kept
    for i in (2, 3, 4):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[5].n_shingles == 1 and by_id[None].component_id is None and by_id[None].kept
    assert by_id[8].n_shingles == 5
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_links_inside_a_crowd(spark):
    """Thousands of versions of one template: most pairs are just below 0.8, some hundred are links."""
    rnd = random.Random(5)
    fresh = (f"n{k}" for k in range(10**9))

    def changed(text, n):
        places = set(rnd.sample(range(200), n))
        return [next(fresh) if k in places else w for k, w in enumerate(text)]

    template = [next(fresh) for _ in range(200)]
    shared = {w: k for k, w in enumerate(template)}
    texts = [changed(template, 14) for _ in range(2500)]
    held = np.zeros((len(texts), len(shared)), np.float32)
    for i, text in enumerate(texts):
        held[i, [shared[w] for w in text if w in shared]] = 1
    common = held @ held.T  # all other words stand in one text only
    np.fill_diagonal(common, 200)
    near = 100 * common >= 80 * (400 - common)
    root = np.arange(len(texts))
    while (new := np.where(near, root, len(texts)).min(axis=1)).tolist() != root.tolist():
        root = new
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, words=1).collect()}
    assert (np.bincount(root) > 1).sum() >= 20
    assert got == dict(enumerate(root.tolist()))
