import collections
import hashlib
import random

import numpy as np
import pytest

from recordlens.llm import suffix_dedup


def brute(texts, length):
    """``n_bytes, n_removed, n_spans, sha`` of each text, by counting all strings."""
    raws = [(t or "").encode() for t in texts]
    counts = collections.Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - length + 1):
            if counts[r[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_run_index_against_counting():
    rnd = random.Random(1)
    for _ in range(80):
        length, letters = rnd.choice([12, 20]), rnd.choice(["ab", "abcd"])
        base = "".join(rnd.choice(letters) for _ in range(80))
        texts = {
            base[a : a + rnd.randint(1, 40)] + "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
            for a in (rnd.randint(0, 40) for _ in range(rnd.randint(1, 12)))
        }
        texts = sorted(texts)
        index = suffix_dedup.RunIndex([t.encode() for t in texts], length)
        gone = [np.zeros(len(t), bool) for t in texts]
        for own, low, high in zip(*index.spans()):
            gone[own][low:high] = True
        assert [int(g.sum()) for g in gone] == [r[1] for r in brute(texts, length)]
        assert index.sizes.sum() == sum(len(t) + 1 for t in texts) and len(index.heads) == len(index.sizes)


def test_query_against_counting(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(map(tuple, docs.select("doc_id", "text").collect()))
    want = [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], 400))]
    assert sorted(map(tuple, suffix_dedup.digests(docs).collect())) == want


@pytest.mark.parametrize("most", [4000, 3])
def test_hot_groups_and_repeating_texts(spark, most):
    rnd = random.Random(2)
    word = lambda n: "".join(rnd.choice("abcdef ") for _ in range(n))
    base = word(300)
    texts = [None, "", "xyz" * 37, base[:50] + "pq" * 30, "a" * 100, "é" * 60]
    texts += [word(rnd.randint(0, 40)) + base[a : a + rnd.randint(30, 200)] + word(rnd.randint(0, 40)) for a in (rnd.randint(0, 150) for _ in range(150))]
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(texts)] + [(9, texts[9], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    found = suffix_dedup.with_ranges(docs, length=40, k=8, most=most, block=2000).collect()
    got = sorted(
        (len((r.row.text or "").encode()), sum(b - a for a, b in suffix_dedup._merge(r.ranges)), len(suffix_dedup._merge(r.ranges)))
        for r in found
    )
    assert got == sorted(x[:3] for x in brute([t for _, t, _ in rows], 40))


def test_odd_rows(odd, odd_rows):
    got = sorted((r.doc_id or 0, *tuple(r)[1:]) for r in suffix_dedup.digests(odd).collect())
    want = sorted((i or 0, *x) for (i, _), x in zip(odd_rows, brute([t for _, t in odd_rows], 400)))
    assert got == want
    kept = suffix_dedup.remove(odd)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    assert {r.doc_id: r.n_chars for r in kept.collect()}[8] == 0
    assert suffix_dedup.digests(odd.limit(0)).count() == 0
