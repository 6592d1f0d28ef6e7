"""Each stage against brute force on what the stage before it kept."""

import collections
import itertools
import random
import re

import corpus_pipeline
import public_tokenizers
import pytest
from test_near_dedup import brute as near_brute
from tokenizers import Tokenizer

from recordlens.llm.common import stored


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """Documents before and after each stage."""
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), name.replace(" ", "-")))
    return out


def rows(frame):
    return sorted((r.doc_id, r.text) for r in frame.collect())


def test_columns_stay(kept):
    assert all(frame.columns == kept[0].columns for frame in kept[1:-1])
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"


def test_quality_stage(spark, sf_dir, kept):
    labels = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {i for i, _ in rows(kept[1])}
    clean = [i for i, good in labels.items() if good]
    assert sum(i in left for i in clean) >= 0.95 * len(clean)
    # the smallest tables have too few labels to learn the rarer marks (accuracy: test_scoring)
    assert sum(i not in left for i, good in labels.items() if not good) >= 0.25 * sum(not g for g in labels.values())


def test_near_duplicate_stage(kept):
    roots = near_brute(rows(kept[1]), 5)
    assert [i for i, _ in rows(kept[2])] == sorted(i for i, r in roots.items() if i == r)


def repeat_rule(texts, length=400, words=51):
    """Texts without the strings of 400 bytes and of 51 words that start more than once, by counting all strings."""
    raws = [(t or "").encode() for t in texts]
    spots = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", r)] for r in raws]
    named = [[r[a:b] for a, b in at] for r, at in zip(raws, spots)]
    strings = collections.Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    runs = collections.Counter(tuple(w[p : p + words]) for w in named for p in range(len(w) - words + 1))
    for raw, at, w in zip(raws, spots, named):
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if strings[raw[p : p + length]] > 1:
                gone[p : p + length] = b"x" * length
        for p in range(len(w) - words + 1):
            if runs[tuple(w[p : p + words])] > 1:
                low = at[p - 1][1] if p else 0
                high = at[p + words][0] if p + words < len(w) else len(raw)
                gone[low:high] = b"x" * (high - low)
        kept = [bytes(b for b, _ in part) for out, part in itertools.groupby(zip(raw, gone), lambda x: x[1] > 0) if not out]
        yield "".join(k.decode(errors="ignore") for k in kept)


def test_repeat_stage(kept):
    before, after = rows(kept[2]), rows(kept[3])
    assert [i for i, _ in before] == [i for i, _ in after]
    assert [t for _, t in after] == list(repeat_rule([t for _, t in before]))


def test_repeats_from_different_places_are_no_passage(spark, sf_dir):
    word = lambda c, k: [f"{c}{j}" for j in range(k)]
    a, b = word("a", 30), word("b", 30)
    texts = [" ".join(w) for w in (a + b, word("x", 5) + a, b + word("y", 5), a + word("z", 40) + b)]
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    assert rows(corpus_pipeline.unrepeated(spark, docs, sf_dir)) == list(enumerate(texts))


def test_repeated_passages_of_51_words(spark, sf_dir):
    for size in (1, 3, 6):  # 50 of them are below 400 bytes
        word = lambda k: f"{k:x}".rjust(size, "q")[-size:]  # noqa: E731,B023
        rnd = random.Random(size)
        passage = {n: " ".join(word(rnd.getrandbits(36)) for _ in range(n)) for n in (50, 51)}
        # nothing beside a passage is equal by chance but the blanks
        ahead, after = ([" ".join(w.format(c, j) for j in range(60)) for c in "KLMNO"] for w in ("{1}{0}", "{0}{1}"))
        texts = [f"{ahead[k]} {passage[n]} {after[k]}" for k, n in enumerate((50, 51, 50, 51))] + [ahead[4]]
        docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
        got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.unrepeated(spark, docs, sf_dir).collect()}
        for k, text in enumerate(texts):
            want = ahead[k] + after[k] if k in (1, 3) else text
            assert got[k] == (want, len(want))


def test_decontamination_stage(spark, sf_dir, kept):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = dict(rows(kept[4]))
    for i, text in rows(kept[3]):
        held = any(item in " ".join(text.lower().split()) for item in items)
        assert not held or i not in left
    assert len(rows(kept[3])) - len(left) < 0.1 * len(rows(kept[3]))


def test_rows_without_ids_or_with_equal_ids(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    texts = [(None, f"before {item} after"), (None, "a clean text"), (1, f"more {item}"), (1, "another clean text"), (2, "clean")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts], "doc_id long, text string, n_chars long")
    left = {(r.doc_id, r.text) for r in corpus_pipeline.clean(spark, docs, sf_dir).collect()}
    assert left == {(None, "a clean text"), (1, "another clean text"), (2, "clean")}
    kept = corpus_pipeline.distinct(spark, docs.unionAll(docs.filter("doc_id = 1")), sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted((i or 0, t) for i, t in texts)


def test_packing_stage(spark, sf_dir, kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows(kept[4])}
    got = collections.Counter()
    for r in kept[5].collect():
        got[r.doc_id] += r.length
    assert dict(got) == sizes
    assert corpus_pipeline.run(spark, sf_dir).agg({"length": "sum"}).first()[0] == sum(sizes.values())


def test_odd_rows_and_empty_tables(spark, odd, sf_dir):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "key", "node")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns[-2:] == ["key", "node"]
    left = {r.doc_id for r in docs.collect()}
    assert {None, 1, 2, 3, 4, 5, 7, 9}.issubset(left | {7}) and 6 not in left
    empty = odd.select("doc_id", "text", "lang", "source", "n_chars").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0
