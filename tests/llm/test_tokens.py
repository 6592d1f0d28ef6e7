import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordlens.llm import packing, queries, token_counts, token_store
from recordlens.llm.transducer import Transducer, forget, learned, transducer

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = [
    "a  b\n\n c\t\td ", "don't 'tis we'll  I've I'ra 'r 'r'e '' ''s\n\n's\n\n're \n'll !'s don'tx 12's",
    "\x1c a!\x1c!", "", " ", "\n", "日本語 テキスト  です　 x", "a\0b", "été  \n\n  où\t\n naïve 😀😀 x😀y  ",
    " " * 300 + "x" + "\n" * 57 + "y", "ab" * 3000, "é" * 500 + "日本" * 200, "== " * 30 + "=" * 200 + "Ã" * 40,
    "<|endoftext|>hello <|endoftext|> x",
]


@pytest.fixture(scope="module")
def machine():
    return Transducer(PATH)


def whole(machine, texts):
    return [list(e.ids) for e in machine.library.encode_batch(texts, add_special_tokens=False)]


def test_transducer_equals_library(machine):
    assert [x.tolist() for x in machine.encode(TRICKY)] == whole(machine, TRICKY)
    assert machine.counts(TRICKY) == [len(x) for x in whole(machine, TRICKY)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abcdehinorst'lv \n\t.,!1290éü日😀\r", max_size=400), max_size=5))
def test_transducer_on_random_texts(texts):
    machine = test_transducer_on_random_texts.__dict__.setdefault("machine", Transducer(PATH, max_states=3000))
    assert [x.tolist() for x in machine.encode(texts)] == whole(machine, texts)


def test_rare_characters_beyond_the_table():
    machine = Transducer(PATH, max_symbols=8)
    texts = ["the quick brown fox jumps over the lazy dog " * 3, *TRICKY]
    assert [x.tolist() for x in machine.encode(texts)] == whole(machine, texts)


def test_counts(spark, sf_dir, odd, odd_rows, machine):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(odd, PATH).collect())
    ids = whole(machine, [t or "" for _, t in odd_rows])
    want = sorted((i or 0, len((t or "").encode()), len(x), len(x) > 512) for (i, t), x in zip(odd_rows, ids))
    assert got == want
    assert token_counts.token_counts(odd.limit(0), PATH).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = dict(zip(docs, whole(machine, list(docs.values()))))
    assert {r.doc_id: r.n_tokens for r in queries.op6_token_counts(spark, sf_dir).collect()} == {i: len(x) for i, x in ids.items()}


def test_counts_of_other_models(odd, odd_rows):
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted(r.n_tokens for r in token_counts.token_counts(odd, path).collect())
    assert got == sorted(len(model.encode(t or "")) for _, t in odd_rows)
    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    got = sorted(r.n_tokens for r in token_counts.token_counts(odd, path).collect())
    assert got == sorted(len(other.encode(t or "", add_special_tokens=False).ids) for _, t in odd_rows)


@pytest.mark.parametrize("size, top", [(0, 1), (1, 1), (513, 2), (3000, 70), (5000, 50_000)])
def test_wavelet_matrix(size, top):
    ids = np.random.default_rng(size).integers(0, top, size).astype("<u4")
    m = token_store.WaveletMatrix.from_bytes(token_store.WaveletMatrix.build(ids).to_bytes())
    assert np.array_equal(m.decode(), ids)
    for i in range(0, size, 97):
        token = int(ids[i])
        assert m.access(i) == token
        assert m.rank(token, i) == (ids[:i] == token).sum()
        assert np.array_equal(m.locate(token), np.flatnonzero(ids == token))
        assert m.select(token, m.rank(token, i)) == i
    assert m.rank(top + 7, size) == 0 and len(m.locate(top + 7)) == 0


def test_store_round_trip(spark, sf_dir, machine, odd, odd_rows):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    path = token_store.new_path(spark)
    token_store.write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, PATH, block_ids=5000)
    blocks = token_store.open_store(spark, path)
    ids = [np.array([*x, 0], "<u4") for x in whole(machine, [d.text for d in docs])]
    starts = np.cumsum([0] + [len(x) for x in ids])
    want = [(d.doc_id, a, len(x), zlib.crc32(x.tobytes())) for d, a, x in zip(docs, starts.tolist(), ids)]
    assert sorted(map(tuple, token_store.digests(blocks).collect())) == want
    token = int(ids[3][5])
    where = sorted((d.doc_id, p) for d, x in zip(docs, ids) for p in np.flatnonzero(x == token).tolist())
    assert sorted(map(tuple, token_store.occurrences(blocks, token).collect())) == where
    assert token_store.count_token(blocks, token).first().n == len(where)
    for frame, n in ((odd, len(odd_rows)), (odd.limit(0), 0)):
        path = token_store.new_path(spark)
        token_store.write(frame, path, PATH)
        assert token_store.digests(token_store.open_store(spark, path)).count() == n


def check_packing(rows, ids, capacity):
    by_seq, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    for i, x in ids.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(x)
            assert r.ids_crc32 == zlib.crc32(x[at : at + r.length].tobytes())
            at += r.length
        assert at == len(x)
    assert by_doc.keys() == ids.keys()
    return padding, by_seq


def test_packing(spark, sf_dir, machine):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = {i: np.array([*x, 1], "<u4") for i, x in zip(docs, whole(machine, list(docs.values())))}
    padding, by_seq = check_packing(queries.op7_packing(spark, sf_dir).collect(), ids, 2048)
    assert padding == 0
    full = [v[0].cost for v in by_seq.values() if v[0].sequence_length == 2048]
    assert max(full) <= 2048 + 2048**2 / 4096


def test_packing_odd_rows(odd, odd_rows, machine):
    rows = packing.pack(odd.filter("doc_id is null or doc_id > 1"), PATH, capacity=64, group_tokens=500).collect()
    ids = {i: np.array([*x, 1], "<u4") for (i, _), x in zip(odd_rows, whole(machine, [t or "" for _, t in odd_rows])) if i != 1}
    check_packing(rows, ids, 64)
    twice = packing.pack(odd.filter("doc_id = 1"), PATH).collect()
    assert sum(r.length for r in twice) == 2 * twice[0].doc_tokens
    assert packing.pack(odd.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, PATH, capacity=1000)


def test_costs_are_balanced():
    lengths = np.random.default_rng(1).integers(1, 900, 3000).tolist()
    pieces, sizes, costs = packing.assign(lengths, 2048, 1.0, 1 / 4096)
    full = np.array([c for c, s in zip(costs, sizes) if s == 2048])
    assert sum(p[2] for p in pieces) == sum(lengths) == sum(sizes)
    assert full.std() / full.mean() < 0.05
    assert len(pieces) < len(lengths) + 2 * len(sizes)


def test_snapshot_goes_on_where_it_was_taken(machine):
    texts = ["a few words, a few more", "zwei drei, vier's", "  \n naïve 日本 x1y2", "ünder don't we'll"] * 3
    first = Transducer(PATH)
    first.counts(texts)
    second = Transducer(PATH, max_states=600)
    second.restore(first.snapshot())
    more = [t[::-1] + " " + t.upper() + f" {i} tail" for i, t in enumerate(texts)] + texts
    for _ in range(3):
        assert [list(ids) for ids in second.encode(more)] == [list(ids) for ids in first.encode(more)]
        assert second.counts(more) == [len(e.ids) for e in first.library.encode_batch(more, add_special_tokens=False)]
    third = Transducer(PATH)
    third.restore(second.snapshot())
    assert third.counts(more) == second.counts(more)


def test_driver_learns_nothing_itself(spark, odd, odd_rows, machine, monkeypatch):
    def refused(*args, **kwargs):
        raise AssertionError("a transducer on the driver")

    with monkeypatch.context() as m:
        m.setattr(Transducer, "__init__", refused)
        start = learned(odd, PATH)
        assert learned(odd.filter("text is null"), PATH) is None
    texts = [t or "" for _, t in odd_rows]
    forget(PATH)
    restored = transducer(PATH, start)
    assert restored.frozen > 1
    assert [list(ids) for ids in restored.encode(texts)] == whole(machine, texts)
    forget(PATH)
