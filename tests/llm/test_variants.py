"""The run, join and spelling operators against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordlens.llm import jaccard_join, periodic_runs, spelling
from recordlens.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- periodic runs


def brute_runs(w, least=6, power=4):
    n, found = len(w), {}
    for q in range(1, n // power + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, power * q) and (i, j + q) not in found:
                found[i, j + q] = q  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_document(i, text):
    w = WORD.findall(text or "")
    n = len(w)
    if i is not None and n:
        h = zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
    runs = brute_runs(w)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(((-m, s, q) for s, m, q in runs), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        i, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)),
    )


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 30), st.integers(1, 9))
def test_runs_equal_brute_force(block, period, times):
    words = (block[:period] or [0]) * times + block
    assert periodic_runs.find_runs(np.array(words, np.int64)) == brute_runs(words)


@pytest.mark.parametrize("least, power", [(6, 4), (2, 2), (10, 3)])
def test_runs_of_long_periods(least, power):
    rng = np.random.default_rng(3)
    for period in (1, 2, 5, 6, 16, 17, 50, 54, 200):
        block = rng.integers(0, 4, period).tolist()
        words = rng.integers(0, 4, 40).tolist() + (block * 9)[: period * 5 + 3] + rng.integers(0, 4, 40).tolist()
        assert periodic_runs.find_runs(np.array(words, np.int64), least, power) == brute_runs(words, least, power)


def test_runs_nested_and_thue_morse():
    word = [bin(i).count("1") % 2 for i in range(512)]
    nested = ([0, 0, 0, 0, 0, 0, 1] * 6 + [2]) * 5
    for w in (word, nested, word * 4, [7] * 3000):
        assert periodic_runs.find_runs(np.array(w, np.int64)) == brute_runs(w)


def test_runs_of_documents(spark, sf_dir, odd, odd_rows):
    docs = table(spark, sf_dir, "documents")
    got = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(docs)))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert order(map(tuple, got.collect())) == order(brute_document(*r) for r in rows)
    got = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(odd)))
    assert order(map(tuple, got.collect())) == order(brute_document(*r) for r in odd_rows)
    assert periodic_runs.periodic_runs(periodic_runs.planted(docs.limit(0))).count() == 0


# ---- Jaccard join


def brute_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
        sets.append(grams)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if rows[x][0] is None or rows[y][0] is None or not sets[x] or not sets[y]:
                continue
            if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return [(i, len(s), None if i is None else least[find(x)] if s else i) for x, ((i, _), s) in enumerate(zip(rows, sets))]


def test_join_odd_rows(spark, odd, odd_rows):
    got = jaccard_join.jaccard_components(odd).collect()
    assert order(map(tuple, got)) == order(brute_components(odd_rows, 3, 90))
    assert jaccard_join.jaccard_components(odd.limit(0)).count() == 0


@pytest.mark.parametrize("percent, block, part", [(90, 500, 5), (80, 3, 2), (50, 500, 1)])
def test_join_equals_brute_force(spark, percent, block, part):
    """Crowds of near copies of few texts, long and short, with one passage in a third of all."""
    rng = np.random.default_rng(5)
    bases = [rng.integers(0, 3000, n).tolist() for n in (8, 20, 60, 60, 200)]
    passage, rows = rng.integers(0, 3000, 30).tolist(), []
    for i in range(300):
        w = list(bases[i % 5])
        for _ in range(rng.integers(0, 1 + len(w) // 20 + 1)):
            w[rng.integers(len(w))] = int(rng.integers(0, 3000))
        if i % 3 == 0:
            w += passage
        rows.append((1000 - i, " ".join(map(str, w))))
    rows += [(5, rows[0][1]), (6, rows[0][1].upper()), (6, "another text"), (7, "Another  TEXT")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_components(docs, percent=percent, block=block, part=part, limit=20)
    assert order(map(tuple, got.collect())) == order(brute_components(rows, 3, percent))


# ---- spelling variants


def brute_words(rows, edit):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if edit and h % edit == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def brute_groups(words):
    def near(x, y):
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        if len(x) > len(y):
            x, y = y, x
        return len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))

    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    out, forms = [], {}
    for w, n in words.items():
        close = [x for m in (-1, 0, 1) for x in by_length.get(len(w) + m, []) if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        forms[w] = form
        out.append([w, form, None, n, len(close), words[form] if form else None])
    for row in out:
        at = row[0]
        while forms[at]:
            at = forms[at]
        row[2] = at
    return [tuple(r) for r in out]


def test_spelling_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    words = spelling.vocabulary(docs, edit=97, limit=500)
    assert {r.word: r.n for r in words.collect()} == brute_words(rows, 97)
    got = spelling.spelling_groups(words)
    assert order(map(tuple, got.collect())) == order(brute_groups(brute_words(rows, 97)))


def test_spelling_odd_rows(spark, odd, odd_rows):
    doubled = odd.unionAll(odd).unionAll(odd)
    got = spelling.spelling_groups(spelling.vocabulary(doubled, edit=1))
    assert order(map(tuple, got.collect())) == order(brute_groups(brute_words(odd_rows * 3, 1)))
    assert spelling.spelling_groups(spelling.vocabulary(odd.limit(0))).count() == 0


@pytest.mark.parametrize("block, rows", [(2048, 4096), (3, 8)])
def test_spelling_of_crowded_words(spark, block, rows):
    """Few letters, so most words are near many others, and share halves; frequencies with ties."""
    rng = np.random.default_rng(1)
    words = {"".join(rng.choice(list("abé"), rng.integers(2, 9))): int(rng.integers(1, 40)) for _ in range(900)}
    words |= {"z" * 300: 4, "z" * 301: 9, "z" * 200 + "y" + "z" * 99: 2, "é": 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    told = {r.word: (r.n_near, r.best, r.best_n) for r in spelling.variants(frame, block, rows).collect()}
    for w, form, _, _, near, _ in brute_groups({w: n for w, n in words.items() if len(w) > 1}):
        assert told[w][0] == near and (form is None or told[w][1] == form)
    assert told["é"][0] == 0
    got = spelling.spelling_groups(frame.filter("length(word) > 1"), block=block).collect()
    assert order(map(tuple, got)) == order(brute_groups({w: n for w, n in words.items() if len(w) > 1}))


def test_near_copies_are_not_compared_in_all_pairs(spark, monkeypatch):
    from recordlens.llm import jaccard_join

    compared = []

    def counted(pairs, pieces, percent, real=jaccard_join.linked):
        compared.append(pairs.count())
        return real(pairs, pieces, percent)

    monkeypatch.setattr(jaccard_join, "linked", counted)
    words = [f"w{i}" for i in range(400)]
    rows = [(d, " ".join(words[: 2 * d] + [f"own{d}"] + words[2 * d + 1 :])) for d in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_components(docs, width=1).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 120
    assert sum(compared) < 120 * 119 / 2 / 4
