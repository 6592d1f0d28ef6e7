"""URL rules, fingerprints and decontamination: DataFrame functions only."""

import collections
import hashlib

import pytest
from compare import connect, diff

from recordlens.llm import decontam, fingerprints, queries, url_rules


@pytest.mark.parametrize("name", ["op5_url_rules", "op9_decontamination"])
def test_against_sql(spark, sf_dir, name):
    assert diff(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", ["op5_url_rules", "op8_fingerprints", "op9_decontamination"])
def test_no_python_in_the_plan(spark, sf_dir, plan_of, name):
    plan = plan_of(queries.QUERIES[name](spark, sf_dir))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_urls(spark):
    urls = [
        (1, None, ("", "", None, "allow")),
        (2, "nope", ("", "", None, "allow")),
        (3, "http://EXAMPLE.net/en/x?q#f", ("example.net", "/en/x", "example.net/en/", "allow")),
        (3, "http://EXAMPLE.net/en/x?q#f", ("example.net", "/en/x", "example.net/en/", "allow")),
        (4, "a://net", ("net", "", None, "allow")),
        (5, "a://b.net/", ("b.net", "/", "net/", "block")),
        (6, "x://notnet/", ("notnet", "/", None, "allow")),
        (7, "x://a.org/fr/?://q", ("a.org", "/fr/", "org/fr/", "allow")),
        (8, "http://q.com/a/login/b", ("q.com", "/a/login/b", None, "block")),
        (9, "http://q.com/logins", ("q.com", "/logins", None, "allow")),
        (10, "http://example.com/de", ("example.com", "/de", None, "allow")),
        (None, "http://x.ORG/FR/", ("x.org", "/FR/", None, "allow")),
        (11, "http://example.net/EN/", ("example.net", "/EN/", "net/", "block")),
        (12, "", ("", "", None, "allow")),
        (13, "a://b?c/d", ("b", "", None, "allow")),
        (14, "http://example.org/" + "a/" * 20000, ("example.org", "/" + "a/" * 20000, None, "allow")),
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u, _ in urls], "page_id long, url string, host string, rule string")
    got = sorted(((r.page_id or 0, r.host, r.path, r.rule or "", r.verdict) for r in url_rules.judge(pages).collect()))
    assert got == sorted((i or 0, w[0], w[1], w[2] or "", w[3]) for i, _, w in urls)
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_rules_are_indexed_by_their_rarest_word(spark):
    pages = spark.createDataFrame([(f"h.example.net/en/{i}",) for i in range(5)] + [("a.net/",)], "target string")
    index = {r.text: r.token for r in url_rules.index_rules(pages, (*url_rules.SITES, url_rules.Rule("any", "allow", "x", ()))).collect()}
    assert index["any"] is None and index["net/"] == "net" and index["org/fr/"] in ("fr", "org")
    assert index["example.net/en/"] == "en"
    # the open end of a path is no word
    assert url_rules.site_rule("block", "a.b", "/doc").words == ("a", "b")


def edited(rows):
    """Each text with its second half replaced by the start of the next one."""
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        yield i, t, t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half], rows[(k + 1) % len(rows)][1]


def jaccard(a, b):
    a, b = collections.Counter(a.split()), collections.Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, docs.collect()))
    got = {r.doc_id: r for r in queries.op8_fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    errors, prints = [], collections.defaultdict(set)
    for i, text, other, after in edited(rows):
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        errors += [r.near_edited - jaccard(text, other), r.near_next - jaccard(text, after)]
        prints[text].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert abs(sum(errors) / len(errors)) < 0.02 and sum(map(abs, errors)) / len(errors) < 0.08


def test_fingerprints_of_odd_rows(spark, odd, odd_rows):
    rows = sorted(((i, t or "") for i, t in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = sorted((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in fingerprints.fingerprints(odd).collect())
    want = sorted((i or 0, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in edited(rows))
    assert got == want
    assert fingerprints.fingerprints(odd.limit(0)).count() == 0
    one = spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")
    row = fingerprints.fingerprints(one).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()


def test_passages_with_edits(spark):
    words = [f"w{k}" for k in range(50)]
    item, near, far = " ".join(words), list(words), list(words)
    near[20] = "other"
    near.insert(45, "more")
    for k in range(0, 50, 7):
        far[k] = "x"
    pad = " ".join(f"p{k}" for k in range(30))
    docs = [
        (1, f"{pad} {item.upper()}\n{pad}"), (2, pad), (3, f"{pad} {' '.join(near[:45] + near[46:])}"), (4, " ".join(far)),
        (5, None), (6, ""), (None, f"{pad}\t{item}"), (1, f"{pad} {item.upper()}\n{pad}"), (7, "a b"), (8, f"{item} {item}"),
        (9, " ".join(words[3:])), (10, f"{pad} " * 3000 + item),
    ]
    frame = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n int, w string")
    items = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, " ", 0), (4, "a b", 0), (None, "c d e f g h", 0)], "item_id long, text string, n int")
    got = {(r.doc_id, r.item_id): r for r in decontam.passages(frame, items).collect()}
    assert set(got) == {(1, 1), (3, 1), (None, 1), (7, 4), (8, 1), (9, 1), (10, 1)}
    assert got[1, 1].similarity == 1.0 and got[1, 1].start_word == 30 and got[8, 1].start_word == 0
    assert got[10, 1].start_word == 90_000 and 0.8 <= got[3, 1].similarity < 1
    assert decontam.passages(frame.limit(0), items).count() == 0
    assert decontam.passages(frame, items.limit(0)).count() == 0


def test_shuffled_rules_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f g h y")], "doc_id long, text string")
    monkeypatch.setattr(decontam, "BROADCAST_SHINGLES", 0)
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", 0)
    assert decontam.passages(docs, items).count() == 1
    pages = spark.createDataFrame([(1, "a://b.net/")], "page_id long, url string")
    assert url_rules.judge(pages).first().rule == "net/"


def test_passages_in_another_order(spark):
    """Every item-sized window against every item, by brute force; halves and sentences are exchanged."""
    items = [(k, [f"i{k}w{j}" for j in range(n)]) for k, n in enumerate((60, 60, 45, 90))]
    pad = [f"p{j}" for j in range(70)]
    mixed = [w[h:] + w[:h] for _, w in items for h in (len(w) // 2, len(w) // 3)]
    mixed += [w[40:] + w[20:40] + w[:20] for _, w in items] + [w[1:] for w in mixed[:2]] + [w[:5] + w[9:] for _, w in items]
    docs = list(enumerate([pad[:a] + w + pad[:b] for w in mixed for a, b in ((0, 0), (30, 40), (0, 50), (25, 0))]))

    def runs(w):
        return collections.Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))

    want = {}
    for i, w in docs:
        for k, item in items:
            for start in range(-len(item) + 1, len(w)):
                a, b = runs(w[max(start, 0) : start + len(item)]), runs(item)
                s = sum((a & b).values()) / sum((a | b).values())
                if s >= 0.8 and s > want.get((i, k), (0,))[0]:
                    want[i, k] = s, max(start, 0)
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontam.passages(frame, bench).collect()}
    assert len(want) > 40 and got == want
