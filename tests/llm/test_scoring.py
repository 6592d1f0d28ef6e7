"""License scans and the quality classifier."""

import random

from recordlens.llm import license_scan, quality, queries


def test_alignment_against_the_longest_common_sequence():
    rnd = random.Random(4)
    for _ in range(200):
        a = [rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(0, 14))]
        b = [rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(0, 14))]
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(pairs) <= best[-1][-1]
        if sorted(a) == a and len(set(a)) == len(a) and sorted(b) == b and len(set(b)) == len(b):
            assert len(pairs) == best[-1][-1]
    words = [f"w{k}" for k in range(300)]
    kept = [w for w in words if rnd.random() > 0.1]
    assert len(license_scan.align(kept, words)) == len(kept)


def test_query_against_search(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {(r.doc_id, r.license) for r in queries.op3_license_scan(spark, sf_dir).collect() if r.coverage == 1.0}
    plain = {i: " " + " ".join(license_scan.split_words(t)) + " " for i, t in docs.items()}
    lines = {n: " " + " ".join(license_scan.split_words(t)) + " " for n, t in license_scan.TEMPLATES.items()}
    assert got == {(i, n) for i, t in plain.items() for n, line in lines.items() if line in t}


def test_every_template_whole_and_edited(spark):
    texts, names = [], sorted(license_scan.TEMPLATES)
    for k, name in enumerate(names):
        words = license_scan.split_words(license_scan.TEMPLATES[name])
        texts.append((2 * k, "lorem ipsum " + " ".join(words) + " dolor sit"))
        if len(words) > 12:  # one word lost, one put in
            texts.append((2 * k + 1, " ".join([*words[:4], "xyzzy", *words[4:7], *words[8:]])))
    rows = license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.license): r.coverage for r in rows}
    for k, name in enumerate(names):
        assert got[2 * k, name] == 1.0
    for i, _ in texts:
        if i % 2:
            assert 0.9 < got[i, names[i // 2]] < 1.0


def test_line_repeated_in_a_row(spark):
    docs = [(n, "\n".join([license_scan.TEMPLATES["MIT"]] * n)) for n in range(1, 8)]
    rows = license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_places, r.first_word, r.coverage) for r in rows if r.license == "MIT"} == {
        n: (n, 0, 1.0) for n, _ in docs
    }


def test_edited_and_odd_licenses(spark, odd):
    text = license_scan.TEMPLATES["Apache-2.0 notice"]
    words = text.split()
    changed = " ".join(w if k % 12 else "changed" for k, w in enumerate(words))
    broken = " ".join(w if k % 2 else "changed" for k, w in enumerate(words))
    noise = "the of a and to in " * 3000
    docs = [(1, f"{noise} {changed} {noise}"), (2, broken), (3, None), (4, noise), (None, text), (5, f"{text}\n\n{noise}{text.upper()}")]
    rows = license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    notices = {r.doc_id: r for r in rows if r.license == "Apache-2.0 notice"}
    assert set(notices) == {1, None, 5} and 0.8 <= notices[1].coverage < 1
    assert notices[5].n_places == 2 and notices[5].first_word == 0
    assert license_scan.scan(odd).count() == 0 and license_scan.scan(odd.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    judged = quality.classify(docs, quality.train(docs, train)).join(test, "doc_id").collect()
    right = sum(r.keep == (r.quality == 1 and r.toxic == 0) for r in judged)
    clean_lost = sum(not r.keep for r in judged if r.quality == 1 and r.toxic == 0)
    assert right / len(judged) > 0.85 and clean_lost <= 0.05 * len(judged)


def test_classifier_on_odd_rows(spark, odd, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.keep for r in quality.classify(odd, quality.train(odd, none)).collect())
    odd_labels = [(1, 1, 0), (1, 0, 0), (None, 1, 1), (5, None, 1), (99, 0, 0), (8, 1, 0)]
    few = spark.createDataFrame(odd_labels, "doc_id long, quality int, toxic int")
    assert quality.classify(odd, quality.train(odd, few)).count() == len(odd_rows)
    bad = [(100 + i, f"idiot {'word ' * (i % 7)}", "en", "s", 10) for i in range(40)]
    good = [(200 + i, f"kind {'word ' * (i % 7)}", "de", None, 10) for i in range(40)]
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").unionAll(
        spark.createDataFrame(bad + good, "doc_id long, text string, lang string, source string, n_chars long")
    )
    labels = spark.createDataFrame(
        [(r[0], 1, 1) for r in bad[:30]] + [(r[0], 1, 0) for r in good[:30]], "doc_id long, quality int, toxic int"
    )
    model = quality.train(docs, labels)
    keep = {r.doc_id: r.keep for r in quality.classify(docs, model).collect()}
    assert not any(keep[r[0]] for r in bad) and all(keep[r[0]] for r in good)
    assert quality.classify(docs.limit(0), model).count() == 0
