"""Queries of this package by name, over the tables of one folder, and their SQL."""

from __future__ import annotations

import public_tokenizers

from recordlens.llm import (
    decontam,
    fingerprints,
    jaccard_join,
    license_scan,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    spelling,
    suffix_dedup,
    token_counts,
    token_store,
    url_rules,
)
from recordlens.llm.common import stored, table

BPE = "byte_bpe_50k.json"


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_token_store(spark, sf_dir):
    path = token_store.new_path(spark)
    token_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BPE))
    return token_store.digests(token_store.open_store(spark, path))


def op3_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op5_url_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages")).drop("pattern_rule")


def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE))


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE))


def op8_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir):
    return decontam.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_periodic_runs(spark, sf_dir):
    docs = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs))


def op12_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op13_spelling(spark, sf_dir):
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), edit=97)
    return spelling.spelling_groups(stored(words, "words"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_token_store, op3_license_scan, op4_near_dedup, op5_url_rules,
        op6_token_counts, op7_packing, op8_fingerprints, op9_decontamination, op10_quality, op11_periodic_runs, op12_jaccard_join,
        op13_spelling,
    )
}

ORACLE_SQL = {
    "op4_near_dedup": near_dedup.ORACLE,
    "op5_url_rules": f"SELECT * EXCLUDE (pattern_rule) FROM ({url_rules.ORACLE})",
    "op9_decontamination": decontam.ORACLE,
    "op12_jaccard_join": jaccard_join.ORACLE,
}
