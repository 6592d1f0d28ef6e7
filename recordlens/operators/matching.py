"""Domain match: host equality or host text inside the website.

``website contains domain`` has no join key, and a nested loop over all pairs
does not scale. Here both sides are cut to text pieces of one length. A website
that contains a domain contains each piece of it, so an equi join on one piece
finds every hit; the real test follows. Each domain is keyed by its rarest
piece among the websites, which keeps the number of candidates low, and all of
them are tested: nothing is capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.operators.rows import keep_top, replicated, salted

GRAM = 8
SALTS = 8
BUCKETS = 1 << 16  # of the sketch of piece counts: a bound of what is broadcast


def usable_catalog(catalog: DataFrame, require_profile: bool = False) -> DataFrame:
    """Catalog without synthetic rows, one row per host (the smallest id).

    All rows without a host form one group and leave one row.
    """
    kept = catalog.filter(~F.col("id").like(K.SYNTHETIC_ID_LIKE))
    if require_profile:
        kept = kept.filter(F.get_json_object("social_media", "$.linkedin").isNotNull())
    host = F.lower(F.trim("fqdn"))
    return keep_top(kept, [host], [F.col("id").asc_nulls_last()])


def _grams(text: Column, size: Column) -> Column:
    """All pieces of the given size; none when the text is shorter."""
    last = F.length(text) - size + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))


def _website_hits(domains: DataFrame, catalog: DataFrame) -> DataFrame:
    """(domain, smallest catalog id) of all websites that contain the domain."""
    # Clean domains hold no '/', so a hit lies inside one part of the website.
    # Parts that many rows share (a big host) fold into one row here.
    parts = (
        catalog.filter(F.col("website").isNotNull())
        .select("id", F.explode(F.array_distinct(F.split("website", "/"))).alias("part"))
        .filter(F.col("part") != "")
        .groupBy("part")
        .agg(F.min("id").alias("id"))
    )
    size = F.least(F.length("domain"), F.lit(GRAM))
    keyed = domains.withColumn("size", size).select(
        "domain", "size", F.explode(_grams(F.col("domain"), F.col("size"))).alias("gram")
    )
    # the piece lengths that occur: at most GRAM numbers
    sizes = domains.agg(F.sort_array(F.collect_set(size)).alias("sizes")).scalar()
    pieces = (
        parts.withColumn("size", F.explode(sizes))
        .select("id", "part", F.explode(_grams(F.col("part"), F.col("size"))).alias("gram"))
    )
    # How often a piece occurs is only a guide to the rarest piece of a domain, so counts per
    # bucket of hashes do (BUCKETS rows at most, folded in the scan). Any choice is exact:
    # a website with the domain has all its pieces.
    bucket = F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int").alias("bucket")
    seen = pieces.groupBy(bucket).agg(F.count("*").alias("seen"))
    rarest = (
        keyed.select("domain", "gram", bucket)
        .join(F.broadcast(seen), "bucket")
        .groupBy("domain")
        .agg(F.min(F.struct("seen", "gram")).alias("pick"))
        .select("domain", F.col("pick.gram").alias("gram"))
    )
    return (
        salted(pieces, ["part"], SALTS)
        .join(replicated(rarest, SALTS), ["gram", "_salt"])
        .filter(F.col("part").contains(F.col("domain")))
        .groupBy("domain")
        .agg(F.min("id").alias("catalog_id"))
    )


def match_domains(
    domains: DataFrame, catalog: DataFrame, prefer_exact: bool = False
) -> DataFrame:
    """(domain, catalog_id) of every domain with a hit in the usable catalog.

    ``domains`` has a ``domain`` column of cleaned values. The smallest id wins
    over both branches; with ``prefer_exact`` a host match wins over a website
    match.
    """
    domains = domains.select("domain").filter(F.col("domain") != "").distinct()
    hosts = catalog.select(F.lower(F.trim("fqdn")).alias("host"), F.col("id").alias("catalog_id"))
    exact = domains.join(hosts, F.lower(F.trim("domain")) == F.col("host")).select(
        "domain", "catalog_id", F.lit(0).alias("rank")
    )
    loose = _website_hits(domains, catalog).withColumn("rank", F.lit(1))
    order = ["rank", "catalog_id"] if prefer_exact else ["catalog_id"]
    return (
        exact.unionByName(loose)
        .groupBy("domain")
        .agg(F.min(F.struct(*order)).alias("best"))
        .select("domain", "best.catalog_id")
    )
