"""The weekly fold against the jobs that compute the same figures one by one."""

import random

import pytest
from pyspark.sql import functions as F

from recordlens.constants import EMAIL_MARKETS, VERIFICATION_STATES
from recordlens.plans import emails as jobs
from recordlens.plans import weekly

DAY = "2026-06-12"


@pytest.fixture(scope="module")
def tables(spark):
    """Companies with several rows, markets and no id; addresses that are NULL, blank, foreign or shared."""
    pick = random.Random(5)
    places = [*EMAIL_MARKETS[:4], "ZZ", None]
    hosts = ["www.one.com", "two.co.uk", "three", "", None, "one.com"]
    companies = [(i if i else None, pick.choice(places), pick.choice(hosts)) for i in range(40) for _ in range(pick.choice([1, 1, 2]))]
    addresses = ["sales@one.com", "jo.bloggs@two.co.uk", "noreply@one.com", "x@gmail.com", "no address", "@", "a@b", "", " ", None]
    states = [*VERIFICATION_STATES, " ", "", None, "other"]
    mails = [
        (pick.choice([None, *range(1, 45)]), pick.choice(places[:3] + places[4:]), pick.choice(addresses), pick.choice(states))
        for _ in range(400)
    ] + [(7, EMAIL_MARKETS[0], f"p{k}@root{k}.com", None) for k in range(300)]
    hub = spark.createDataFrame(companies, "id bigint, hq_country string, fqdn string").withColumn("status", F.lit("PUBLISHED"))
    return hub, spark.createDataFrame(mails, "id bigint, country string, email string, verification_status string")


def summary_of(spark, hub, mails):
    deliv = spark.createDataFrame([], "run_date date, country string, deliverability string")
    dated = mails.withColumn("run_date", F.lit(DAY).cast("date"))
    other = mails.limit(20).withColumn("run_date", F.lit("2026-06-05").cast("date"))
    rows = weekly.country_summary(hub, dated.unionByName(other), deliv, [DAY]).collect()
    assert sorted(r.country for r in rows) == sorted(EMAIL_MARKETS)
    return {r.country: r for r in rows}


def by_country(frame):
    return {r.country: r for r in frame.collect() if r.country in EMAIL_MARKETS}


def test_same_as_single_jobs(spark, tables):
    hub, mails = tables
    got = summary_of(spark, hub, mails)
    placed = hub.filter("id is not null")
    cover, gap = by_country(jobs.coverage(hub, mails, "hq")), by_country(jobs.fqdn_gap(hub, mails, "hq"))
    pairs = by_country(jobs.domain_mismatch(placed, mails.filter("id is not null"), "hq"))
    excess = by_country(
        mails.groupBy("country", "id").agg(F.count_if(F.trim("email") != "").alias("n"))
        .groupBy("country").agg(F.count_if(F.col("n") > 5).alias("many"))
    )
    status = F.trim("verification_status")
    states = by_country(mails.groupBy("country").agg(
        F.count_if(F.coalesce(status, F.lit("")) == "").alias("unverified"),
        *[F.count_if(status == s).alias(s.lower().replace(" ", "_")) for s in VERIFICATION_STATES],
    ))
    assert cover and gap and pairs
    for country, r in got.items():
        c, g, p = cover.get(country), gap.get(country), pairs.get(country)
        assert (r.total_companies, r.with_email, r.missing_email, r.has_email_other_market) == (
            (c.total_companies, c.with_email, c.missing_email, c.has_email_other_market) if c else (None,) * 4)
        assert (r.companies_with_fqdn, r.has_fqdn_no_email, r.has_fqdn_with_email) == (
            (g.companies_with_fqdn, g.missing_email, g.has_email) if g else (None,) * 3)
        assert (r.domain_pairs, r.domain_match, r.domain_mismatch) == (
            (p.total_pairs, p.domain_match, p.domain_mismatch) if p else (None,) * 3)
        assert r.companies_gt5_emails == (excess[country].many if country in excess else None)
        v = states.get(country)
        assert (r.unverified, r.highly_likely, r.likely, r.unsure) == (
            (v.unverified, v.highly_likely, v.likely, v.unsure) if v else (None,) * 4)


def test_empty_tables(spark, tables):
    hub, mails = tables
    alone = summary_of(spark, hub, mails.limit(0))
    assert all(r.unverified is None and r.domain_pairs is None for r in alone.values())
    assert sum(r.missing_email or 0 for r in alone.values()) == sum(r.total_companies or 0 for r in alone.values()) > 0
    nobody = summary_of(spark, hub.limit(0), mails)
    assert all(r.total_companies is None and r.with_email is None and r.domain_pairs is None for r in nobody.values())
    assert sum(r.unverified or 0 for r in nobody.values()) > 0


def test_emails_are_read_once(spark, tables, plan_of, tmp_path):
    hub, mails = tables
    dated = mails.withColumn("run_date", F.lit(DAY).cast("date"))
    dated.write.parquet(str(tmp_path / "mails"))
    stored = spark.read.parquet(str(tmp_path / "mails"))
    deliv = spark.createDataFrame([], "run_date date, country string, deliverability string")
    plan = plan_of(weekly.country_summary(hub, stored, deliv, [DAY]))
    assert plan.count("FileScan parquet") == 1
