"""Domain match against the nested loop it replaces, and the shape of its plan."""

import pytest
from pyspark.sql import functions as F

from recordlens.operators.matching import match_domains, usable_catalog
from recordlens.sources import fixtures as fx

SCHEMA = "id string, fqdn string, website string"


def brute(domains, catalog, prefer_exact=False):
    """{domain: id} by trying all pairs."""
    out = {}
    for d in {d for d in domains if d}:
        hits = []
        for i, fqdn, website in catalog:
            exact = fqdn is not None and fqdn.strip(" ").lower() == d.strip(" ").lower()
            if exact or (website is not None and d in website):
                hits.append((0 if exact or not prefer_exact else 1, i))
        if hits:
            out[d] = min(hits)[1]
    return out


def run(spark, domains, catalog, **options):
    left = spark.createDataFrame([(d,) for d in domains], "domain string")
    right = spark.createDataFrame(catalog, SCHEMA)
    rows = match_domains(left, right, **options).collect()
    assert len(rows) == len({r.domain for r in rows})
    return {r.domain: r.catalog_id for r in rows}


CATALOG = [
    ("9", "acme.com", "https://www.acme.com/about"), ("2", "other.org", "https://shop.acme.com.au/"),
    ("3", None, "https://data.com"), ("4", "ACME.net ", None), ("5", "x.io", "http://host.x.io:8080/x.io"),
    ("6", "caps.com", "HTTPS://WWW.CAPS.COM"), ("7", "y.de", "https://a_b.example/100%/"), ("8", "", ""),
]
DOMAINS = ["acme.com", "acme.net", "a.co", "x.io", "x.io:8080", "caps.com", "a_b.example", "axb.example",
           "100%", "absent.com", "", None, "acme.com", "com", "o", "www.acme.com", "shop.acme.com.au"]


@pytest.mark.parametrize("prefer_exact", [False, True])
def test_equals_nested_loop(spark, prefer_exact):
    got = run(spark, DOMAINS, CATALOG, prefer_exact=prefer_exact)
    assert got == brute(DOMAINS, CATALOG, prefer_exact)
    assert got["a.co"] == "3"  # inside data.com
    assert got["acme.com"] == ("9" if prefer_exact else "2")
    assert "axb.example" not in got  # '_' is no wildcard


def test_equals_nested_loop_on_driver_tables(spark, sf_dir):
    catalog = usable_catalog(fx.view(spark, sf_dir, "f_catalog"))
    rows = [(r.id, r.fqdn, r.website) for r in catalog.collect()]
    users = [r[0] for r in fx.view(spark, sf_dir, "f_subscription").select("STRIPE_CUSTOMER_ID").distinct().collect()]
    domains = [f"co{u[4:]}.com" for u in users] + [f"o{u[4:]}.com:8080" for u in users] + ["co1", "m", "o7.c"]
    assert run(spark, domains, rows) == brute(domains, rows)


def test_hot_host_and_hot_piece(spark):
    """A third of the websites under one host and many parts with one piece."""
    catalog = [(f"h{i:03}", f"h{i}.net", f"https://www.bighost.com/page{i}") for i in range(120)]
    catalog += [(f"s{i:03}", f"s{i}.net", f"https://shop{i}.bighost.com") for i in range(120)]
    catalog += [(f"z{i:03}", f"z{i}.net", f"https://z{i}.net") for i in range(120)]
    domains = ["bighost.com", "shop7.bighost.com", "z3.net", "page9"]
    assert run(spark, domains, catalog) == brute(domains, catalog)


def test_no_pair_join_in_plan(spark, plan_of):
    left = spark.createDataFrame([(d,) for d in DOMAINS], "domain string")
    plan = plan_of(match_domains(left, spark.createDataFrame(CATALOG, SCHEMA)), run=True)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_catalog_keeps_one_row_per_host(spark):
    rows = [("2", "a.com", "w2"), ("1", " A.com ", "w1"), ("3", None, "w3"), ("4", None, "w4"),
            ("SYNTH_9", "b.com", "w"), ("SYNTHX9", "c.com", "w"), ("SYNTH", "d.com", "w")]
    frame = spark.createDataFrame(rows, SCHEMA)
    # rows without a host fold into one; '_' in the synthetic pattern is a wildcard
    assert {r.id for r in usable_catalog(frame).collect()} == {"1", "3", "SYNTH"}


def test_profile_is_required_on_request(spark):
    rows = [("1", "a.com", "w", '{"linkedin":"x"}'), ("2", "b.com", "w", "{}"), ("3", "c.com", "w", None)]
    frame = spark.createDataFrame(rows, SCHEMA + ", social_media string")
    assert [r.id for r in usable_catalog(frame, True).select(F.col("id")).collect()] == ["1"]
