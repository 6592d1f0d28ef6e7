"""Scores straight from the match against the way over the coverage tables."""

import datetime as dt

import __spark_entry__ as entry
from recordlens.plans import audit

SCORES = (
    "trial_id run_id run_date domain crm_name customer_id catalog_id match_status market field_coverage_pct "
    "people_coverage_pct location_coverage_pct quality_score fields_missing_count missing_fields people_gap "
    "location_gap_count"
).split()
MATCH = (
    "trial_id string, run_id string, run_date date, domain string, crm_name string, customer_id string, "
    "match_status string, catalog_id string, catalog_hq_country string, catalog_name string, "
    "catalog_website string, catalog_linkedin string, catalog_industry string, catalog_founded_year int, "
    "catalog_company_type string, catalog_phone string, catalog_email string"
)


def trial(n, run="T26.04.24", catalog=None, link=None, name="Firm"):
    status = "MATCHED" if catalog else "UNMATCHED"
    found = (name, "firm.example", link, "", 1990, None, "+1", None) if catalog else (None,) * 8
    return (
        f"t{n}", run, dt.date(2026, 4, 24), f"d{n}.example", "crm", str(n), status, catalog,
        "US" if catalog else None, *found,
    )


def ways(spark, trials, people, regions, payloads):
    place = "company_id string, country_code string"
    matched = spark.createDataFrame(trials, MATCH)
    matched = matched.withColumn("match_status", audit.F.when(audit.F.col("catalog_id").isNotNull(), audit.MATCHED)
                                 .otherwise(audit.UNMATCHED))
    people, regions = spark.createDataFrame(people, place), spark.createDataFrame(regions, place)
    payloads = spark.createDataFrame(payloads, "slug string, status string, raw string")
    enriched = audit.audit_enrich(audit.audit_slugs(matched), payloads)
    gaps = audit.gap_summary(
        audit.field_coverage(matched), audit.people_coverage(matched, people, enriched),
        audit.location_coverage(matched, regions, enriched),
    )
    plain = audit.run_scores(gaps, matched)
    once = audit.run_scores_at_once(matched, people, regions, payloads)
    kinds = [[(f.name, f.dataType.simpleString()) for f in frame.schema] for frame in (once, plain)]
    assert kinds[0] == kinds[1]
    return [sorted(map(repr, frame.select(*SCORES).collect())) for frame in (once, plain)]


def test_planted_trials(spark):
    link = "https://www.linkedin.com/company/"
    trials = [
        trial(1, catalog="a", link=link + "acme"),
        trial(2, catalog="b", link=link + "acme/"),  # the same slug in the run: no payload
        trial(3, run="T26.04.25", catalog="b", link=link + "acme"),  # first of its run
        trial(4, catalog="c", link=link + "gone"),  # cached answer is a miss
        trial(5, catalog="d", link=link),  # a blank slug or none at all
        trial(6, catalog="e", link=None),
        trial(7),
        trial(8),
        trial(9, catalog="f", link=link + "odd", name=" "),
        trial(10, catalog="a", link=link + "big"),  # a second trial of a company
    ]
    people = [("a", "US")] * 3 + [("a", "AU"), ("a", "XX"), ("b", "US"), ("c", "JP"), ("f", "SG"), (None, "US")]
    regions = [("a", "AU"), ("a", "AU"), ("b", "NZ"), ("c", "JP"), ("c", "XX"), ("e", "US"), (None, "US")]
    at = '{"address": {"country": "%s"}}'
    places = ", ".join(at % c for c in (" us ", "AU", "au", "FR"))
    payloads = [
        ("acme", "200", '{"employee_count": 2, "locations": [%s]}' % places),
        ("acme", "404", None),
        ("gone", "404", '{"employee_count": 5}'),
        ("odd", "200", '{"employee_count": "many", "locations": [1, null, {"address": 3}, %s]}' % (at % "SG")),
        ("big", "200", "{"),
        ("", "200", '{"employee_count": 9}'),
    ]
    once, plain = ways(spark, trials, people, regions, payloads)
    assert once == plain
    assert len(once) > len(trials)


def test_empty_tables(spark):
    once, plain = ways(spark, [], [], [], [])
    assert once == plain == []
    once, plain = ways(spark, [trial(1, catalog="a", link="x"), trial(2)], [], [], [])
    assert once == plain
    assert len(once) == 2


def test_match_is_not_planned_for_every_use(spark, sf_dir, plan_of):
    i = entry.Inputs(spark, sf_dir)
    scans = [plan_of(frame).count("FileScan") for frame in (i.scores(), i.matched())]
    assert scans[0] <= 2 * scans[1] + 3  # beside two matches: people, regions and payloads


def test_coverage_and_gaps_plan_no_match_of_their_own(spark, sf_dir, plan_of):
    jobs = entry.queries()
    for name in ("audit_people_coverage", "audit_location_coverage", "audit_gap_summary"):
        plan = plan_of(jobs[name](spark, sf_dir))
        assert "/match-" in plan and "events.parquet" not in plan, name  # the trials' table was read before
