"""Corners of the semantics, each on a few rows, and figures that must add up."""

import pytest
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.functions import email as E
from recordlens.plans import audit, customers, emails, records, weekly
from recordlens.sources import fixtures as fx

ROW = ("run_date string, record_id string, customer_domain_raw string, customer_domain string, "
       "sub_created string, sub_status string, seats bigint")


def rows_frame(spark, rows):
    return spark.createDataFrame(rows, ROW).withColumn("run_date", F.col("run_date").cast("date"))


def test_latest_per_domain(spark):
    rows = rows_frame(spark, [
        ("2026-01-01", "k1", "A.com", "a.com", "2026-01-01 09:00", "active", 1),
        ("2026-01-01", "k2", "a.com", "a.com", "2026-01-01 10:00", "active", 2),
        ("2026-01-01", "k3", "a.com", "a.com", "2026-01-01 10:00", "active", 3),  # tie: larger key
        ("2026-01-02", "k4", "a.com", "a.com", "2026-01-02", "active", 4),
        ("2026-01-02", "k5", "a.com", "a.com", None, "active", 5),  # no time counts as latest
        ("2026-01-01", "k6", "", None, "1", "active", 6), ("2026-01-01", "k7", " ", None, "2", "active", 7),
        ("2026-01-01", "k8", None, None, "1", "active", 8), ("2026-01-01", "k9", None, None, "2", "active", 9),
        ("2026-01-01", "kA", "n/a", None, "1", "active", 10), ("2026-01-01", "kB", "N/A ", None, "2", "active", 11),
    ])
    kept = lambda **k: {r.record_id for r in customers.latest_per_domain(rows, **k).collect()}
    # blank raw texts of a day are one customer, NULL ones another
    assert kept() == {"k3", "k5", "k7", "k9", "kB"}
    assert kept(keep_unkeyed=True) == {"k3", "k5", "k6", "k7", "k8", "k9", "kB"}


def test_batch_keys(spark):
    batch = rows_frame(spark, [("2026-01-01", k, "a", "a", "1", s, 1) for k, s in (("a", "x"), ("a", "y"), ("b", "x"))])
    stored = rows_frame(spark, [("2026-01-02", "a", "a", "a", "1", "x", 1), ("2026-01-01", "b", "a", "a", "1", "x", 1)])
    # a key stored for another date is new, and repeats within the batch stay
    assert sorted(r.sub_status for r in customers.new_rows(batch, stored).collect()) == ["x", "y"]


def test_people_from_profiles(spark):
    rows = [(1, '{"id":"C1"}'), (2, '{"id":"C1"}'), (3, "{}"), (4, None)]
    frame = customers.people_of_profiles(spark.createDataFrame(rows, "id bigint, current_company string"))
    assert [tuple(r) for r in customers.people_summary(frame).collect()] == [("C1", 2)]


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    view = lambda n: fx.view(spark, sf_dir, f"f_{n}")
    frame = customers.staging(customers.ingest(view("subscription")), view("catalog"), view("contact"), view("people"))
    return frame.persist()


def test_group_shares_are_averages(staged):
    """A group with some fields counts in part, not only when all are there."""
    hit = staged.filter("match_status = 'MATCHED'")
    both = hit.filter(customers.field_present("phone") & customers.field_present("email")).count()
    any_ = hit.filter(customers.field_present("phone") | customers.field_present("email")).count()
    share = customers._monitoring(staged.withColumn("all", F.lit(1)), ["all"]).first().contact_coverage_pct
    assert round(100 * both / hit.count(), 2) < share < round(100 * any_ / hit.count(), 2)


def test_monitoring_counts(staged):
    rows = customers.monitoring(staged).collect()
    assert all(r.active_matched_count == 0 for r in rows if r.sub_status != "active")
    assert any(r.active_matched_count for r in rows if r.sub_status == "active")
    assert all(r.matched_count + r.unmatched_count == r.total_customers for r in rows)
    day = min(r.run_date for r in rows)
    back = customers.daily_readback(customers.monitoring(staged)).filter(F.col("run_date") == day).first()
    assert back.total_markets == sum(r.total_markets for r in rows if r.run_date == day)
    over = customers.monitoring_overall(staged).filter(F.col("run_date") == day).first()
    assert over.total_markets <= back.total_markets


def test_window_includes_both_ends(staged):
    days = lambda n: customers.missing_in_window(staged, "2024-01-20", n).agg(F.min("first_seen"), F.max("last_seen")).first()
    first, last = days(7)
    assert (str(first), str(last)) == ("2024-01-13", "2024-01-20")
    assert customers.missing_in_window(staged, "2024-01-20", 7).agg(F.max("days_seen")).first()[0] <= 8
    assert str(days(None)[0]) == "2024-01-01"


COMPANY = "id string, hq_country string, fqdn string, status string"
EMAIL = ("id string, email_row_id bigint, email string, country string, verification_status string, "
         "enabled boolean, source string")


def company_frame(spark, rows):
    return spark.createDataFrame(rows, COMPANY)


def email_frame(spark, rows):
    return spark.createDataFrame([(i, n, e, c, v, b, "s") for n, (i, e, c, v, b) in enumerate(rows)], EMAIL)


def test_coverage_scopes(spark):
    companies = company_frame(spark, [
        ("1", "AU", "a.com", "PUBLISHED"), ("2", "AU", "b.com", "PUBLISHED"), ("3", "AU", "c.com", "PUBLISHED"),
        ("4", "AU", "d.com", "DRAFT"), ("5", "AU", None, "PUBLISHED"), ("6", " ", "f.com", "PUBLISHED")])
    mails = email_frame(spark, [
        ("1", "x@a.com", "AU", None, True), ("1", "y@a.com", "AU", None, True), ("2", "x@b.com", "US", None, True),
        ("3", " ", "FR", None, True), ("4", "x@d.com", "AU", None, True), ("5", None, "AU", None, True)])
    rows = {s: {r.country: r for r in emails.coverage(companies, mails, s).collect()} for s in ("any", "market_set", "hq")}
    assert set(rows["any"]) == {"AU", "UNKNOWN"}
    assert (rows["any"]["AU"].with_email, rows["any"]["AU"].missing_email) == (3, 1)  # the blank one counts
    assert (rows["market_set"]["AU"].with_email, rows["market_set"]["AU"].total_companies) == (2, 4)
    hq = rows["hq"]["AU"]
    assert (hq.total_companies, hq.with_email, hq.has_email_other_market) == (5, 2, 1)


def test_host_gap_counts_null_rows(spark):
    companies = company_frame(spark, [(i, "AU", f"{i}.com", "DRAFT") for i in "1234"])
    mails = email_frame(spark, [
        ("1", None, "AU", None, True), ("1", "x@1.com", "AU", None, True),  # in both columns
        ("2", " ", "AU", None, True), ("3", "x@3.com", "US", None, True)])
    row = emails.fqdn_gap(companies, mails, "hq").first()
    assert (row.companies_with_fqdn, row.missing_email, row.has_email) == (4, 3, 2)
    assert emails.fqdn_gap(companies, mails, "any").count() == 0  # none is published


def test_gap_summary_markets(spark):
    trial = "trial_id string, run_id string"
    fields = spark.createDataFrame(
        [(t, "r", None, t, None, None, "C", 50.0, 4, ["x"]) for t in ("t1", "t2")],
        f"{trial}, run_date date, domain string, crm_name string, customer_id string, catalog_id string, "
        "field_coverage_pct double, fields_missing_count int, missing_fields array<string>")
    people = spark.createDataFrame([("t1", "r", "AU", 3, 0, 0, None)],
        f"{trial}, market string, people_count bigint, headcount bigint, people_gap bigint, people_coverage_pct double")
    places = spark.createDataFrame([("t1", "r", "AU", True, True, False), ("t1", "r", "US", False, True, True), ("t2", "r", "NZ", True, False, False)],
        f"{trial}, market string, in_catalog_at_location boolean, payload_has_location boolean, location_gap boolean")
    got = {(r.trial_id, r.market): r for r in audit.gap_summary(fields, people, places).collect()}
    assert set(got) == {("t1", "AU"), ("t2", None)}
    assert (got["t1", "AU"].location_coverage_pct, got["t1", "AU"].people_coverage_pct) == (50.0, 0.0)
    assert got["t2", None].location_coverage_pct == 0.0 and not got["t2", None].in_catalog_at_location
    both = {(r.trial_id, r.market) for r in audit.gap_summary(fields, people, places, union_markets=True).collect()}
    assert both == {("t1", "AU"), ("t1", "US"), ("t2", "NZ")}


def test_unknown_headcount(spark):
    matched = spark.createDataFrame([("t1", "r", None, "d", "C1", "MATCHED"), ("t2", "r", None, "d", "C1", "MATCHED")],
        "trial_id string, run_id string, run_date date, domain string, catalog_id string, match_status string")
    people = spark.createDataFrame([(i, "C1", m) for i, m in enumerate(["AU", "AU", "AU", "DE"])], "id int, company_id string, country_code string")
    enriched = spark.createDataFrame([("t1", "r", "200", '{"employee_count":"2"}'), ("t2", "r", "404", None)],
        "trial_id string, run_id string, payload_status string, payload_raw string")
    got = {r.trial_id: r for r in audit.people_coverage(matched, people, enriched).collect()}
    assert (got["t1"].people_count, got["t1"].people_coverage_pct, got["t1"].people_gap) == (3, 100.0, 0)
    assert (got["t2"].headcount, got["t2"].people_coverage_pct, got["t2"].people_gap) == (0, None, 0)


GATE_COMPANIES = [("1", "AU", "acme.com", "PUBLISHED"), ("2", "AU", "solo.com", "PUBLISHED"), ("3", "AU", "draft.com", "DRAFT"),
                  ("4", "AU", "dead.com", "PUBLISHED")]
GATE_EMAILS = [
    ("1", "Joe@acme.com", "AU", None, True), ("1", "info@acme.com.au", "AU", None, True), ("1", "noreply@acme.com", "AU", None, True),
    ("1", "joe@gmail.com", "AU", None, True), ("1", "x@other.org", "AU", None, True), ("1", "off@acme.com", "AU", None, False),
    ("1", "null@acme.com", "AU", None, None), ("2", "solo@gmail.com", "AU", None, True), ("2", "x@other.org", "AU", None, True),
    ("3", "x@draft.com", "AU", None, True), ("4", "x@dead.com", "AU", None, True), ("4", "y@gmail.com", "AU", None, True),
    ("1", "bad@acme", "AU", None, True)]


def gate(spark, states=(), **options):
    deliv = spark.createDataFrame(list(states) or [(99, None)], "email_row_id bigint, deliverability string")
    rows = emails.quality_gate(company_frame(spark, GATE_COMPANIES), email_frame(spark, GATE_EMAILS), deliv, **options)
    return sorted(r.email for r in rows.collect())


def test_quality_gate(spark):
    # own host and never checked pass; free only without an address on the own host
    assert gate(spark) == ["info@acme.com.au", "joe@acme.com", "solo@gmail.com", "x@dead.com"]
    assert "off@acme.com" in gate(spark, require_enabled=False) and "null@acme.com" in gate(spark, require_enabled=False)
    # an undeliverable address is out, but it is still an address on the own host
    assert gate(spark, [(10, K.UNDELIVERABLE), (0, "")]) == ["info@acme.com.au", "joe@acme.com", "solo@gmail.com"]
    allowed = spark.createDataFrame([("2", "other"), ("3", "draft")], "id string, root string")
    assert "x@other.org" in gate(spark, exceptions=allowed) and "x@draft.com" not in gate(spark, exceptions=allowed)


def test_gate_keeps_five_best(spark):
    mails = [("1", f"{c}@acme.com", "AU", None, True) for c in "fedcba"] + [("1", "sales@acme.com", "AU", None, True)]
    mails += [("1", "z@acme.com", "NZ", None, True)]
    deliv = spark.createDataFrame([(0, "em-av-highly-likely"), (1, "em-av-likely")], "email_row_id bigint, deliverability string")
    rows = emails.quality_gate(company_frame(spark, GATE_COMPANIES[:1]), email_frame(spark, mails), deliv).collect()
    assert sorted(r.email[0] for r in rows if r.country == "AU") == ["a", "b", "c", "e", "f"]
    assert [r.email for r in rows if r.country == "NZ"] == ["z@acme.com"]


def test_shared_addresses(spark):
    companies = company_frame(spark, [(str(i), "AU", "acme.com" if i == 0 else f"c{i}.com", "PUBLISHED") for i in range(8)])
    mails = [(str(i), "info@acme.com", "AU", None, True) for i in range(8)] + [("1", "x@c1.com", "AU", None, True)]
    kept = {(r.id, r.email) for r in emails.dedupe_shared(companies, email_frame(spark, mails)).collect()}
    assert kept == {("0", "info@acme.com"), ("1", "x@c1.com")}
    assert emails.dedupe_shared(companies, email_frame(spark, mails), more_than=8).count() == 9


def test_marks_one_hot_slug(spark):
    """A third of the rows under one slug: one stays, none is lost."""
    rows = [(i, f"linkedin.com/in/{'hot' if i % 3 == 0 else i}") for i in range(300)] + [(300, None), (301, "")]
    frame = spark.createDataFrame(rows, "row_no bigint, profile_link string")
    marked = records.mark_duplicates(frame, "person")
    assert marked.count() == 302
    assert [r.row_no for r in marked.filter("slug = 'hot' AND status IS NULL").collect()] == [0]
    assert marked.filter("status = '409'").count() == 99


# --- figures that must add up ----------------------------------------------------


@pytest.fixture(scope="module")
def summary(spark, sf_dir):
    mails = fx.email_history(spark, sf_dir)
    deliv = fx.email_history(spark, sf_dir, "f_deliverability")
    dates = [d for d, _ in fx.EMAIL_RUNS]
    frame = weekly.country_summary(fx.view(spark, sf_dir, "f_company"), mails, deliv, dates)
    return frame.persist()


def test_summary_adds_up(spark, sf_dir, summary):
    rows = summary.collect()
    assert len(rows) == 13 * len(fx.EMAIL_RUNS)
    for r in rows:
        assert r.with_email + r.missing_email == r.total_companies
        assert r.domain_match + r.domain_mismatch == r.domain_pairs
        assert abs(r.pct_with_email + r.pct_missing - 100) <= 0.011
        assert r.has_email_other_market <= r.missing_email
    both = emails.well_formed(fx.view(spark, sf_dir, "f_email")).filter(
        E.is_system(F.col("email")) & E.is_free(F.col("email"), "regional") & F.col("country").isin(*K.EMAIL_MARKETS)).count()
    last = [r for r in rows if str(r.run_date) == fx.LATEST_RUN]
    kinds = sum(r.specific_company + r.generic_role_based + r.system_blocked + r.free_provider for r in last)
    # a system address at a free provider counts under both
    assert both > 0 and kinds - both == sum(r.total_email_rows for r in last)


def test_spine_without_data(spark, sf_dir):
    nothing = lambda n: fx.view(spark, sf_dir, n).limit(0)
    rows = weekly.country_summary(nothing("f_company"), nothing("f_email"), nothing("f_deliverability"), [fx.LATEST_RUN]).collect()
    assert len(rows) == 13 and all(r.total_companies is None and r.pct_mismatch is None for r in rows)


def test_changes(summary):
    changes = weekly.delta(summary)
    assert changes.count() == 13 * 7 * (len(fx.EMAIL_RUNS) - 1)
    rows = changes.collect()
    assert all(r.score_impact is None or r.score_impact >= 0 for r in rows)
    assert all((r.delta < 0) == (r.direction == "IMPROVED") for r in rows if r.delta is not None)
    parts = weekly.open_issues(changes).count() + changes.filter(
        (F.col("run_date") == fx.LATEST_RUN) & (F.col("direction") == "IMPROVED")).count()
    assert parts == 13 * 7


def test_alert_limits(spark):
    metrics = {"pct_with_email": 40.0, "pct_system_blocked": 2.0, "pct_mismatch": 20.0, "pct_unverified": 30.01, "pct_gt5": 5.0}
    frame = spark.createDataFrame([("2026-06-19", "AU", *metrics.values())],
        "run_date string, country string, " + ", ".join(f"{m} double" for m in metrics))
    assert [r.alert for r in weekly.alerts(frame).collect()] == ["unverified"]
    runs = [("1", "AU", 60.0, 0.0, 40.0), ("2", "AU", 54.9, 0.0, 40.01), ("1", "US", 20.0, 50.0, 0.0), ("2", "US", 17.0, 50.0, 0.0),
            ("1", "KR", 9.0, 31.0, 0.0), ("2", "KR", 1.0, 30.0, 0.0)]
    frame = spark.createDataFrame(runs, "run_date string, country string, pct_with_email double, pct_mismatch double, pct_generic double")
    got = {(r.run_date, r.country, r.alert) for r in weekly.regression_alerts(frame).collect()}
    assert got == {("2", "AU", "coverage_drop_AU"), ("2", "AU", "generic_role_based"), ("1", "KR", "domain_mismatch_KR")}
