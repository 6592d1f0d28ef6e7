"""Whole runs over stored tables, repeated and in sequence."""

from pyspark.sql import functions as F

from recordlens.operators.sinks import table
from recordlens.plans import audit, customers, records, runs
from recordlens.sources import fixtures as fx


def snapshot(spark, root, names):
    out = {}
    for n in names:
        rows = table(spark, root, n)
        out[n] = sorted(map(str, rows.select(*sorted(rows.columns)).collect()))
    return out


def test_weekly_refresh(spark, sf_dir, tmp_path):
    root, names = str(tmp_path), ["email_summary", "email_sources", "email_global", "email_delta"]
    company = fx.view(spark, sf_dir, "f_company")

    def run(date, suffix):
        mails = fx.view(spark, sf_dir, f"f_email{suffix}").drop("run_date")
        deliv = fx.view(spark, sf_dir, f"f_deliverability{suffix}").drop("run_date")
        runs.weekly_refresh(company, mails, deliv, root, date)

    (first, s1), (second, s2) = (fx.EMAIL_RUNS[0][0], "_2"), (fx.EMAIL_RUNS[1][0], "_1")
    run(first, s1)
    count = lambda n, d: table(spark, root, n).filter(F.col("run_date") == d).count()
    assert [count(n, first) for n in ("email_summary", "email_global", "email_delta")] == [13, 1, 0]
    run(second, s2)
    assert [count(n, second) for n in ("email_summary", "email_global")] == [13, 1]
    delta = table(spark, root, "email_delta")
    assert delta.filter(F.col("run_date") == second).count() == 91
    before = snapshot(spark, root, names)
    run(second, s2)
    assert snapshot(spark, root, names) == before


def test_audit_run_sequence_equals_one_plan(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    view = lambda n: fx.view(spark, sf_dir, f"f_{n}")
    rows = customers.ingest(view("subscription")).filter("run_date <= DATE '2024-01-03'")
    side = [view(n) for n in ("catalog", "contact", "people", "region", "payload")]

    def run(day):
        runs.audit_run(rows.filter(F.col("run_date") == day), *side, root)

    names = ["trials", "trial_payloads", "people_coverage", "location_coverage", "quality_score"]
    run("2024-01-01")
    run("2024-01-02")
    before = snapshot(spark, root, names)
    run("2024-01-02")  # also NULL markets are known on the rerun
    assert snapshot(spark, root, names) == before
    run("2024-01-03")

    trials = audit.audit_input(rows)
    matched = audit.audit_match(trials, side[0], side[1])
    enriched = audit.audit_enrich(audit.audit_slugs(matched), side[4])
    gaps = audit.gap_summary(
        audit.field_coverage(matched),
        audit.people_coverage(matched, side[2], enriched),
        audit.location_coverage(matched, side[3], enriched),
    )
    expected = audit.quality_score(gaps, matched)
    columns = sorted(expected.columns)
    stored = table(spark, root, "quality_score")
    assert sorted(map(str, stored.select(*columns).collect())) == sorted(
        map(str, expected.select(*columns).collect()))
    assert stored.filter("direction <> 'FIRST_RUN'").count() > 0

    # all days in one call
    runs.audit_run(rows, *side, f"{root}/at_once")
    again = table(spark, f"{root}/at_once", "quality_score")
    assert sorted(map(str, again.select(*columns).collect())) == sorted(
        map(str, expected.select(*columns).collect()))


def test_priors_within_a_batch_and_from_history(spark):
    schema = "run_id string, run_date string, domain string, market string, match_status string, quality_score double"
    day = F.col("run_date").cast("date")
    make = lambda rows: spark.createDataFrame(rows, schema).withColumn("run_date", day)
    row = lambda day, score, market="AU", status="MATCHED": (f"T{day}", f"2024-01-0{day}", "a.com", market, status, score)
    history = make([row(1, 10.0), row(2, 20.0), row(4, 40.0), row(3, 99.0), row(2, 7.0, None)])
    batch = make([row(3, 30.0), row(5, 50.0), row(5, 1.0, None), row(5, 0.0, None, "UNMATCHED")])
    got = {
        (r.run_id, r.market, r.match_status): (r.prev_run_id, r.prev_quality_score)
        for r in audit.with_prior(batch, history).collect()
    }
    assert got == {
        ("T3", "AU", "MATCHED"): ("T2", 20.0), ("T5", "AU", "MATCHED"): ("T4", 40.0),
        ("T5", None, "MATCHED"): ("T2", 7.0), ("T5", None, "UNMATCHED"): (None, None),
    }


def test_landing_replaces_files(spark, sf_dir, tmp_path):
    marked = records.mark_duplicates(fx.view(spark, sf_dir, "f_company_input"), "company")
    rows = records.attach_payloads(marked, fx.view(spark, sf_dir, "f_payload"))
    for _ in range(2):
        runs.land_inputs(rows, str(tmp_path), "F26.04.24", "2026-04-24")
    stored = runs.landed(spark, str(tmp_path))
    assert stored.count() == rows.count()
    assert stored.filter("payload_status <> '200' AND payload_raw IS NOT NULL").count() == 0
