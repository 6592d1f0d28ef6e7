"""Shape of the physical plans: what must stay even when one key holds most rows."""

import pytest

import __spark_entry__ as entry
from recordlens.plans import customers, weekly
from recordlens.schemas import SUMMARY_COUNTS
from recordlens.sources import fixtures as fx

JOBS = entry.queries()


@pytest.mark.parametrize("name", ["cta_staging", "audit_input", "email_quality_gate", "records_payload_upsert"])
def test_groups_are_cut_before_the_shuffle(spark, sf_dir, plan_of, name):
    plan = plan_of(JOBS[name](spark, sf_dir))
    windows = plan.count("Window [row_number()")
    assert windows > 0
    assert plan.count("WindowGroupLimit") >= 2 * windows  # a partial and a final limit each


# jobs that store a step on the way are seen through one of them
PLANS = [n for n in JOBS if not n.startswith(("audit_", "stream_"))] + ["audit_match", "audit_dashboard"]


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_pair_joins(spark, sf_dir, plan_of, name):
    plan = plan_of(JOBS[name](spark, sf_dir))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_needed_columns_only(spark, sf_dir, plan_of):
    plan = plan_of(JOBS["email_rows_by_country"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    plan = plan_of(JOBS["records_mark_duplicates"](spark, sf_dir))
    assert "text:string" not in plan


def test_repeat_marks_do_not_gather_a_slug(spark, sf_dir, plan_of):
    plan = plan_of(JOBS["records_mark_duplicates"](spark, sf_dir))
    assert "Window" not in plan


def test_issue_rows_come_from_one_scan(spark, sf_dir, plan_of):
    summary = spark.createDataFrame(
        [tuple([None, "US"] + [1] * len(SUMMARY_COUNTS))],
        "run_date date, country string, " + ", ".join(f"{c} bigint" for c in SUMMARY_COUNTS),
    )
    plan = plan_of(weekly.issues_long(summary))
    assert "Union" not in plan and "Join" not in plan and "Exchange" not in plan


def test_dates_prune_partitions(spark, sf_dir, plan_of, tmp_path):
    rows = customers.ingest(fx.view(spark, sf_dir, "f_subscription"))
    rows.write.partitionBy("run_date").parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows")).filter("run_date = DATE '2024-01-05'")
    assert "PartitionFilters: [isnotnull(run_date" in plan_of(customers.latest_per_domain(table))
