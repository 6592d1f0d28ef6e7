"""Whole runs over stored tables: weekly e-mail refresh, trial audit, input landing.

Each run may be repeated: run tables are replaced by run date or file, history
tables take only keys they do not hold, rebuilt tables are overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.operators import sinks
from recordlens.operators.generations import Generations
from recordlens.operators.key_filters import insert_new
from recordlens.plans import audit, emails, records, weekly
from recordlens.schemas import TABLES, conform
from recordlens.session import configure
from recordlens.sources.files import read_inputs


def weekly_refresh(
    companies: DataFrame, mails: DataFrame, deliv: DataFrame, root: str, run_date: str
) -> None:
    """Country summary, sources, global row and changes of one run date.

    The base tables are read once per metric set; the later tables come from
    the stored summary, which has one row per run and market.
    """
    spark = configure(companies.sparkSession)
    day = F.lit(run_date).cast("date")
    mails, deliv = mails.withColumn("run_date", day), deliv.withColumn("run_date", day)

    def put(name: str, rows: DataFrame) -> None:
        sinks.replace_partitions(
            conform(rows, name), f"{root}/{name}", "run_date", [run_date]
        )

    put("email_summary", weekly.country_summary(companies, mails, deliv, [run_date]))
    put("email_sources", emails.source_breakdown(mails))
    summary = sinks.table(spark, root, "email_summary")
    put("email_global", weekly.global_summary(companies, summary.filter(F.col("run_date") == day)))
    put("email_delta", weekly.delta(summary.filter(F.col("run_date") <= day)))


def audit_run(
    rows: DataFrame,
    catalog: DataFrame,
    contacts: DataFrame,
    people: DataFrame,
    regions: DataFrame,
    payloads: DataFrame,
    root: str,
) -> None:
    """Trials of the given ingested rows through all audit tables.

    The score looks up earlier runs in its own history. Match, field coverage
    and gaps describe the current run only and are rebuilt.
    """
    spark = configure(rows.sparkSession)

    def add(name: str, frame: DataFrame, keys: list[str]) -> DataFrame:
        insert_new(conform(frame, name), f"{root}/{name}", keys, "run_id")
        return sinks.table(spark, root, name).join(runs, "run_id", "left_semi")

    def rebuilt(name: str, frame: DataFrame) -> DataFrame:
        return sinks.stored(conform(frame, name), f"{root}/{name}")

    by_market = [*audit.TRIAL, "market"]
    new = sinks.stored(conform(audit.audit_input(rows), "trials"), f"{root}/current_trials")
    runs = new.select("run_id").distinct()
    trials = add("trials", new, audit.TRIAL)
    matched = rebuilt("match", audit.audit_match(trials, catalog, contacts))
    enriched = add(
        "trial_payloads", audit.audit_enrich(audit.audit_slugs(matched), payloads), audit.TRIAL
    )
    fields = rebuilt("field_coverage", audit.field_coverage(matched))
    counted = add("people_coverage", audit.people_coverage(matched, people, enriched), by_market)
    placed = add("location_coverage", audit.location_coverage(matched, regions, enriched), by_market)
    gaps = rebuilt("gap_summary", audit.gap_summary(fields, counted, placed))
    scores = audit.run_scores(gaps, matched)
    history = sinks.read_or_none(spark, f"{root}/quality_score")
    if history is None:
        history = spark.createDataFrame([], TABLES["quality_score"])
    add("quality_score", audit.with_prior(scores, history), by_market)


def land_inputs(enriched: DataFrame, root: str, run_id: str, file_date: str) -> None:
    """Input rows with their payloads, replacing earlier rows of the same files (``landed`` reads them).

    The rows are computed once; the ledger gets the files, which never come to the driver.
    """
    spark = configure(enriched.sparkSession)
    rows = records.landing_rows(enriched, F.lit(run_id), F.lit(file_date).cast("date"))
    rows = conform(rows.withColumn("created_at", F.current_timestamp()), "landing")
    kept = Generations(spark, f"{root}/landing_runs", "source_file")
    generation = kept.next()
    written = kept.write("landing", rows, generation, by_key=False)
    kept.commit(written.groupBy("source_file").agg(F.count("*").alias("rows_landed")), generation)


def landed(spark: SparkSession, root: str) -> DataFrame:
    """Landed rows, each file as its last run left it."""
    return Generations(spark, f"{root}/landing_runs", "source_file").read("landing")


def record_run(
    spark: SparkSession, paths: list[str], payloads: DataFrame, root: str, run_id: str, file_date: str, kind: str,
) -> int:
    """One monitoring run over input files: load, mark repeats, attach payloads, upsert, land.

    ``kind`` is person or company; ``payloads`` comes from ``files.read_payload_cache`` or a
    table. Every step goes on from a stored table. The number of payload records added comes
    back; a run over the same files adds none and replaces its landing rows.
    """
    configure(spark)
    marked = sinks.stored(records.mark_duplicates(read_inputs(spark, paths), kind), f"{root}/current_{kind}_inputs")
    looked_up = sinks.stored(records.attach_payloads(marked, payloads), f"{root}/current_{kind}_payloads")
    known = sinks.read_or_none(spark, f"{root}/payloads")
    new = records.upsert_rows(looked_up, known, kind.upper())
    added = sinks.upsert_ignore(conform(new, "payloads"), f"{root}/payloads")
    land_inputs(looked_up, root, run_id, file_date)
    return added
