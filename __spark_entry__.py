
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recordlens.functions import text as T  # noqa: E402
from recordlens.operators import sinks  # noqa: E402
from recordlens.operators.key_filters import insert_new  # noqa: E402
from recordlens.plans import audit, customers, emails, records, runs, weekly  # noqa: E402
from recordlens.session import work_dir  # noqa: E402
from recordlens.sources import files  # noqa: E402
from recordlens.sources import fixtures as fx  # noqa: E402
from recordlens.streaming.daily import Tables, run_daily, run_daily_files  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from recordlens.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

AS_OF = "2024-01-30"
RUN_DATES = [date for date, _ in fx.EMAIL_RUNS]


class Inputs:
    """The engine's input frames over one folder of the driver's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return fx.view(self.spark, self.sf_dir, f"f_{name}")

    def rows(self) -> DataFrame:
        return customers.ingest(self.subscription)

    def stored_rows(self) -> DataFrame:
        """Row table of an earlier load: the subscriptions active or ended."""
        return self.rows().filter(F.col("sub_status").isin("active", "canceled"))

    def staged(self) -> DataFrame:
        return customers.staging(self.rows(), self.catalog, self.contact, self.people)

    def trials(self) -> DataFrame:
        return audit.audit_input(self.rows())

    def matched(self) -> DataFrame:
        return audit.audit_match(self.trials(), self.catalog, self.contact)

    def matched_once(self) -> DataFrame:
        """The match as a table of its own, for queries that start from it several times."""
        return sinks.written_once(self.matched(), "match")

    def enriched(self, matched: DataFrame) -> DataFrame:
        return audit.audit_enrich(audit.audit_slugs(matched), self.payload)

    def people_cov(self, matched: DataFrame, enriched: DataFrame) -> DataFrame:
        return audit.people_coverage(matched, self.people, enriched)

    def location_cov(self, matched: DataFrame, enriched: DataFrame) -> DataFrame:
        return audit.location_coverage(matched, self.region, enriched)

    def gaps(self, matched: DataFrame) -> DataFrame:
        enriched = self.enriched(matched)
        return audit.gap_summary(
            audit.field_coverage(matched),
            self.people_cov(matched, enriched),
            self.location_cov(matched, enriched),
        )

    def scores(self, entity: str = "domain") -> DataFrame:
        rows = audit.run_scores_at_once(self.matched(), self.people, self.region, self.payload)
        return audit.with_change(rows, entity)

    def persons(self) -> DataFrame:
        return records.mark_duplicates(self.person_input, "person")

    def companies_in(self) -> DataFrame:
        return records.mark_duplicates(self.company_input, "company")

    def looked_up(self) -> DataFrame:
        return records.attach_payloads(self.companies_in(), self.payload)

    def stored_payloads(self) -> DataFrame:
        """Payload table of an earlier load: the slugs that answered 404."""
        old = self.payload.filter(F.col("status") == "404").select(
            F.lit("LN").alias("platform"), F.col("slug").alias("handle"),
            F.lit("PROFILE").alias("request_type"), F.lit("COMPANY").alias("profile_type"),
        )
        return old

    def summary(self, runs: int = 1) -> DataFrame:
        """Country summary of the last run, or of all three."""
        if runs == 1:
            return weekly.country_summary(
                self.company, self.email, self.deliverability, RUN_DATES[-1:]
            )
        history = fx.email_history(self.spark, self.sf_dir)
        deliv = fx.email_history(self.spark, self.sf_dir, "f_deliverability")
        return weekly.country_summary(self.company, history, deliv, RUN_DATES)

    def changes(self) -> DataFrame:
        return weekly.delta(self.summary(3))


def _flat(df: DataFrame) -> DataFrame:
    """Names of missing fields as one text, for comparison by value."""
    return df.withColumn("missing_fields", F.array_join("missing_fields", ","))


def _stream(i: Inputs) -> DataFrame:
    """Rows, staging and monitoring of a drained stream, counted per date."""
    tables = Tables(work_dir(i.spark, "stream"))
    name, exprs = fx.VIEWS["f_subscription"]
    schema = i.spark.read.parquet(f"{i.sf_dir}/{name}.parquet").schema
    source = (
        i.spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(i.sf_dir)
        .selectExpr(*exprs)
    )
    run_daily(source, tables, i.catalog, i.contact, i.people)
    return _loaded(i, tables)


def _loaded(i: Inputs, tables: Tables) -> DataFrame:
    rows = tables.read(i.spark, "rows").groupBy("run_date").agg(F.count("*").alias("rows_loaded"))
    monitored = customers.daily_readback(tables.read(i.spark, "monitoring"))
    return rows.join(monitored, "run_date")


def _drop(i: Inputs, folder: str, days: str = "true") -> str:
    """Daily CSV files of the exports, of the days that a condition names."""
    master = i.subscription_file.filter(days).select(*files.EXPORT_HEADS)
    sinks.split_by_day(master, folder, int(AS_OF[:4]), rows_per_file=20_000)
    return folder


def _file_rows(i: Inputs) -> DataFrame:
    """Exports split by day into CSV files, read back and cleaned."""
    read = files.read_exports(i.spark, _drop(i, work_dir(i.spark, "drop")), int(AS_OF[:4]))
    return customers.ingest(read, keep=("source_file",)).drop("sales_team_size")


def _file_stream(i: Inputs) -> DataFrame:
    """CSV files dropped in two rounds, the first day in both, and drained after each."""
    root, tables = work_dir(i.spark, "drop"), Tables(work_dir(i.spark, "stream"))
    for folder, days in (("one", "day(run_date) <= 15"), ("two", "day(run_date) > 15 or day(run_date) = 1")):
        _drop(i, f"{root}/{folder}", days)
        lines = files.stream_exports(i.spark, root)
        run_daily_files(lines, tables, i.catalog, i.contact, i.people, int(AS_OF[:4]))
    return _loaded(i, tables)


def _append_stored(i: Inputs) -> DataFrame:
    """Row table after an earlier load, a load of all rows and that load again."""
    path = f"{work_dir(i.spark, 'rows')}/rows"
    for batch in (i.stored_rows(), i.rows(), i.rows()):
        kept = batch.select("run_date", "record_id", "customer_domain", "sub_status")
        insert_new(kept, path, ["run_date", "record_id"])
    return i.spark.read.schema(kept.schema).parquet(path)


def _input_files(i: Inputs) -> str:
    """Company inputs as one CSV file per source file, in order of their rows."""
    root = work_dir(i.spark, "inputs")
    rows = i.company_input.select(
        "source_file", "row_no", F.col("source").alias("Provider"), F.col("company").alias("COMPANY NAME"),
        F.col("profile_link").alias("Person LinkedIn"),
    )
    ordered = rows.repartition("source_file").sortWithinPartitions("source_file", "row_no").drop("row_no")
    ordered.write.option("header", "true").option("escape", '"').partitionBy("source_file").csv(root)
    return root


def _file_marks(i: Inputs) -> DataFrame:
    marked = records.mark_duplicates(files.read_inputs(i.spark, [_input_files(i)], "*.csv"), "company")
    return marked.select("row_no", "company", "source", "slug", "status")


def _record_run(i: Inputs) -> DataFrame:
    """Two runs over the same input files; landed rows and, beside them, the payload records of both."""
    inputs, root = _input_files(i), work_dir(i.spark, "records")
    for _ in range(2):
        runs.record_run(i.spark, [inputs], i.payload, root, "F26.04.24", "2026-04-24", "company")
    added = sinks.table(i.spark, root, "payloads").select("row_no", "handle", "status_code")
    return runs.landed(i.spark, root).join(added, "row_no", "left").select(
        "run_id", "row_no", "company", "slug", "payload_status", "payload_raw", "handle", "status_code"
    )


_JOBS: dict[str, Callable[[Inputs], DataFrame]] = {
    # daily customer audit
    "cta_ingest": lambda i: customers.ingest(i.subscription, keep=("row_no",)),
    "cta_append_new": lambda i: customers.new_rows(i.rows(), i.stored_rows()).select(
        "run_date", "record_id", "customer_domain", "sub_status"
    ),
    "cta_append_stored": _append_stored,
    "cta_staging": lambda i: i.staged(),
    "cta_staging_prefer_exact": lambda i: customers.staging(
        i.rows(), i.catalog, i.contact, i.people, prefer_exact=True, keep_unkeyed=True
    ).select("run_date", "record_id", "customer_domain", "catalog_id"),
    "cta_summary_by_status": lambda i: customers.summary_by_status(i.staged()),
    "cta_monitoring": lambda i: customers.monitoring(i.staged()),
    "cta_monitoring_overall": lambda i: customers.monitoring_overall(i.staged()),
    "cta_daily_readback": lambda i: customers.daily_readback(customers.monitoring(i.staged())),
    "cta_missing_domains": lambda i: customers.missing_domains(i.staged()),
    "cta_weekly_missing": lambda i: customers.missing_in_window(i.staged(), AS_OF),
    "cta_missing_history": lambda i: customers.missing_in_window(i.staged(), AS_OF, None),
    "cta_duplicate_check": lambda i: customers.duplicate_check(i.staged()),
    "cta_duplicate_check_raw": lambda i: customers.duplicate_check(
        i.rows().unionAll(i.stored_rows())
    ),
    "cta_field_percent_by_month": lambda i: customers.field_percent_by_month(i.staged()),
    "cta_field_percent_long": lambda i: customers.field_percent_long(
        customers.field_percent_by_month(i.staged())
    ),
    # trial audit
    "audit_input": lambda i: i.trials(),
    "audit_match": lambda i: i.matched(),
    "audit_match_counts": lambda i: audit.match_counts(i.matched()),
    "audit_slugs": lambda i: audit.audit_slugs(i.matched()),
    "audit_enrich": lambda i: i.enriched(i.matched()),
    "audit_field_coverage": lambda i: _flat(audit.field_coverage(i.matched())),
    "audit_people_coverage": lambda i: i.people_cov(m := i.matched_once(), i.enriched(m)),
    "audit_location_coverage": lambda i: i.location_cov(m := i.matched_once(), i.enriched(m)),
    "audit_gap_summary": lambda i: _flat(i.gaps(i.matched_once())),
    "audit_quality_score": lambda i: _flat(i.scores()),
    "audit_quality_score_by_trial": lambda i: i.scores("trial_id").select(
        "trial_id", "market", "quality_score", "direction"
    ),
    "audit_overall_run": lambda i: audit.overall_run(i.scores()),
    "audit_by_market": lambda i: audit.by_market(i.scores()),
    "audit_dashboard": lambda i: _flat(audit.dashboard(i.scores(), i.trials())),
    # record monitoring
    "records_mark_duplicates": lambda i: i.persons().select("row_no", "source", "country", "slug", "status"),
    "records_mark_company_duplicates": lambda i: i.companies_in().select("row_no", "company", "slug", "status"),
    "records_duplicate_counts": lambda i: records.duplicate_counts(i.persons()),
    "records_status_counts": lambda i: records.status_counts(i.looked_up()),
    "records_payload_upsert": lambda i: records.upsert_rows(
        i.looked_up(), i.stored_payloads(), "COMPANY"
    ),
    "records_landing": lambda i: records.landing_rows(
        i.looked_up(), F.lit("F26.04.24"), F.lit("2026-04-24").cast("date")
    ),
    # e-mail profiles
    "email_rows_by_country": lambda i: emails.rows_by_country(i.email),
    "email_format": lambda i: emails.formats(i.email),
    "email_type": lambda i: emails.types(i.email),
    "email_type_by_country": lambda i: emails.types_by_country(i.email),
    "email_type_full_match": lambda i: emails.types_by_country(i.email, match="full"),
    "email_system_rate": lambda i: emails.system_rate(i.email),
    "email_verification": lambda i: emails.verification(i.email),
    "email_verification_by_country": lambda i: emails.verification_by_country(i.email),
    "email_verifier_status": lambda i: emails.verifier_status(i.email),
    "email_excessive": lambda i: emails.excessive(i.email),
    "email_duplicates": lambda i: emails.duplicates(i.email),
    "email_shared": lambda i: emails.shared(i.email),
    "email_top_shared": lambda i: emails.top_shared(i.email),
    "email_enabled": lambda i: emails.enabled(i.email),
    "email_deliverability": lambda i: emails.deliverability(i.deliverability),
    "email_deliverability_by_country": lambda i: emails.deliverability_by_country(i.deliverability),
    "email_source": lambda i: emails.sources(i.email),
    "email_source_breakdown": lambda i: emails.source_breakdown(
        fx.email_history(i.spark, i.sf_dir)
    ),
    # e-mails and the company hub
    "email_coverage_any": lambda i: emails.coverage(i.company, i.email, "any"),
    "email_coverage_market_set": lambda i: emails.coverage(i.company, i.email, "market_set"),
    "email_coverage_hq": lambda i: emails.coverage(i.company, i.email, "hq"),
    "email_fqdn_gap_any": lambda i: emails.fqdn_gap(i.company, i.email, "any"),
    "email_fqdn_gap_market_set": lambda i: emails.fqdn_gap(i.company, i.email, "market_set"),
    "email_fqdn_gap_hq": lambda i: emails.fqdn_gap(i.company, i.email, "hq"),
    "email_domain_mismatch_any": lambda i: emails.domain_mismatch(i.company, i.email, "any", 20),
    "email_domain_mismatch_market_set": lambda i: emails.domain_mismatch(i.company, i.email, "market_set"),
    "email_domain_mismatch_hq": lambda i: emails.domain_mismatch(i.company, i.email, "hq"),
    # weekly refresh
    "email_country_summary": lambda i: i.summary(),
    "email_global_summary": lambda i: weekly.global_summary(i.company, i.summary()),
    "email_issues_long": lambda i: weekly.issues_long(i.summary()),
    "email_issue_pivot": lambda i: weekly.issue_pivot(weekly.issues_long(i.summary())),
    "email_delta": lambda i: i.changes(),
    "email_delta_first_run": lambda i: weekly.delta(i.summary()),
    "email_open_issues": lambda i: weekly.open_issues(i.changes()),
    "email_changes": lambda i: weekly.resolved(i.changes()),
    "email_improved_weeks": lambda i: weekly.improved_weeks(i.changes()),
    "email_trend": lambda i: weekly.trend(weekly.global_summary(i.company, i.summary(3))),
    "email_country_score": lambda i: weekly.country_score(i.summary()),
    "email_alerts": lambda i: weekly.alerts(i.summary()),
    "email_regression_alerts": lambda i: weekly.regression_alerts(i.summary(3)),
    # publishing rules
    "email_quality_gate": lambda i: emails.quality_gate(i.company, i.email, i.deliverability),
    "email_quality_gate_open": lambda i: emails.quality_gate(
        i.company, i.email, i.deliverability, require_enabled=False,
        exceptions=i.company.filter(F.col("hq_country") == "KR").select("id", F.lit("other").alias("root")),
    ),
    "email_top_per_company": lambda i: emails.top_per_company(i.email, i.deliverability),
    "email_dedupe_shared": lambda i: emails.dedupe_shared(i.company, i.email),
    "email_suppress": lambda i: emails.suppress(i.email, i.deliverability),
    "email_verifier_queue": lambda i: emails.verifier_queue(i.email),
    # files and streams of files
    "stream_daily_ingest": _stream,
    "stream_file_drop": _file_stream,
    "files_export_rows": _file_rows,
    "files_input_marks": _file_marks,
    "records_run": _record_run,
}


def entry(spark: SparkSession) -> DataFrame:
    """Daily monitoring of customer coverage on the smallest tables."""
    return _JOBS["cta_monitoring"](Inputs(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(job):
        return lambda spark, sf_dir: job(Inputs(spark, sf_dir))

    jobs = {name: bind(job) for name, job in _JOBS.items()}
    if llm is not None:
        jobs |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return jobs


def oracle_sql() -> dict[str, str]:
    from oracles import all_queries

    sql = all_queries()
    if llm is not None:
        sql |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
