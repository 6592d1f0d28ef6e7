"""Weekly e-mail refresh: country summary, global row, issues, changes, trend, alerts.

Every frame carries ``run_date``. The base tables may hold one run or several;
all runs go through one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.functions import email as E
from recordlens.functions import measure as M
from recordlens.functions import text as T
from recordlens.operators.rows import stack
from recordlens.plans.emails import in_markets
from recordlens.schemas import SUMMARY_COUNTS

MARKETS = K.EMAIL_MARKETS
RUN = ["run_date", "country"]

# percent -> (part, whole)
PERCENTS = {
    "pct_with_email": ("with_email", "total_companies"),
    "pct_missing": ("missing_email", "total_companies"),
    "pct_fqdn_no_email": ("has_fqdn_no_email", "companies_with_fqdn"),
    "pct_specific": ("specific_company", "total_email_rows"),
    "pct_generic": ("generic_role_based", "total_email_rows"),
    "pct_system_blocked": ("system_blocked", "total_email_rows"),
    "pct_free_provider": ("free_provider", "total_email_rows"),
    "pct_unverified": ("unverified", "all_rows"),
    "pct_undeliverable": ("undeliverable", "deliv_rows"),
    "pct_not_checked": ("not_checked", "deliv_rows"),
    "pct_mismatch": ("domain_mismatch", "domain_pairs"),
    "pct_gt5": ("companies_gt5_emails", "company_country_pairs"),
}


def spine(emails: DataFrame, run_dates: list[str]) -> DataFrame:
    """Every market of every run, also those without data."""
    rows = ", ".join(f"(DATE '{d}', '{c}')" for d in run_dates for c in MARKETS)
    return emails.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(run_date, country)")


def _company_rows(companies: DataFrame, run_dates: list[str]) -> DataFrame:
    """Rows of the head-office markets, once per run, keyed as the e-mails are in ``_facts``."""
    host = T.has_text(F.col("fqdn")) & F.col("fqdn").contains(".")
    dates = F.array(*[F.lit(d).cast("date") for d in run_dates])
    return in_markets(companies, "hq_country").filter("id is not null").select(
        F.explode(dates).alias("run_date"), "id", F.col("hq_country").alias("country"),
        F.when(host, T.domain_root(F.col("fqdn"))).otherwise("").alias("root"),
        F.lit(1).alias("hub"),
        T.has_text(F.col("fqdn")).cast("int").alias("has_fqdn"),
        host.cast("int").alias("host"),
    )


def _facts(companies: DataFrame, emails: DataFrame, run_dates: list[str]) -> DataFrame:
    """Types, verification, excess, coverage, host gap and domain pairs per run and market, in one pass over the e-mails.

    Companies are rows of the same aggregate as the e-mails, so nothing is joined. Rows
    fold by (run, company, country, domain root), where a host meets the addresses that
    share its root; then by (run, company, country), where the market of the head office
    meets its addresses; then by (run, country). Each fold has a map-side part, so a
    company or country with most rows is a few rows per task.
    """
    email, status = F.col("email"), F.trim("verification_status")
    market = F.col("country").isin(*MARKETS)
    # each pattern runs once per row: the classes are columns before they are counted
    tested = emails.select(
        "run_date", "country", "id", "verification_status",
        market.alias("market"),
        email.isNotNull().alias("present"),
        T.has_text(email).alias("text"),
        (market & E.is_well_formed(email)).alias("formed"),
        (market & E.is_system(email)).alias("system"),
        (market & E.is_free(email, "regional")).alias("free"),
        (market & E.is_generic(email, "regional")).alias("generic"),
        (market & email.contains("@")).alias("address"),
        F.when(market & email.contains("@"), T.email_root(email)).otherwise("").alias("root"),
    )
    tested = tested.unionByName(_company_rows(companies, run_dates), allowMissingColumns=True)
    ours = F.col("hub").isNull() & F.col("market")
    formed, system, free, generic = map(F.col, ("formed", "system", "free", "generic"))
    rest = formed & ~system & ~free
    # a system address at a free provider counts under both
    kinds = {
        "specific_company": rest & ~generic,
        "generic_role_based": rest & generic,
        "system_blocked": formed & system,
        "free_provider": formed & free,
    }
    states = {s.lower().replace(" ", "_"): s for s in K.VERIFICATION_STATES}
    plain = ["all_rows", "unverified", *states]
    count = F.count_if
    rooted = tested.groupBy("run_date", "country", "id", "root").agg(
        count(ours).alias("all_rows"),
        count("text").alias("texts"),
        count("present").alias("present"),
        count(~F.col("present")).alias("absent"),
        count(formed).alias("formed"),
        *[count(condition).alias(k) for k, condition in kinds.items()],
        count(ours & T.is_blank(F.col("verification_status"))).alias("unverified"),
        *[count(ours & (status == s)).alias(k) for k, s in states.items()],
        count("address").alias("addresses"),
        F.count("hub").alias("hub"),
        F.max("has_fqdn").alias("has_fqdn"),
        F.coalesce(F.sum("host"), F.lit(0)).alias("hosts"),
    )
    shared = F.when(F.col("root") != "", F.col("addresses") * F.col("hosts")).otherwise(0)
    sums = ["all_rows", "texts", "present", "absent", "formed", *kinds, *plain[1:], "hub"]
    folded = rooted.groupBy("run_date", "country", "id").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max("has_fqdn").alias("has_fqdn"),
        (F.sum("addresses") * F.sum("hosts")).alias("pairs"),
        F.sum(shared).alias("matches"),
    )
    # texts of a company in any country: one row per country of the company at most
    anywhere = F.sum("texts").over(Window.partitionBy("run_date", "id"))
    folded = folded.withColumn("texts_anywhere", anywhere).filter(F.col("country").isin(*MARKETS))
    hub, fqdn = F.col("hub") > 0, F.col("has_fqdn") == 1
    here, present, absent = F.col("texts") > 0, F.col("present") > 0, F.col("absent") > 0
    # without a single row, or well-formed row, the counts of a country are unknown
    some, some_formed, some_pairs = (F.sum(c) > 0 for c in ("all_rows", "formed", "pairs"))
    return folded.groupBy(*RUN).agg(
        F.when(some_formed, F.sum("formed")).alias("total_email_rows"),
        *[F.when(some_formed, F.sum(c)).alias(c) for c in kinds],
        *[F.when(some, F.sum(c)).alias(c) for c in plain],
        F.when(some, count(F.col("all_rows") > 0)).alias("company_country_pairs"),
        F.when(some, count(F.col("texts") > K.MAX_EMAILS_PER_COMPANY)).alias("companies_gt5_emails"),
        count(hub & here).alias("with_email"),
        count(hub & ~here & (F.col("texts_anywhere") > 0)).alias("has_email_other_market"),
        count(fqdn & present).alias("has_fqdn_with_email"),
        count(fqdn & present & ~absent).alias("fqdn_only_present"),
        F.when(some_pairs, F.sum("pairs")).alias("domain_pairs"),
        F.when(some_pairs, F.sum("matches")).alias("domain_match"),
        F.when(some_pairs, F.sum("pairs") - F.sum("matches")).alias("domain_mismatch"),
    )


def _totals(companies: DataFrame, runs: DataFrame) -> DataFrame:
    """Companies of each market and how many of them have a host name."""
    hub = in_markets(companies, "hq_country").groupBy("id", "hq_country").agg(
        F.max(T.has_text(F.col("fqdn"))).alias("has_fqdn")
    )
    totals = hub.groupBy(F.col("hq_country").alias("country")).agg(
        F.count("*").alias("total_companies"), F.count_if(F.col("has_fqdn")).alias("fqdns")
    )
    return runs.join(totals, "country").select(*RUN, "total_companies", "fqdns")


def _with_gaps(sets: DataFrame) -> DataFrame:
    """The counts that are set against the totals; unknown in a market without companies (with a host name)."""
    of = lambda whole, c: F.when(F.col(whole) > 0, F.coalesce(F.col(c), F.lit(0)))
    return sets.withColumns({
        "with_email": of("total_companies", "with_email"),
        "missing_email": F.col("total_companies") - of("total_companies", "with_email"),
        "has_email_other_market": of("total_companies", "has_email_other_market"),
        "companies_with_fqdn": F.when(F.col("fqdns") > 0, F.col("fqdns")),
        "has_fqdn_no_email": F.col("fqdns") - of("fqdns", "fqdn_only_present"),
        "has_fqdn_with_email": of("fqdns", "has_fqdn_with_email"),
    })


def _deliverability_set(deliv: DataFrame) -> DataFrame:
    state = F.col("deliverability")
    return in_markets(deliv).groupBy(*RUN).agg(
        F.count("*").alias("deliv_rows"),
        F.count_if(state == K.UNDELIVERABLE).alias("undeliverable"),
        F.count_if(state == "em-av-highly-likely").alias("deliv_highly_likely"),
        F.count_if(state == "em-av-likely").alias("deliv_likely"),
        F.count_if(state == "em-av-unsure").alias("deliv_unsure"),
        F.count_if(state.isNull()).alias("not_checked"),
    )


def country_summary(
    companies: DataFrame, emails: DataFrame, deliv: DataFrame, run_dates: list[str]
) -> DataFrame:
    """One row per run and market with all counts and percents."""
    runs = spine(emails, run_dates)
    sets = _with_gaps(stack(
        RUN, runs, _totals(companies, runs), _facts(companies, emails, run_dates), _deliverability_set(deliv)
    ))
    shares = [M.pct(F.col(a), F.col(b)).alias(p) for p, (a, b) in PERCENTS.items()]
    return sets.join(runs, RUN, "left_semi").select(*RUN, *SUMMARY_COUNTS, *shares)


def global_summary(companies: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per run: company counts and the score weighted over the three means.

    The means weigh every market the same, whatever its size.
    """
    market = F.col("hq_country").isin(*MARKETS)
    # one row per (company, kind) first: a distinct count without a wide expand
    kinds = companies.groupBy("id").agg(
        F.max(F.coalesce(market, F.lit(False))).alias("in_markets"),
        F.max(F.col("hq_country").isNull()).alias("no_location"),
    )
    totals = kinds.agg(
        F.count("*").alias("all"),
        F.count_if(F.col("in_markets")).alias("markets"),
        F.count_if(F.col("no_location")).alias("none"),
    )
    counts = totals.select(F.struct("*").alias("t")).scalar()

    def mean(name: str) -> Column:
        """Exact mean of a two-digit percent, not rounded."""
        return F.sum(F.round(F.col(name) * 100).cast("bigint")) / F.count(name) / 100

    means = summary.groupBy("run_date").agg(
        F.sum("total_companies").alias("total_company_country_recs"),
        mean("pct_with_email").alias("coverage"),
        (F.lit(100) - mean("pct_mismatch")).alias("accuracy"),
        mean("pct_specific").alias("consistency"),
    ).withColumn("t", counts)
    other = F.col("t.all") - F.col("t.markets") - F.col("t.none")
    return means.select(
        "run_date",
        F.col("t.all").alias("total_distinct_companies"),
        F.col("t.markets").alias("total_markets_13"),
        F.col("t.none").alias("total_no_location"),
        other.alias("other_markets"),
        "total_company_country_recs",
        M.weighted_score(F.col("coverage"), F.col("accuracy"), F.col("consistency")).alias(
            "overall_quality_score"
        ),
        M.round2(F.col("coverage")).alias("avg_coverage_pct"),
        M.round2(F.col("accuracy")).alias("avg_accuracy_pct"),
        M.round2(F.col("consistency")).alias("avg_consistency_pct"),
    )


def issues_long(summary: DataFrame) -> DataFrame:
    """One row per run, market and issue, from one scan of the summary."""
    rows = F.array(*[
        F.struct(
            F.lit(category).alias("category"),
            F.lit(issue).alias("issue"),
            F.col(part).alias("affected"),
            M.pct(F.col(part), F.col(whole)).alias("pct_affected"),
        )
        for category, issue, part, whole, *_ in K.ISSUES
    ])
    return summary.select(*RUN, "total_companies", "total_email_rows", F.inline(rows)).withColumn(
        "severity", M.severity(F.col("pct_affected"))
    )


def issue_pivot(issues: DataFrame) -> DataFrame:
    """Affected rows per market, one column per issue."""
    names = [i[1] for i in K.ISSUES]
    wide = issues.groupBy(*RUN).pivot("issue", names).agg(F.sum("affected"))
    slug = lambda n: n.lower().replace(" ", "_").replace("-", "_")
    return wide.select(*RUN, *[F.col(f"`{n}`").alias(slug(n)) for n in names])


def delta(summary: DataFrame) -> DataFrame:
    """Change of every issue from a market's previous run; none on the first run.

    The counts of verification and deliverability are set against well-formed
    e-mail rows, as in the score; the impact has no sign.
    """
    before = Window.partitionBy("country").orderBy("run_date")
    rows = F.array(*[
        F.struct(
            F.lit(category).alias("category"),
            F.lit(issue).alias("issue"),
            F.lag(part).over(before).alias("prev_count"),
            F.col(part).alias("curr_count"),
            F.lag(base).over(before).alias("base"),
            F.lit(cause).alias("root_cause"),
            F.lit(weight).alias("weight"),
        )
        for category, issue, part, _, base, cause, weight in K.ISSUES
    ])
    prior = F.lag("run_date").over(before)
    change = F.col("curr_count") - F.col("prev_count")
    return (
        summary.select(*RUN, prior.alias("prior_run"), rows.alias("rows"))
        .filter(F.col("prior_run").isNotNull())
        .select(*RUN, F.inline("rows"))
        .select(
            *RUN, "category", "issue", "prev_count", "curr_count",
            change.alias("delta"),
            M.signed_pct(change, F.col("prev_count")).alias("delta_pct"),
            F.when(change < 0, "IMPROVED").when(change > 0, "WORSENED").otherwise("NO CHANGE")
            .alias("direction"),
            "root_cause",
            M.pct(F.abs(change) * F.col("weight"), F.col("base") * 10).alias("score_impact"),
        )
    )


def _latest(df: DataFrame) -> DataFrame:
    """Rows of the last run; every market has rows in every run."""
    last = F.max("run_date").over(Window.partitionBy("country"))
    return df.withColumn("_last", last).filter(F.col("run_date") == F.col("_last")).drop("_last")


def open_issues(changes: DataFrame) -> DataFrame:
    """Issues of the latest run that did not improve."""
    return _latest(changes).filter(F.col("direction") != "IMPROVED").select(
        *RUN, "issue", "category", "curr_count", "direction", "root_cause", "score_impact"
    )


def resolved(changes: DataFrame) -> DataFrame:
    """Issues that improved, with the number of records put right."""
    done = F.when(F.col("direction") == "IMPROVED", "Done").otherwise("Pending")
    return changes.filter(F.col("direction") == "IMPROVED").select(
        *RUN, "issue", F.abs("delta").alias("resolved"), "root_cause", "score_impact",
        done.alias("status"),
    )


def improved_weeks(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("direction") == "IMPROVED").select("run_date").distinct()


def trend(global_rows: DataFrame) -> DataFrame:
    """Scores of each run, of the run before, and the change."""
    names = ["overall_quality_score", "avg_coverage_pct", "avg_accuracy_pct", "avg_consistency_pct"]
    long = global_rows.unpivot(["run_date"], names, "metric", "current")
    prior = F.lag("current").over(Window.partitionBy("metric").orderBy("run_date"))
    return long.withColumn("prior", prior).withColumn(
        "change", F.round(F.col("current") - F.col("prior"), 2)
    )


def country_score(summary: DataFrame) -> DataFrame:
    accuracy = F.lit(100) - F.col("pct_mismatch")
    return summary.select(
        *RUN, "pct_with_email", accuracy.alias("accuracy_pct"), "pct_specific",
        M.weighted_score(F.col("pct_with_email"), accuracy, F.col("pct_specific")).alias(
            "quality_score"
        ),
    )


def alerts(summary: DataFrame) -> DataFrame:
    """Release thresholds that a market of the latest run breaches."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("alert"),
            F.col(metric).alias("value"),
            F.lit(limit).alias("limit_value"),
            ((F.col(metric) < limit) if side == "below" else (F.col(metric) > limit)).alias("breach"),
        )
        for name, metric, side, limit in K.RELEASE_ALERTS
    ])
    return _latest(summary).select(*RUN, F.inline(rows)).filter("breach").drop("breach")


def regression_alerts(summary: DataFrame) -> DataFrame:
    """Limits per market and drops against the previous run."""
    before = Window.partitionBy("country").orderBy("run_date")
    drop = F.round(F.lag("pct_with_email").over(before) - F.col("pct_with_email"), 2)
    rows = [
        (F.col("country") == c, f"coverage_drop_{c}", F.col("drop"), limit)
        for c, limit in K.COVERAGE_DROP_LIMITS
    ]
    rows += [
        (F.col("country") == c, f"domain_mismatch_{c}", F.col("pct_mismatch"), limit)
        for c, limit in K.MISMATCH_WATCH
    ]
    rows.append((F.lit(True), "generic_role_based", F.col("pct_generic"), K.GENERIC_LIMIT))
    checks = F.array(*[
        F.struct(
            F.lit(name).alias("alert"),
            value.alias("value"),
            F.lit(limit).alias("limit_value"),
            (who & (value > limit)).alias("breach"),
        )
        for who, name, value, limit in rows
    ])
    return (
        summary.select(*RUN, "pct_mismatch", "pct_generic", drop.alias("drop"))
        .select(*RUN, F.inline(checks))
        .filter("breach")
        .drop("breach")
    )
