"""Trial audit: match, payloads, field, people and location coverage, gaps, score, views.

A trial is a domain of one run. Every step takes frames of any number of runs.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.functions import measure as M
from recordlens.functions import text as T
from recordlens.operators.matching import match_domains, usable_catalog
from recordlens.operators.rows import keep_top, left_join_sparse, mark_repeats
from recordlens.plans.customers import (
    MATCHED,
    UNMATCHED,
    catalog_fields,
    contact_summary,
    field_present,
)

TRIAL = ["trial_id", "run_id"]
FIELDS = {
    "name": "catalog_name",
    "website": "catalog_website",
    "linkedin": "catalog_linkedin",
    "industry": "catalog_industry",
    "founded_year": "catalog_founded_year",
    "hq_country": "catalog_hq_country",
    "company_type": "catalog_company_type",
    "phone": "catalog_phone",
    "email": "catalog_email",
}


def audit_input(rows: DataFrame) -> DataFrame:
    """Trials: rows in a valid state with a usable domain, one per domain and run.

    ``rows`` are ingested rows. Of rows with the same trial id the first one
    stays, as an insert that skips stored ids would have it.
    """
    trials = (
        rows.filter(F.col("sub_status").isin(*K.VALID_SUBSCRIPTION_STATES))
        .filter(F.col("customer_domain").isNotNull())
        .withColumn("run_id", T.run_id(F.col("run_date"), "T"))
        .withColumn("trial_id", T.md5_key(F.col("customer_domain"), F.col("run_id")))
    )
    order = [F.col("sub_created"), F.col("record_id"), F.col("sub_status"), F.col("seats").asc_nulls_last()]
    return keep_top(trials, TRIAL, order).select(
        *TRIAL, "run_date", F.col("customer_domain_raw").alias("domain_raw"),
        F.col("customer_domain").alias("domain"), "crm_name", "customer_id", "icp", "sub_status",
        "product_name", F.col("sub_plan_amount_aud").alias("plan_amount_aud"), "billing_country",
        "seats",
    )


def audit_match(
    trials: DataFrame,
    catalog: DataFrame,
    contacts: DataFrame,
    require_profile: bool = True,
    prefer_exact: bool = False,
) -> DataFrame:
    """Every trial with its catalog company, if any; unmatched trials stay."""
    usable = usable_catalog(catalog, require_profile)
    hits = match_domains(trials, usable, prefer_exact)
    profiles = (
        hits.join(catalog_fields(catalog), "catalog_id")
        .join(contact_summary(contacts), F.col("catalog_id") == F.col("company_id"), "left")
        .drop("company_id")
    )
    status = F.when(F.col("catalog_id").isNotNull(), MATCHED).otherwise(UNMATCHED)
    details = ["catalog_id", "catalog_hq_country", *FIELDS.values()]
    return trials.join(profiles, "domain", "left").select(
        *TRIAL, "run_date", "domain", "crm_name", "customer_id", status.alias("match_status"),
        *dict.fromkeys(details),
    )


def match_counts(matched: DataFrame) -> DataFrame:
    return matched.groupBy("run_id", "match_status").agg(F.count("*").alias("trials"))


def audit_slugs(matched: DataFrame) -> DataFrame:
    """Matched trials that have a company profile, with its slug."""
    slug = T.company_slug(F.col("catalog_linkedin"))
    return (
        matched.filter((F.col("match_status") == MATCHED) & F.col("catalog_linkedin").isNotNull())
        .select(*TRIAL, "run_date", "domain", "catalog_id", slug.alias("slug"))
    )


def audit_enrich(slugs: DataFrame, payloads: DataFrame) -> DataFrame:
    """Payload of each slug: 200 with its text, 404 without one, 409 for a repeat in a run.

    A cached answer counts only when it is a 200; anything else is a miss.
    """
    cached = (
        payloads.filter(F.col("status") == "200")
        .groupBy("slug")
        .agg(F.max("raw").alias("raw"))
        .withColumn("found", F.lit(True))
    )
    marked = mark_repeats(slugs, ["run_id", "slug"], "trial_id", "repeat", "409")
    # only the first row of a slug in a run is looked up, so no slug is hot in this join
    lookup = F.when(F.col("repeat").isNull() & (F.col("slug") != ""), F.col("slug"))
    joined = left_join_sparse(
        marked.withColumn("lookup", lookup), cached.withColumnRenamed("slug", "lookup"),
        "lookup", "trial_id",
    )
    status = F.coalesce("repeat", F.when(F.col("found"), "200").otherwise("404"))
    found = status == "200"
    return joined.select(
        *TRIAL, "run_date", "domain", "catalog_id", "slug",
        status.alias("payload_status"),
        F.when(found, F.col("raw")).alias("payload_raw"),
        F.when(found, F.col("slug")).alias("payload_slug"),
    )


def _field_measures() -> list:
    """Percent of the nine fields, number and names of the missing ones, from the columns of a match."""
    present = reduce(add, [M.flag(field_present(f, FIELDS)) for f in FIELDS])
    missing = F.array_compact(
        F.array(*[F.when(~field_present(f, FIELDS), F.lit(f)) for f in FIELDS])
    )
    return [
        M.pct(present, F.lit(len(FIELDS))).alias("field_coverage_pct"),
        (F.lit(len(FIELDS)) - present).alias("fields_missing_count"),
        missing.alias("missing_fields"),
    ]


def field_coverage(matched: DataFrame) -> DataFrame:
    """Flags of the nine fields, their percent and the names of the missing ones."""
    rows = matched.filter(F.col("match_status") == MATCHED)
    flags = {f: M.flag(field_present(f, FIELDS)) for f in FIELDS}
    return rows.select(
        *TRIAL, "run_date", "domain", "crm_name", "customer_id", "match_status", "catalog_id",
        *[c.alias(f"{f}_covered") for f, c in flags.items()],
        *_field_measures(),
    )


def _in_audit_markets(df: DataFrame) -> DataFrame:
    return df.filter(F.col("country_code").isin(*K.AUDIT_MARKETS))


def people_coverage(matched: DataFrame, people: DataFrame, enriched: DataFrame) -> DataFrame:
    """People per trial and market against the headcount of the payload.

    The headcount is that of the whole company in every market row; without a
    payload it is 0 and the percent unknown. People fold per company and market
    before they meet the trials.
    """
    counts = (
        _in_audit_markets(people)
        .groupBy("company_id", F.col("country_code").alias("market"))
        .agg(F.count("*").alias("people_count"))
    )
    heads = enriched.filter(F.col("payload_status") == "200").select(
        *TRIAL, T.payload_value(F.col("payload_raw"), "$.employee_count", "int").alias("headcount")
    )
    rows = (
        matched.filter(F.col("match_status") == MATCHED)
        .join(counts, F.col("catalog_id") == F.col("company_id"))
        .join(heads, TRIAL, "left")
    )
    headcount = F.coalesce("headcount", F.lit(0)).cast("bigint")
    share = M.clamp(M.pct(F.col("people_count"), headcount))
    return rows.select(
        *TRIAL, "run_date", "domain", "catalog_id", "market", "people_count",
        headcount.alias("headcount"),
        share.alias("employee_coverage_pct"),
        share.alias("people_coverage_pct"),
        F.greatest(headcount - F.col("people_count"), F.lit(0)).alias("people_gap"),
    )


def location_coverage(matched: DataFrame, regions: DataFrame, enriched: DataFrame) -> DataFrame:
    """Markets where the catalog or the payload has a trial's company.

    Both sides go into one union with a flag each; one aggregate per trial and
    market does the work of two distincts, a union and two joins.
    """
    trials = matched.select(*TRIAL, "run_date", "domain", "catalog_id", "match_status")
    places = (
        _in_audit_markets(regions)
        .groupBy("company_id", F.col("country_code").alias("market"))
        .agg(F.lit(True).alias("in_catalog"))
    )
    from_catalog = (
        trials.filter(F.col("match_status") == MATCHED)
        .join(places, F.col("catalog_id") == F.col("company_id"))
        .select(*TRIAL, "run_date", "domain", "catalog_id", "market",
                F.lit(True).alias("in_catalog"), F.lit(False).alias("in_payload"))
    )
    # as texts: an element that is no object, or whose address is none, has no country
    locations = F.from_json(T.json_text(F.col("payload_raw"), "$.locations"), "array<string>")
    from_payload = (
        enriched.filter(F.col("payload_status") == "200")
        .select(*TRIAL, "run_date", "domain", "catalog_id", F.explode(locations).alias("place"))
        .withColumn("market", F.upper(F.trim(T.json_text(F.col("place"), "$.address.country"))))
        .filter(F.col("market").isin(*K.AUDIT_MARKETS))
        .select(*TRIAL, "run_date", "domain", "catalog_id", "market",
                F.lit(False).alias("in_catalog"), F.lit(True).alias("in_payload"))
    )
    keys = [*TRIAL, "run_date", "domain", "catalog_id", "market"]
    return (
        from_catalog.unionByName(from_payload)
        .groupBy(*keys)
        .agg(
            F.max("in_catalog").alias("in_catalog_at_location"),
            F.max("in_payload").alias("payload_has_location"),
        )
        .withColumn(
            "location_gap", F.col("payload_has_location") & ~F.col("in_catalog_at_location")
        )
    )


def gap_summary(
    fields: DataFrame, people: DataFrame, locations: DataFrame, union_markets: bool = False
) -> DataFrame:
    """Field, people and location gaps side by side.

    Markets come from the people rows: a market known from locations only does
    not show, and a trial without people has one row with a NULL market and no
    location. ``union_markets`` takes the markets of both sides instead.
    """
    trial = Window.partitionBy(*TRIAL)
    placed = locations.select(
        *TRIAL, "market", "in_catalog_at_location", "payload_has_location", "location_gap",
        M.pct(
            F.sum(M.flag(F.col("in_catalog_at_location"))).over(trial),
            F.sum(M.flag(F.col("payload_has_location"))).over(trial),
        ).alias("location_coverage_pct"),
    )
    counted = people.select(
        *TRIAL, "market", "people_count", "headcount", "people_gap", "people_coverage_pct"
    )
    if union_markets:
        side = counted.join(placed, [*TRIAL, "market"], "full")
        joined = fields.join(side, TRIAL, "left")
    else:
        joined = fields.join(counted, TRIAL, "left").join(placed, [*TRIAL, "market"], "left")
    zero, no = F.lit(0), F.lit(False)
    return joined.select(
        *TRIAL, "run_date", "domain", "crm_name", "customer_id", "catalog_id", "market",
        "field_coverage_pct", "fields_missing_count", "missing_fields",
        F.coalesce("people_count", zero).alias("people_count"),
        "headcount",
        F.coalesce("people_gap", zero).alias("people_gap"),
        F.coalesce("people_coverage_pct", F.lit(0.0)).alias("people_coverage_pct"),
        F.coalesce("in_catalog_at_location", no).alias("in_catalog_at_location"),
        F.coalesce("payload_has_location", no).alias("payload_has_location"),
        F.coalesce("location_gap", no).alias("location_gap"),
        F.coalesce("location_coverage_pct", F.lit(0.0)).alias("location_coverage_pct"),
    )


def run_scores(gaps: DataFrame, matched: DataFrame) -> DataFrame:
    """Scores without a look at earlier runs; unmatched trials have fixed values."""
    parts = F.col("field_coverage_pct") + F.col("people_coverage_pct") + F.col("location_coverage_pct")
    scored = gaps.select(
        *TRIAL, "run_date", "domain", "crm_name", "customer_id", "catalog_id",
        F.lit(MATCHED).alias("match_status"), "market",
        "field_coverage_pct", "people_coverage_pct", "location_coverage_pct",
        M.clamp(F.round(parts / 3.0, 2)).alias("quality_score"),
        "fields_missing_count", "missing_fields", "people_gap",
        M.flag(F.col("location_gap")).alias("location_gap_count"),
    )
    zero = F.lit(0.0)
    absent = matched.filter(F.col("match_status") == UNMATCHED).select(
        *TRIAL, "run_date", "domain", "crm_name", "customer_id",
        F.lit(None).cast("string").alias("catalog_id"), "match_status",
        F.lit(None).cast("string").alias("market"),
        zero.alias("field_coverage_pct"), zero.alias("people_coverage_pct"),
        zero.alias("location_coverage_pct"), zero.alias("quality_score"),
        F.lit(len(FIELDS)).alias("fields_missing_count"),
        F.lit(None).cast("array<string>").alias("missing_fields"),
        F.lit(0).cast("bigint").alias("people_gap"), F.lit(0).alias("location_gap_count"),
    )
    return scored.unionByName(absent)


def _company_markets(people: DataFrame, regions: DataFrame) -> DataFrame:
    """``company_id, markets``: (market, people_count, in_catalog) of the audit markets of a company.

    One hash aggregate with a pair of states per market, so both tables are folded
    before one shuffle, and the array has an element per audit market at most.
    """
    market = F.col("country_code")
    rows = people.select("company_id", market, F.lit(True).alias("person")).unionByName(
        regions.select("company_id", market, F.lit(False).alias("person"))
    )
    states = [
        F.struct(
            F.lit(m).alias("market"),
            F.count_if((market == m) & F.col("person")).alias("people_count"),
            (F.count_if((market == m) & ~F.col("person")) > 0).alias("in_catalog"),
        ).alias(m)
        for m in K.AUDIT_MARKETS
    ]
    folded = rows.filter(market.isin(*K.AUDIT_MARKETS)).groupBy("company_id").agg(*states)
    held = F.filter(F.array(*K.AUDIT_MARKETS), lambda x: (x["people_count"] > 0) | x["in_catalog"])
    return folded.select("company_id", held.alias("markets"))


def _payload_facts(matched: DataFrame, payloads: DataFrame) -> DataFrame:
    """Headcount and markets from the payload of the first trial of each slug of a run; others have none."""
    slugs = audit_slugs(matched).filter((F.col("run_id") != "") & (F.col("slug") != ""))
    firsts = slugs.groupBy("run_id", "slug").agg(F.min("trial_id").alias("trial_id"))
    locations = F.from_json(T.json_text(F.col("raw"), "$.locations"), "array<string>")
    countries = F.transform(locations, lambda x: F.upper(F.trim(T.json_text(x, "$.address.country"))))
    facts = (
        payloads.filter(F.col("status") == "200")
        .groupBy("slug")
        .agg(F.max("raw").alias("raw"))
        .select(
            "slug",
            T.payload_value(F.col("raw"), "$.employee_count", "int").alias("headcount"),
            F.array_distinct(F.filter(countries, lambda x: x.isin(*K.AUDIT_MARKETS))).alias("payload_markets"),
        )
    )
    return firsts.join(facts, "slug").drop("slug")


def run_scores_at_once(
    matched: DataFrame, people: DataFrame, regions: DataFrame, payloads: DataFrame
) -> DataFrame:
    """``run_scores`` straight from the match, without the tables between.

    The stored run makes coverage and gap tables one by one, and each starts from
    the match. Where only scores are asked for, a trial gets its markets as one
    short array per company and its payload as one row of facts; the rows per
    market unfold from there. The match is used twice (rows, first trials of
    slugs), nothing is joined by trial and market, and there is no window.
    """
    spine = left_join_sparse(
        matched, _company_markets(people, regions).withColumnRenamed("company_id", "catalog_id"),
        "catalog_id", "trial_id",
    ).join(_payload_facts(matched, payloads), TRIAL, "left")
    none = F.array().cast("array<string>")
    placed = F.transform(F.filter("markets", lambda x: x["in_catalog"]), lambda x: x["market"])
    # a trial without people keeps one row, as its market is unknown
    rows = spine.select(
        *TRIAL, "run_date", "domain", "crm_name", "customer_id", "catalog_id", "match_status",
        *_field_measures(), "headcount",
        F.coalesce(placed, none).alias("placed"),
        F.coalesce("payload_markets", none).alias("payload_markets"),
        F.explode_outer(F.filter("markets", lambda x: x["people_count"] > 0)).alias("at"),
    )
    in_catalog = F.coalesce(F.array_contains("placed", F.col("at.market")), F.lit(False))
    in_payload = F.coalesce(F.array_contains("payload_markets", F.col("at.market")), F.lit(False))
    headcount = F.coalesce("headcount", F.lit(0)).cast("bigint")
    zero = F.lit(0.0)
    share = M.clamp(M.pct(F.col("at.people_count"), headcount))
    placed_share = F.when(
        in_catalog | in_payload, M.pct(F.size("placed"), F.size("payload_markets"))
    )
    measured = rows.select(
        "*", F.coalesce(share, zero).alias("people_coverage_pct"),
        F.coalesce(placed_share, zero).alias("location_coverage_pct"),
    )
    parts = F.col("field_coverage_pct") + F.col("people_coverage_pct") + F.col("location_coverage_pct")
    known = F.col("match_status") == MATCHED
    return measured.select(
        *TRIAL, "run_date", "domain", "crm_name", "customer_id", "catalog_id", "match_status",
        F.col("at.market").alias("market"),
        "field_coverage_pct", "people_coverage_pct", "location_coverage_pct",
        M.clamp(F.round(parts / 3.0, 2)).alias("quality_score"),
        "fields_missing_count", F.when(known, F.col("missing_fields")).alias("missing_fields"),
        F.coalesce(F.greatest(headcount - F.col("at.people_count"), F.lit(0)), F.lit(0)).alias("people_gap"),
        M.flag(in_payload & ~in_catalog).alias("location_gap_count"),
    )


def quality_score(gaps: DataFrame, matched: DataFrame, entity: str = "domain") -> DataFrame:
    """Score, band and change against the last earlier run of the same entity and market.

    ``entity`` names a trial over time. The domain is the same in every run; a
    trial id is not, and with ``entity="trial_id"`` every row is a first run.
    Unmatched trials have fixed values and no history.
    """
    return with_change(run_scores(gaps, matched), entity)


def with_change(scores: DataFrame, entity: str = "domain") -> DataFrame:
    """Band and change of score rows of any number of runs, as ``quality_score`` gives them."""
    known = F.col("match_status") == MATCHED
    history = scores.withColumn("known", known)
    w = Window.partitionBy(entity, "market", "known").orderBy("run_date", "run_id")
    prior = F.when(known, F.lag("quality_score").over(w))
    change = F.round(F.col("quality_score") - F.col("prev_quality_score"), 2)
    return (
        history.withColumn("prev_quality_score", prior)
        .withColumn("prev_run_id", F.when(known, F.lag("run_id").over(w)))
        .withColumn("quality_delta", change)
        .withColumn("quality_status", M.quality_band(F.col("quality_score")))
        .withColumn("direction", M.direction(F.col("quality_delta")))
        .drop("known")
    )


def with_prior(current: DataFrame, history: DataFrame, entity: str = "domain") -> DataFrame:
    """Change of the scores of one or more runs against each other and stored history.

    The prior score is that of the last earlier run of the same entity and market;
    NULL markets are equal here. Only matched trials have a history. Stored rows of
    the given runs are left out, so that a rerun gives the same. Of the runs before
    the first given one only the last row of each entity and market is joined in.
    """
    parts = [entity, "market", "run_date", "run_id", "quality_score"]
    days = current.agg(F.min("run_date").alias("first"), F.max("run_date").alias("last"))
    runs = current.select("run_id").distinct()
    old = (
        history.filter((F.col("match_status") == MATCHED) & (F.col("run_date") < days.select("last").scalar()))
        .join(runs, "run_id", "left_anti")
        .select(*parts)
    )
    first = days.select("first").scalar()
    before = (
        old.filter(F.col("run_date") < first)
        .groupBy(entity, "market")
        .agg(F.max(F.struct("run_date", "run_id", "quality_score")).alias("last"))
        .select(entity, "market", "last.*")
    )
    stored = before.unionByName(old.filter(F.col("run_date") >= first))
    rows = current.withColumns({"_known": F.col("match_status") == MATCHED, "_given": F.lit(True)}).unionByName(
        stored.withColumns({"_known": F.lit(True), "_given": F.lit(False)}), allowMissingColumns=True
    )
    w = Window.partitionBy(entity, "market", "_known").orderBy("run_date", "run_id")
    change = F.round(F.col("quality_score") - F.col("prev_quality_score"), 2)
    return (
        rows.withColumn("prev_run_id", F.when(F.col("_known"), F.lag("run_id").over(w)))
        .withColumn("prev_quality_score", F.when(F.col("_known"), F.lag("quality_score").over(w)))
        .filter("_given")
        .drop("_known", "_given")
        .withColumn("quality_delta", change)
        .withColumn("quality_status", M.quality_band(F.col("quality_score")))
        .withColumn("direction", M.direction(F.col("quality_delta")))
    )


def overall_run(scores: DataFrame) -> DataFrame:
    """One row per run; bands and directions count score rows, companies count once."""
    matched = F.col("match_status") == MATCHED
    per_trial = scores.groupBy(*TRIAL, "run_date").agg(
        F.max(M.flag(matched)).alias("is_matched"),
        F.count("*").alias("rows"),
        F.sum(F.when(matched, F.round(F.col("quality_score") * 100).cast("bigint"))).alias("points"),
        F.count_if(matched).alias("scored"),
        *[
            F.count_if(F.col("quality_status") == band).alias(_column(band))
            for band in _bands()
        ],
        *[
            F.count_if(F.col("direction") == d).alias(_column(d))
            for d in ("IMPROVED", "DECLINED", "STABLE", "FIRST_RUN")
        ],
    )
    total, hit = F.count("*"), F.sum("is_matched")
    # mean of two-digit scores, exact: points are hundredths
    n = F.nullif(F.sum("scored"), F.lit(0))
    mean = M.int_div(F.sum("points") * 2 + n, n * 2) / 100
    names = [*map(_column, _bands()), "improved_count", "declined_count", "stable_count", "first_run_count"]
    return per_trial.groupBy("run_id", "run_date").agg(
        total.alias("companies_audited"),
        hit.alias("matched_count"),
        (total - hit).alias("unmatched_count"),
        M.pct(hit, total).alias("matched_pct"),
        mean.alias("avg_quality_score"),
        *[F.sum(c).alias(c) for c in names],
    )


def _bands() -> list[str]:
    return [name for _, name in K.QUALITY_BANDS] + [K.LOWEST_BAND]


def _column(name: str) -> str:
    return name.lower().replace(" ", "_") + "_count"


def by_market(scores: DataFrame) -> DataFrame:
    return scores.groupBy("run_id", "market").agg(
        F.countDistinct("trial_id").alias("companies"),
        M.mean_pct(F.col("quality_score")).alias("avg_quality_score"),
        M.mean_pct(F.col("field_coverage_pct")).alias("avg_field_coverage"),
        M.mean_pct(F.col("people_coverage_pct")).alias("avg_people_coverage"),
        M.mean_pct(F.col("location_coverage_pct")).alias("avg_location_coverage"),
        F.sum("people_gap").alias("total_people_gap"),
        F.sum("location_gap_count").alias("total_location_gaps"),
    )


def dashboard(scores: DataFrame, trials: DataFrame) -> DataFrame:
    """Score rows with the attributes of their trial."""
    attributes = trials.select(
        *TRIAL, "icp", "product_name", "plan_amount_aud", "billing_country", "seats"
    )
    return scores.join(attributes, TRIAL, "left")
