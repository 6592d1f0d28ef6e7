"""Daily customer audit: ingest, staging against the catalog, summaries, missing domains.

All run dates go through one plan; ``run_date`` is in every key.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.functions import measure as M
from recordlens.functions import text as T
from recordlens.operators.matching import match_domains, usable_catalog
from recordlens.operators.rows import keep_top, left_join_sparse

MATCHED, UNMATCHED = "MATCHED", "UNMATCHED"

# field -> staging column; numbers count as present when not NULL
FIELDS = {
    "name": "catalog_name",
    "website": "catalog_website",
    "linkedin": "catalog_linkedin",
    "industry": "catalog_industry",
    "founded_year": "catalog_founded_year",
    "hq_country": "catalog_hq_country",
    "employee_count": "catalog_employee_count",
    "company_size": "catalog_company_size",
    "revenue": "catalog_revenue",
    "phone": "catalog_phone",
    "email": "catalog_email",
}
NUMERIC_FIELDS = ("founded_year", "employee_count")
GROUPS = {
    "identity": ("name", "website"),
    "social": ("linkedin",),
    "firmographics": ("industry", "founded_year", "hq_country"),
    "size": ("employee_count", "company_size", "revenue"),
    "contact": ("phone", "email"),
    "avg_field": tuple(FIELDS),
}
PERIOD = ["run_date", "run_year", "run_quarter", "run_month", "run_month_name"]


def ingest(export: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned, typed and keyed rows of an export read as text, with its run_date.

    No row is dropped: a row without a usable domain keeps a NULL domain.
    """
    heads = [head for head, *_ in K.EXPORT_COLUMNS]
    trimmed = export.select("run_date", *keep, *[T.strip(F.col(h)).alias(h) for h in heads])
    kinds = {"text": lambda c: c, "int": T.safe_int, "float": T.safe_float}
    typed = [kinds[kind](F.col(head)).alias(name) for head, name, kind in K.EXPORT_COLUMNS]
    rows = trimmed.select("run_date", *keep, *typed).withColumn(
        "customer_domain", T.clean_domain(F.col("customer_domain_raw"))
    )
    return rows.withColumn(
        "record_id",
        T.md5_key(F.col("customer_domain"), F.col("sub_created"), F.col("customer_id")),
    )


def new_rows(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of the batch whose key is not stored for their run date.

    Rows that repeat a key within the batch all stay.
    """
    keys = ["run_date", "record_id"]
    return batch.join(existing.select(*keys).distinct(), keys, "left_anti")


def contact_summary(contacts: DataFrame) -> DataFrame:
    return contacts.groupBy("company_id").agg(
        F.max("primary_phone").alias("catalog_phone"),
        F.max("primary_email").alias("catalog_email"),
    )


def people_of_profiles(profiles: DataFrame) -> DataFrame:
    """(id, company_id) of people whose company is a JSON object with an ``id``."""
    company = T.json_text(F.col("current_company"), "$.id")
    return profiles.select("id", company.alias("company_id"))


def people_summary(people: DataFrame) -> DataFrame:
    return (
        people.filter(F.col("company_id").isNotNull())
        .groupBy("company_id")
        .agg(F.count("id").alias("people_count"))
    )


def catalog_fields(catalog: DataFrame) -> DataFrame:
    """Audited fields of the catalog; stand-in texts for missing values become NULL."""
    return catalog.select(
        F.col("id").alias("catalog_id"),
        F.col("name").alias("catalog_name"),
        F.col("website").alias("catalog_website"),
        F.col("fqdn").alias("catalog_fqdn"),
        T.json_text(F.col("social_media"), "$.linkedin").alias("catalog_linkedin"),
        T.unless(T.first_map_value(F.col("industries")), K.NO_INDUSTRY).alias("catalog_industry"),
        F.col("year_founded").cast("int").alias("catalog_founded_year"),
        F.col("hq_country").alias("catalog_hq_country"),
        F.col("company_type").alias("catalog_company_type"),
        T.unless(T.first_map_value(F.col("company_size")), K.NO_DATA).alias("catalog_company_size"),
        T.unless(T.first_map_value(F.col("revenue")), K.NO_DATA).alias("catalog_revenue"),
        F.col("employee_count").cast("int").alias("catalog_employee_count"),
    )


def latest_per_domain(rows: DataFrame, keep_unkeyed: bool = False) -> DataFrame:
    """One row per day and domain, the latest subscription.

    The raw text stands in for a missing domain, and all rows of a day with
    neither form one customer, unless ``keep_unkeyed`` is set. A row without a
    creation time counts as latest.
    """
    key = F.lower(F.trim(F.coalesce("customer_domain", "customer_domain_raw")))
    if keep_unkeyed:
        alone = F.concat(F.lit("\x00"), F.col("record_id"))
        key = F.coalesce(F.nullif(key, F.lit("")), alone)
    order = [
        F.col("sub_created").desc_nulls_first(),
        F.col("record_id").desc(),
        F.col("sub_status").desc_nulls_last(),
        F.col("seats").desc_nulls_last(),
    ]
    return keep_top(rows, ["run_date", key], order)


def staging(
    rows: DataFrame,
    catalog: DataFrame,
    contacts: DataFrame,
    people: DataFrame,
    prefer_exact: bool = False,
    keep_unkeyed: bool = False,
) -> DataFrame:
    """One row per day and customer domain with its catalog company, if any."""
    latest = latest_per_domain(rows, keep_unkeyed)
    usable = usable_catalog(catalog)
    # the latest rows hold the same domains; asking all rows spares their sort
    domains = rows.select(F.col("customer_domain").alias("domain"))
    hits = match_domains(domains, usable, prefer_exact)
    # company details meet the few matched domains, then the customers once
    profiles = (
        hits.join(catalog_fields(catalog), "catalog_id")
        .join(contact_summary(contacts), F.col("catalog_id") == F.col("company_id"), "left")
        .drop("company_id")
        .join(people_summary(people), F.col("catalog_id") == F.col("company_id"), "left")
        .drop("company_id", "catalog_company_type")
        .withColumnRenamed("domain", "customer_domain")
    )
    joined = left_join_sparse(latest, profiles, "customer_domain", "record_id")
    staged = keep_top(
        joined,
        ["run_date", "record_id"],
        [F.col("catalog_id").asc_nulls_last(), F.col("customer_domain_raw").asc_nulls_last()],
    )
    status = F.when(F.col("catalog_id").isNotNull(), MATCHED).otherwise(UNMATCHED)
    dropped = ["monthly_credits", "sales_team_size", "currency"]
    return staged.drop(*dropped).select(
        "*", *T.date_parts(F.col("run_date")), status.alias("match_status")
    )


def field_present(field: str, columns: dict[str, str] = FIELDS) -> Column:
    c = F.col(columns[field])
    return c.isNotNull() if field in NUMERIC_FIELDS else T.has_text(c)


def _coverage(matched: Column) -> list[Column]:
    """Percent of present fields over matched rows, per group.

    The mean over rows of the share of present fields is the sum of flags over
    rows times fields, all whole numbers.
    """
    out = []
    for group, fields in GROUPS.items():
        present = reduce(add, [M.flag(field_present(f)) for f in fields])
        total = F.sum(F.when(matched, present))
        rows = F.sum(F.when(matched, F.lit(len(fields))))
        out.append(M.pct(total, rows).alias(f"{group}_coverage_pct"))
    with_people = matched & (F.col("people_count") > 0)
    share = M.pct(F.count_if(with_people), F.count_if(matched))
    return [*out, share.alias("people_coverage_pct")]


def _counts() -> list[Column]:
    matched = F.col("match_status") == MATCHED
    return [
        F.count("*").alias("total_customers"),
        F.count_if(matched).alias("matched_count"),
        F.count_if(~matched).alias("unmatched_count"),
        M.pct(F.count_if(matched), F.count("*")).alias("matched_pct"),
        *_coverage(matched),
        F.sum(F.coalesce("people_count", F.lit(0))).alias("total_people"),
    ]


def summary_by_status(staged: DataFrame) -> DataFrame:
    return staged.groupBy(*PERIOD, "sub_status").agg(*_counts())


def _monitoring(staged: DataFrame, keys: list[str]) -> DataFrame:
    matched = F.col("match_status") == MATCHED
    active = F.col("sub_status") == "active"
    people = F.col("people_count") > 0
    return staged.groupBy(*keys).agg(
        *_counts(),
        F.countDistinct("catalog_hq_country").alias("total_markets"),
        F.count_if(matched & people).alias("matched_with_people_count"),
        F.count_if(active & matched).alias("active_matched_count"),
        F.count_if(active & ~matched).alias("active_unmatched_count"),
        F.count_if(active & matched & people).alias("active_matched_with_people_count"),
    )


def monitoring(staged: DataFrame) -> DataFrame:
    """Daily roll-up per status: the active counts are 0 but in the 'active' row."""
    return _monitoring(staged, [*PERIOD, "sub_status"])


def monitoring_overall(staged: DataFrame) -> DataFrame:
    """Daily roll-up over all statuses, each customer weighing the same."""
    return _monitoring(staged, PERIOD)


def daily_readback(monitored: DataFrame) -> DataFrame:
    """One row per date from the per-status rows.

    Markets are added up and percents averaged over statuses, whatever their
    size; ``monitoring_overall`` has the weighted figures.
    """
    percent = lambda c: F.coalesce(M.mean_pct(F.col(c), 1), F.lit(0.0))
    return monitored.groupBy("run_date").agg(
        F.sum("total_customers").alias("total_customers"),
        F.sum("total_markets").alias("total_markets"),
        F.sum("matched_count").alias("matched"),
        F.sum("unmatched_count").alias("unmatched"),
        percent("avg_field_coverage_pct").alias("field_coverage_pct"),
        percent("people_coverage_pct").alias("people_coverage_pct"),
    )


def _missing(staged: DataFrame) -> DataFrame:
    return staged.filter(
        (F.col("match_status") == UNMATCHED) & T.has_text(F.col("customer_domain"))
    )


def missing_domains(staged: DataFrame) -> DataFrame:
    return _missing(staged).select("run_date", "customer_domain").distinct()


def missing_in_window(staged: DataFrame, as_of: str, days: int | None = 7) -> DataFrame:
    """Unmatched domains seen from ``days`` before ``as_of`` on, both ends included.

    ``days=None`` reports the whole history up to ``as_of``.
    """
    last = F.lit(as_of).cast("date")
    window = F.col("run_date") <= last
    if days is not None:
        window = window & (F.col("run_date") >= F.date_sub(last, days))
    return (
        _missing(staged.filter(window))
        .groupBy(F.lower(F.trim("customer_domain")).alias("domain"))
        .agg(
            F.min("run_date").alias("first_seen"),
            F.max("run_date").alias("last_seen"),
            F.countDistinct("run_date").alias("days_seen"),
        )
    )


def duplicate_check(rows: DataFrame) -> DataFrame:
    """Dates on which a record key repeats; empty for staged rows."""
    return (
        rows.groupBy("run_date")
        .agg(F.count("*").alias("row_count"), F.countDistinct("record_id").alias("distinct_ids"))
        .filter(F.col("row_count") != F.col("distinct_ids"))
    )


def field_percent_by_month(staged: DataFrame) -> DataFrame:
    """Percent of matched rows with each field, one column per field."""
    matched = F.col("match_status") == MATCHED
    shares = [
        M.pct(F.count_if(matched & field_present(f)), F.count_if(matched)).alias(f"{f}_coverage_pct")
        for f in FIELDS
    ]
    keys = ["run_year", "run_month", "run_month_name"]
    return staged.groupBy(*keys).agg(*shares)


def field_percent_long(by_month: DataFrame) -> DataFrame:
    """The same as rows (month, field, percent) with the dashboard colour."""
    keys = ["run_year", "run_month", "run_month_name"]
    columns = [f"{f}_coverage_pct" for f in FIELDS]
    return (
        by_month.unpivot(keys, columns, "field", "coverage_pct")
        .withColumn("field", F.regexp_replace("field", "_coverage_pct$", ""))
        .withColumn("colour", M.coverage_colour(F.col("coverage_pct")))
    )
