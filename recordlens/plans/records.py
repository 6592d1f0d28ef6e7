"""Record monitoring: input files, repeat marks, payload status, upsert and landing rows."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.functions import text as T
from recordlens.operators.rows import keep_top, left_join_sparse, mark_repeats
from recordlens.operators.sinks import missing_rows

PAYLOAD_KEY = ("platform", "handle", "request_type", "profile_type")
LANDING = (
    "run_id", "row_no", "source_file", "file_date", "source", "criteria", "full_name", "first_name",
    "last_name", "title", "company", "location", "domain", "profile_link", "country", "slug",
)


def rename_inputs(raw: DataFrame) -> DataFrame:
    """Known headers, case-folded, under their names here; of several the first filled one."""
    aliases = defaultdict(list)
    present = {c.strip().lower(): c for c in raw.columns}
    for head, name in K.INPUT_ALIASES:
        if head in present:
            aliases[name].append(T.strip(F.col(f"`{present[head]}`")))
        else:
            aliases[name]
    known = {head for head, _ in K.INPUT_ALIASES}
    others = [F.col(f"`{c}`") for c in raw.columns if c.strip().lower() not in known]
    filled = [_first_filled(cols).alias(name) for name, cols in aliases.items()]
    return raw.select(*others, *filled)


def _first_filled(columns: list[Column]) -> Column:
    if not columns:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], columns[0])


def with_slug(rows: DataFrame, kind: str) -> DataFrame:
    slug = {"person": T.person_slug, "company": T.company_slug}[kind]
    return rows.withColumn("slug", slug(F.col("profile_link")))


def mark_duplicates(rows: DataFrame, kind: str) -> DataFrame:
    """Slug of each row and status 409 on later rows with the same slug, in file order.

    Rows without a slug are never marked. ``row_no`` is the unique order.
    """
    return mark_repeats(with_slug(rows, kind), ["slug"], "row_no", "status", "409")


def duplicate_counts(marked: DataFrame) -> DataFrame:
    no_slug = F.count_if(F.col("slug") == "")
    return marked.agg(
        F.count("*").alias("rows_loaded"),
        (F.count("*") - no_slug).alias("rows_with_slug"),
        no_slug.alias("rows_no_slug"),
        F.count_if(F.col("status") == "409").alias("rows_duplicate"),
    )


def attach_payloads(marked: DataFrame, payloads: DataFrame) -> DataFrame:
    """Payload of every row that is no repeat: 200 with its text, else 404.

    Rows without a slug cannot be looked up and get 404.
    """
    cached = (
        payloads.filter(F.col("status") == "200")
        .groupBy("slug")
        .agg(F.max("raw").alias("payload_raw"))
        .withColumn("found", F.lit(True))
    )
    # only first rows of a slug are looked up, so no slug is hot in this join
    lookup = F.when(F.col("status").isNull() & (F.col("slug") != ""), F.col("slug"))
    joined = left_join_sparse(
        marked.withColumn("lookup", lookup), cached.withColumnRenamed("slug", "lookup"),
        "lookup", "row_no",
    )
    status = F.coalesce("status", F.when(F.col("found"), "200").otherwise("404"))
    return joined.withColumn("status", status).drop("lookup", "found")


def status_counts(rows: DataFrame) -> DataFrame:
    known = F.col("status").isin("200", "404", "409")
    return (
        rows.groupBy(F.when(known, F.col("status")).otherwise("other").alias("status"))
        .agg(F.count("*").alias("rows"))
    )


def upsert_rows(enriched: DataFrame, stored: DataFrame | None, profile_type: str) -> DataFrame:
    """Payload records to add: status 200 or 404, keys not stored, first of a key.

    ``profile_type`` is PERSON or COMPANY. The handle is the first filled of the
    payload's slug, the input's slug and the input's link.
    """
    filled = [F.nullif(F.col(c), F.lit("")) for c in ("payload_slug", "slug", "profile_link")]
    if "payload_slug" not in enriched.columns:
        enriched = enriched.withColumn(
            "payload_slug", F.when(F.col("status") == "200", F.col("slug"))
        )
    records = enriched.filter(F.col("status").isin("200", "404")).select(
        F.lit(K.PAYLOAD_PLATFORM).alias("platform"),
        F.coalesce(*filled, F.col("profile_link")).alias("handle"),
        F.lit(profile_type).alias("profile_type"),
        F.lit(K.PAYLOAD_REQUEST).alias("request_type"),
        F.lit(K.PAYLOAD_PRIORITY).alias("priority"),
        F.lit(K.PAYLOAD_STATE).alias("state"),
        T.payload_value(F.col("payload_raw"), "$.id", "string").alias("profile_id"),
        F.col("status").cast("int").alias("status_code"),
        T.payload_value(F.col("payload_raw"), "$.post_count", "double").alias("post_count"),
        "row_no",
    )
    first = keep_top(records, list(PAYLOAD_KEY), [F.col("row_no")])
    return missing_rows(first, stored, list(PAYLOAD_KEY))


def landing_rows(enriched: DataFrame, run_id: Column, file_date: Column) -> DataFrame:
    """Input rows with status and payload in the landing schema; absent inputs are NULL."""
    rows = enriched.withColumn("run_id", run_id).withColumn("file_date", file_date)
    have = set(rows.columns)
    columns = [
        F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in LANDING
    ]
    return rows.select(
        *columns,
        F.col("status").alias("payload_status"),
        F.when(F.col("status") == "200", F.col("payload_raw")).alias("payload_raw"),
    )
