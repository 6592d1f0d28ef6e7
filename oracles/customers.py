"""Daily customer audit."""

from __future__ import annotations

from oracles.parts import mean_pct, pct, query, words
from recordlens import constants as K
from recordlens.plans.customers import FIELDS, GROUPS, NUMERIC_FIELDS
from recordlens.sources.fixtures import view_sql


def _number(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({column}), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?')"
        f" THEN TRY_CAST(trim({column}) AS DOUBLE) END"
    )


def _typed(head: str, name: str, kind: str) -> str:
    if kind == "float":
        return f"{_number(head)} AS {name}"
    if kind == "int":
        return f"CAST(trunc({_number(head)}) AS BIGINT) AS {name}"
    return f"trim({head}) AS {name}"


TYPED = ("typed", "SELECT row_no, run_date, " + ", ".join(_typed(*c) for c in K.EXPORT_COLUMNS)
         + " FROM f_subscription")
HOSTED = ("hosted", f"""
    SELECT *, CASE
        WHEN position('{K.CRM_URL_MARK}' IN lower(customer_domain_raw)) > 0 THEN NULL
        WHEN lower(customer_domain_raw) IN ({words(K.JUNK_DOMAINS)}) THEN NULL
        ELSE nullif(trim(split_part(regexp_replace(regexp_replace(lower(customer_domain_raw),
            '^https?://', ''), '^www[.]', ''), '/', 1)), '') END AS customer_domain
    FROM typed""")
INGESTED = ("ingested", """
    SELECT *, md5(coalesce(customer_domain, '') || coalesce(sub_created, '') || coalesce(customer_id, ''))
        AS record_id FROM hosted""")
INGEST = [TYPED, HOSTED, INGESTED]

LATEST = ("latest", """
    SELECT * FROM ingested QUALIFY row_number() OVER (
        PARTITION BY run_date, lower(trim(coalesce(customer_domain, customer_domain_raw)))
        ORDER BY sub_created DESC NULLS FIRST, record_id DESC, sub_status DESC NULLS LAST,
            seats DESC NULLS LAST) = 1""")
USABLE = ("usable", """
    SELECT * FROM f_catalog WHERE id NOT LIKE 'SYNTH_%'
    QUALIFY row_number() OVER (PARTITION BY lower(trim(fqdn)) ORDER BY id) = 1""")
PAIRS = ("pairs", """
    SELECT d.customer_domain, c.id AS catalog_id,
        coalesce(lower(trim(c.fqdn)) = lower(trim(d.customer_domain)), FALSE) AS same_host
    FROM (SELECT DISTINCT customer_domain FROM latest WHERE customer_domain IS NOT NULL) d
    JOIN usable c ON lower(trim(c.fqdn)) = lower(trim(d.customer_domain))
        OR contains(c.website, d.customer_domain)""")


def smallest_key_value(column: str) -> str:
    """Value of the smallest key of a JSON object."""
    return f"json_extract_string({column}, '$.\"' || list_min(json_keys({column})) || '\"')"


DETAILS = ("details", f"""
    SELECT id AS catalog_id, name AS catalog_name, website AS catalog_website, fqdn AS catalog_fqdn,
        json_extract_string(social_media, '$.linkedin') AS catalog_linkedin,
        nullif({smallest_key_value('industries')}, '{K.NO_INDUSTRY}') AS catalog_industry,
        year_founded AS catalog_founded_year, hq_country AS catalog_hq_country,
        company_type AS catalog_company_type,
        nullif({smallest_key_value('company_size')}, '{K.NO_DATA}') AS catalog_company_size,
        nullif({smallest_key_value('revenue')}, '{K.NO_DATA}') AS catalog_revenue,
        employee_count AS catalog_employee_count
    FROM usable""")
CONTACTS = ("contacts", """
    SELECT company_id, max(primary_phone) AS catalog_phone, max(primary_email) AS catalog_email
    FROM f_contact GROUP BY company_id""")
PEOPLE = ("people", "SELECT company_id, count(id) AS people_count FROM f_people WHERE company_id IS NOT NULL GROUP BY company_id")
STAGED = ("staged", """
    SELECT l.* EXCLUDE (row_no, monthly_credits, sales_team_size, currency),
        CAST(year(l.run_date) AS INTEGER) AS run_year, 'Q' || quarter(l.run_date) AS run_quarter,
        CAST(month(l.run_date) AS INTEGER) AS run_month, strftime(l.run_date, '%b') AS run_month_name,
        d.* EXCLUDE (catalog_company_type), k.catalog_phone, k.catalog_email, p.people_count,
        CASE WHEN d.catalog_id IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS match_status
    FROM latest l
    LEFT JOIN (SELECT customer_domain AS hit_domain, min(catalog_id) AS hit FROM pairs GROUP BY ALL) h
        ON h.hit_domain = l.customer_domain
    LEFT JOIN details d ON d.catalog_id = h.hit
    LEFT JOIN contacts k ON k.company_id = h.hit
    LEFT JOIN people p ON p.company_id = h.hit
    QUALIFY row_number() OVER (PARTITION BY l.run_date, l.record_id
        ORDER BY d.catalog_id NULLS LAST, l.customer_domain_raw NULLS LAST) = 1""")
STAGE = [*INGEST, LATEST, USABLE, PAIRS, DETAILS, CONTACTS, PEOPLE, STAGED]
VIEWS = "f_subscription f_catalog f_contact f_people"


def present(field: str, columns=FIELDS) -> str:
    c = columns[field]
    return f"{c} IS NOT NULL" if field in NUMERIC_FIELDS else f"coalesce(trim({c}), '') <> ''"


_HIT = "match_status = 'MATCHED'"


def _group_pct(fields) -> str:
    filled = " + ".join(f"count(*) FILTER (WHERE {_HIT} AND {present(f)})" for f in fields)
    return pct(filled, f"{len(fields)} * count(*) FILTER (WHERE {_HIT})")


_COUNTS = f"""count(*) AS total_customers,
    count(*) FILTER (WHERE {_HIT}) AS matched_count,
    count(*) FILTER (WHERE NOT {_HIT}) AS unmatched_count,
    {pct(f'count(*) FILTER (WHERE {_HIT})', 'count(*)')} AS matched_pct,
    {', '.join(f'{_group_pct(f)} AS {g}_coverage_pct' for g, f in GROUPS.items())},
    {pct(f'count(*) FILTER (WHERE {_HIT} AND people_count > 0)', f'count(*) FILTER (WHERE {_HIT})')} AS people_coverage_pct,
    CAST(sum(coalesce(people_count, 0)) AS BIGINT) AS total_people"""
_ACTIVE = f"""count(DISTINCT catalog_hq_country) AS total_markets,
    count(*) FILTER (WHERE {_HIT} AND people_count > 0) AS matched_with_people_count,
    count(*) FILTER (WHERE sub_status = 'active' AND {_HIT}) AS active_matched_count,
    count(*) FILTER (WHERE sub_status = 'active' AND NOT {_HIT}) AS active_unmatched_count,
    count(*) FILTER (WHERE sub_status = 'active' AND {_HIT} AND people_count > 0) AS active_matched_with_people_count"""
_PERIOD = "run_date, run_year, run_quarter, run_month, run_month_name"
MONITORED = ("monitored", f"SELECT {_PERIOD}, sub_status, {_COUNTS}, {_ACTIVE} FROM staged GROUP BY {_PERIOD}, sub_status")

READBACK = f"""SELECT run_date, CAST(sum(total_customers) AS BIGINT) AS total_customers,
    CAST(sum(total_markets) AS BIGINT) AS total_markets, CAST(sum(matched_count) AS BIGINT) AS matched,
    CAST(sum(unmatched_count) AS BIGINT) AS unmatched,
    coalesce({mean_pct('avg_field_coverage_pct', 1)}, 0.0) AS field_coverage_pct,
    coalesce({mean_pct('people_coverage_pct', 1)}, 0.0) AS people_coverage_pct
    FROM monitored GROUP BY run_date"""
_LOST = "match_status = 'UNMATCHED' AND trim(customer_domain) <> ''"


def _window(days: int | None) -> str:
    since = f" AND run_date >= DATE '2024-01-30' - INTERVAL {days} DAY" if days is not None else ""
    return f"""SELECT lower(trim(customer_domain)) AS domain, min(run_date) AS first_seen,
        max(run_date) AS last_seen, count(DISTINCT run_date) AS days_seen
        FROM staged WHERE {_LOST} AND run_date <= DATE '2024-01-30'{since} GROUP BY 1"""


_BY_MONTH = f"""SELECT run_year, run_month, run_month_name,
    {', '.join(f'{_group_pct([f])} AS {f}_coverage_pct' for f in FIELDS)}
    FROM staged GROUP BY ALL"""


def queries() -> dict[str, str]:
    stage = lambda body, extra=(): query(VIEWS, [*STAGE, *extra], body)
    stored = "sub_status IN ('active', 'canceled')"
    exact_pairs = ("best", """
        SELECT customer_domain AS hit_domain, first(catalog_id ORDER BY same_host DESC, catalog_id) AS catalog_id
        FROM pairs GROUP BY ALL""")
    every_row = ("latest", """
        SELECT * FROM ingested QUALIFY row_number() OVER (
            PARTITION BY run_date, coalesce(nullif(lower(trim(coalesce(customer_domain, customer_domain_raw))), ''),
                'row ' || record_id)
            ORDER BY sub_created DESC NULLS FIRST, record_id DESC, sub_status DESC NULLS LAST,
                seats DESC NULLS LAST) = 1""")
    filed = lambda sql: sql.replace(*(f"f_subscription AS ({view_sql(v)})" for v in ("f_subscription", "f_subscription_file")))
    streamed = stage("""
            SELECT r.rows_loaded, d.* FROM (SELECT run_date AS day, count(*) AS rows_loaded FROM ingested GROUP BY 1) r
            JOIN readback d ON d.run_date = r.day""", [MONITORED, ("readback", READBACK)])
    return {
        "files_export_rows": filed(query("f_subscription", INGEST, """
            SELECT * EXCLUDE (row_no, sales_team_size), strftime(run_date, '%m_%d_CTA.csv') AS source_file FROM ingested""")),
        "stream_file_drop": filed(streamed),
        "cta_ingest": query("f_subscription", INGEST, "SELECT * FROM ingested"),
        "cta_append_new": query("f_subscription", INGEST, f"""
            SELECT run_date, record_id, customer_domain, sub_status FROM ingested i
            WHERE NOT EXISTS (SELECT 1 FROM ingested e WHERE e.{stored}
                AND e.run_date = i.run_date AND e.record_id = i.record_id)"""),
        "cta_append_stored": query("f_subscription", INGEST, f"""
            SELECT run_date, record_id, customer_domain, sub_status FROM ingested i
            WHERE {stored} OR NOT EXISTS (SELECT 1 FROM ingested e WHERE e.{stored}
                AND e.run_date IS NOT DISTINCT FROM i.run_date AND e.record_id IS NOT DISTINCT FROM i.record_id)"""),
        "cta_staging": stage("SELECT * FROM staged"),
        "cta_staging_prefer_exact": query(
            "f_subscription f_catalog", [*INGEST, every_row, USABLE, PAIRS, exact_pairs], """
            SELECT run_date, record_id, customer_domain, catalog_id FROM latest
            LEFT JOIN best ON hit_domain = customer_domain
            QUALIFY row_number() OVER (PARTITION BY run_date, record_id ORDER BY catalog_id NULLS LAST) = 1"""),
        "cta_summary_by_status": stage(
            f"SELECT {_PERIOD}, sub_status, {_COUNTS} FROM staged GROUP BY {_PERIOD}, sub_status"),
        "cta_monitoring": stage("SELECT * FROM monitored", [MONITORED]),
        "cta_monitoring_overall": stage(
            f"SELECT {_PERIOD}, {_COUNTS}, {_ACTIVE} FROM staged GROUP BY {_PERIOD}"),
        "cta_daily_readback": stage(READBACK, [MONITORED]),
        "cta_missing_domains": stage(f"SELECT DISTINCT run_date, customer_domain FROM staged WHERE {_LOST}"),
        "cta_weekly_missing": stage(_window(7)),
        "cta_missing_history": stage(_window(None)),
        "cta_duplicate_check": stage("""
            SELECT run_date, count(*) AS row_count, count(DISTINCT record_id) AS distinct_ids
            FROM staged GROUP BY run_date HAVING count(*) <> count(DISTINCT record_id)"""),
        "cta_duplicate_check_raw": query("f_subscription", INGEST, f"""
            SELECT run_date, count(*) AS row_count, count(DISTINCT record_id) AS distinct_ids
            FROM (SELECT * FROM ingested UNION ALL SELECT * FROM ingested WHERE {stored})
            GROUP BY run_date HAVING count(*) <> count(DISTINCT record_id)"""),
        "cta_field_percent_by_month": stage(_BY_MONTH),
        "cta_field_percent_long": stage(f"""
            SELECT *, CASE WHEN coverage_pct < 50 THEN 'red' WHEN coverage_pct <= 75 THEN 'amber'
                WHEN coverage_pct > 75 THEN 'green' END AS colour
            FROM (SELECT run_year, run_month, run_month_name, replace(name, '_coverage_pct', '') AS field, coverage_pct
                FROM by_month UNPIVOT INCLUDE NULLS (coverage_pct FOR name IN (
                    {', '.join(f'{f}_coverage_pct' for f in FIELDS)})))""",
            [("by_month", _BY_MONTH)]),
        "stream_daily_ingest": streamed,
    }
