"""Trial audit."""

from __future__ import annotations

from oracles.customers import CONTACTS, INGEST, VIEWS, present, smallest_key_value
from oracles.parts import AUDIT_MARKETS, mean_pct, pct, query, words
from recordlens import constants as K
from recordlens.plans.audit import FIELDS

TRIALS = ("trials", f"""
    SELECT *, md5(domain || run_id) AS trial_id FROM (
        SELECT *, strftime(run_date, 'T%y.%m.%d') AS run_id, customer_domain AS domain FROM ingested
        WHERE sub_status IN ({words(K.VALID_SUBSCRIPTION_STATES)}) AND customer_domain IS NOT NULL)
    QUALIFY row_number() OVER (PARTITION BY domain, run_id
        ORDER BY sub_created, record_id, sub_status, seats NULLS LAST) = 1""")
USABLE = ("usable", """
    SELECT * FROM f_catalog
    WHERE id NOT LIKE 'SYNTH_%' AND json_extract_string(social_media, '$.linkedin') IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY lower(trim(fqdn)) ORDER BY id) = 1""")
HITS = ("hits", """
    SELECT d.domain, min(c.id) AS catalog_id FROM (SELECT DISTINCT domain FROM trials) d
    JOIN usable c ON lower(trim(c.fqdn)) = d.domain OR contains(c.website, d.domain) GROUP BY d.domain""")
MATCHED = ("matched", f"""
    SELECT t.trial_id, t.run_id, t.run_date, t.domain, t.crm_name, t.customer_id,
        CASE WHEN c.id IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS match_status,
        c.id AS catalog_id, c.hq_country AS catalog_hq_country, c.name AS catalog_name,
        c.website AS catalog_website, json_extract_string(c.social_media, '$.linkedin') AS catalog_linkedin,
        nullif({smallest_key_value('c.industries')}, '{K.NO_INDUSTRY}') AS catalog_industry,
        c.year_founded AS catalog_founded_year, c.company_type AS catalog_company_type,
        k.catalog_phone, k.catalog_email
    FROM trials t LEFT JOIN hits h ON h.domain = t.domain LEFT JOIN usable c ON c.id = h.catalog_id
    LEFT JOIN contacts k ON k.company_id = h.catalog_id""")
SLUGS = ("slugs", """
    SELECT trial_id, run_id, run_date, domain, catalog_id, rtrim(CASE
        WHEN regexp_matches(lower(catalog_linkedin), 'linkedin[.]com/company/[^/?#\\s]')
        THEN regexp_extract(lower(catalog_linkedin), 'linkedin[.]com/company/([^/?#\\s]+)', 1)
        ELSE lower(trim(catalog_linkedin)) END, '/') AS slug
    FROM matched WHERE match_status = 'MATCHED' AND catalog_linkedin IS NOT NULL""")
ENRICHED = ("enriched", """
    SELECT trial_id, run_id, run_date, domain, catalog_id, s.slug, payload_status,
        CASE WHEN payload_status = '200' THEN p.raw END AS payload_raw,
        CASE WHEN payload_status = '200' THEN s.slug END AS payload_slug
    FROM (SELECT *, row_number() OVER (PARTITION BY run_id, slug ORDER BY trial_id) AS turn FROM slugs) s
    LEFT JOIN (SELECT * FROM f_payload WHERE status = '200') p ON p.slug = s.slug,
    LATERAL (SELECT CASE WHEN s.turn > 1 AND s.slug <> '' THEN '409' WHEN p.slug IS NULL THEN '404' ELSE '200' END AS payload_status)""")
MATCH = [*INGEST, TRIALS, USABLE, HITS, CONTACTS, MATCHED]
ENRICH = [*MATCH, SLUGS, ENRICHED]

_MISSING = ", ".join(f"CASE WHEN NOT ({present(f, FIELDS)}) THEN '{f}' END" for f in FIELDS)
_PRESENT = " + ".join(f"CAST({present(f, FIELDS)} AS INTEGER)" for f in FIELDS)
FIELD = ("fields", f"""
    SELECT trial_id, run_id, run_date, domain, crm_name, customer_id, match_status, catalog_id,
        {', '.join(f'CAST({present(f, FIELDS)} AS INTEGER) AS {f}_covered' for f in FIELDS)},
        {pct(_PRESENT, '9')} AS field_coverage_pct,
        9 - ({_PRESENT}) AS fields_missing_count,
        array_to_string(list_filter([{_MISSING}], lambda x: x IS NOT NULL), ',') AS missing_fields
    FROM matched WHERE match_status = 'MATCHED'""")
_SHARE = f"least(greatest({pct('people_count', 'headcount')}, 0.0), 100.0)"
PEOPLE = ("people_cov", f"""
    SELECT *, CASE WHEN headcount <> 0 THEN {_SHARE} END AS people_coverage_pct,
        CASE WHEN headcount <> 0 THEN {_SHARE} END AS employee_coverage_pct,
        greatest(headcount - people_count, 0) AS people_gap
    FROM (
        SELECT m.trial_id, m.run_id, m.run_date, m.domain, m.catalog_id, p.country_code AS market,
            count(*) AS people_count,
            coalesce(max(CASE WHEN e.payload_status = '200' AND json_valid(e.payload_raw)
                THEN TRY_CAST(json_extract_string(e.payload_raw, '$.employee_count') AS BIGINT) END), 0) AS headcount
        FROM matched m JOIN f_people p ON p.company_id = m.catalog_id
        LEFT JOIN enriched e ON e.trial_id = m.trial_id AND e.run_id = m.run_id
        WHERE p.country_code IN ({AUDIT_MARKETS}) GROUP BY ALL)""")
PLACES = ("places", f"""
    SELECT DISTINCT e.trial_id, e.run_id, e.run_date, e.domain, e.catalog_id,
        upper(trim(json_extract_string(loc.value, '$.address.country'))) AS market
    FROM enriched e, json_each(CASE WHEN json_valid(e.payload_raw) THEN e.payload_raw ELSE '{{}}' END, '$.locations') loc
    WHERE e.payload_status = '200'
        AND upper(trim(json_extract_string(loc.value, '$.address.country'))) IN ({AUDIT_MARKETS})""")
KNOWN = ("known", f"""
    SELECT DISTINCT m.trial_id, m.run_id, m.run_date, m.domain, m.catalog_id, r.country_code AS market
    FROM matched m JOIN f_region r ON r.company_id = m.catalog_id
    WHERE r.country_code IN ({AUDIT_MARKETS}) AND m.match_status = 'MATCHED'""")
LOCATION = ("locations", """
    SELECT a.*, k.market IS NOT NULL AS in_catalog_at_location, p.market IS NOT NULL AS payload_has_location,
        p.market IS NOT NULL AND k.market IS NULL AS location_gap
    FROM (SELECT * FROM known UNION SELECT * FROM places) a
    LEFT JOIN known k USING (trial_id, run_id, market) LEFT JOIN places p USING (trial_id, run_id, market)""")
_HAVE = "count(*) FILTER (WHERE in_catalog_at_location) OVER (PARTITION BY trial_id, run_id)"
_WANT = "count(*) FILTER (WHERE payload_has_location) OVER (PARTITION BY trial_id, run_id)"
GAPS = ("gaps", f"""
    SELECT f.trial_id, f.run_id, f.run_date, f.domain, f.crm_name, f.customer_id, f.catalog_id, p.market,
        f.field_coverage_pct, f.fields_missing_count, f.missing_fields,
        coalesce(p.people_count, 0) AS people_count, p.headcount, coalesce(p.people_gap, 0) AS people_gap,
        coalesce(p.people_coverage_pct, 0.0) AS people_coverage_pct,
        coalesce(l.in_catalog_at_location, FALSE) AS in_catalog_at_location,
        coalesce(l.payload_has_location, FALSE) AS payload_has_location,
        coalesce(l.location_gap, FALSE) AS location_gap,
        coalesce(l.location_coverage_pct, 0.0) AS location_coverage_pct
    FROM fields f LEFT JOIN people_cov p ON p.trial_id = f.trial_id AND p.run_id = f.run_id
    LEFT JOIN (SELECT *, {pct(_HAVE, _WANT)} AS location_coverage_pct FROM locations) l
        ON l.trial_id = f.trial_id AND l.run_id = f.run_id AND l.market = p.market""")
SCORED = ("scored", """
    SELECT trial_id, run_id, run_date, domain, crm_name, customer_id, catalog_id, 'MATCHED' AS match_status,
        market, field_coverage_pct, people_coverage_pct, location_coverage_pct,
        least(greatest(round((field_coverage_pct + people_coverage_pct + location_coverage_pct) / 3.0, 2), 0.0), 100.0) AS quality_score,
        fields_missing_count, missing_fields, people_gap, CAST(location_gap AS INTEGER) AS location_gap_count
    FROM gaps
    UNION ALL
    SELECT trial_id, run_id, run_date, domain, crm_name, customer_id, NULL, match_status, NULL,
        0.0, 0.0, 0.0, 0.0, 9, NULL, 0, 0
    FROM matched WHERE match_status = 'UNMATCHED'""")


def _scores(entity: str) -> tuple[str, str]:
    """Prior score by a look-up of the last earlier run."""
    return ("scores", f"""
        SELECT s.*, p.run_id AS prev_run_id, CAST(p.quality_score AS DOUBLE) AS prev_quality_score,
            round(s.quality_score - p.quality_score, 2) AS quality_delta,
            CASE WHEN s.quality_score >= 90 THEN 'EXCELLENT' WHEN s.quality_score >= 75 THEN 'GOOD'
                WHEN s.quality_score >= 60 THEN 'FAIR' WHEN s.quality_score >= 40 THEN 'NEEDS WORK'
                ELSE 'POOR' END AS quality_status,
            CASE WHEN p.quality_score IS NULL THEN 'FIRST_RUN'
                WHEN round(s.quality_score - p.quality_score, 2) > 2 THEN 'IMPROVED'
                WHEN round(s.quality_score - p.quality_score, 2) < -2 THEN 'DECLINED' ELSE 'STABLE' END AS direction
        FROM scored s LEFT JOIN scored p ON s.match_status = 'MATCHED' AND p.match_status = 'MATCHED'
            AND p.{entity} = s.{entity} AND p.market IS NOT DISTINCT FROM s.market AND p.run_date < s.run_date
        QUALIFY row_number() OVER (PARTITION BY s.trial_id, s.run_id, s.market ORDER BY p.run_date DESC NULLS LAST) = 1""")


CHAIN = [*ENRICH, FIELD, PEOPLE, PLACES, KNOWN, LOCATION, GAPS, SCORED]
AUDIT_VIEWS = "f_subscription f_catalog f_contact"
ALL_VIEWS = VIEWS + " f_payload f_region"


def queries() -> dict[str, str]:
    match = lambda body, extra=(): query(AUDIT_VIEWS, [*MATCH, *extra], body)
    chain = lambda body, entity="domain": query(ALL_VIEWS, [*CHAIN, _scores(entity)], body)
    hit = "match_status = 'MATCHED'"
    bands = {"excellent": "EXCELLENT", "good": "GOOD", "fair": "FAIR", "needs_work": "NEEDS WORK", "poor": "POOR"}
    turns = {d: d.upper() for d in ("improved", "declined", "stable", "first_run")}
    trial = "trial_id, run_id"
    return {
        "audit_input": query("f_subscription", [*INGEST, TRIALS], """
            SELECT trial_id, run_id, run_date, customer_domain_raw AS domain_raw, domain, crm_name, customer_id,
                icp, sub_status, product_name, sub_plan_amount_aud AS plan_amount_aud, billing_country, seats
            FROM trials"""),
        "audit_match": match("SELECT * FROM matched"),
        "audit_match_counts": match("SELECT run_id, match_status, count(*) AS trials FROM matched GROUP BY ALL"),
        "audit_slugs": match("SELECT * FROM slugs", [SLUGS]),
        "audit_enrich": query(ALL_VIEWS, ENRICH, "SELECT * FROM enriched"),
        "audit_field_coverage": match("SELECT * FROM fields", [FIELD]),
        "audit_people_coverage": chain("SELECT * FROM people_cov"),
        "audit_location_coverage": chain("SELECT * FROM locations"),
        "audit_gap_summary": chain("SELECT * FROM gaps"),
        "audit_quality_score": chain("SELECT * FROM scores"),
        "audit_quality_score_by_trial": chain(
            "SELECT trial_id, market, quality_score, direction FROM scores", "trial_id"),
        "audit_overall_run": chain(f"""
            SELECT run_id, run_date, count(DISTINCT trial_id) AS companies_audited,
                count(DISTINCT trial_id) FILTER (WHERE {hit}) AS matched_count,
                count(DISTINCT trial_id) FILTER (WHERE NOT {hit}) AS unmatched_count,
                {pct(f'count(DISTINCT trial_id) FILTER (WHERE {hit})', 'count(DISTINCT trial_id)')} AS matched_pct,
                {mean_pct(f'CASE WHEN {hit} THEN quality_score END')} AS avg_quality_score,
                {', '.join(f"count(*) FILTER (WHERE quality_status = '{b}') AS {n}_count" for n, b in bands.items())},
                {', '.join(f"count(*) FILTER (WHERE direction = '{b}') AS {n}_count" for n, b in turns.items())}
            FROM scores GROUP BY run_id, run_date"""),
        "audit_by_market": chain(f"""
            SELECT run_id, market, count(DISTINCT trial_id) AS companies,
                {mean_pct('quality_score')} AS avg_quality_score,
                {mean_pct('field_coverage_pct')} AS avg_field_coverage,
                {mean_pct('people_coverage_pct')} AS avg_people_coverage,
                {mean_pct('location_coverage_pct')} AS avg_location_coverage,
                CAST(sum(people_gap) AS BIGINT) AS total_people_gap,
                CAST(sum(location_gap_count) AS BIGINT) AS total_location_gaps
            FROM scores GROUP BY run_id, market"""),
        "audit_dashboard": chain(f"""
            SELECT s.*, t.icp, t.product_name, t.sub_plan_amount_aud AS plan_amount_aud, t.billing_country, t.seats
            FROM scores s LEFT JOIN trials t USING ({trial})"""),
    }
