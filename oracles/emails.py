"""E-mail profiles, hub joins and publishing rules."""

from __future__ import annotations

from oracles.parts import EMAIL_MARKETS, any_of, pct, query
from recordlens import constants as K

FORMED = f"coalesce(regexp_full_match(lower(trim(email)), '{K.EMAIL_FORMAT}'), FALSE)"
SYSTEM = f"regexp_matches(lower(trim(email)), '^{any_of(K.SYSTEM_LOCAL_PARTS)}@')"
GENERIC = {
    "basic": f"regexp_matches(lower(trim(email)), '^{any_of(K.GENERIC_LOCAL_PARTS_BASIC)}@')",
    "regional": f"regexp_matches(lower(trim(email)), '^{any_of(K.GENERIC_LOCAL_PARTS_REGIONAL)}@')",
}
FREE = {
    "basic": f"regexp_matches(lower(trim(email)), '@{any_of(K.FREE_DOMAINS_BASIC)}')",
    "regional": f"regexp_matches(lower(trim(email)), '@{any_of(K.FREE_DOMAINS_REGIONAL)}')",
}
HAS_TEXT = "coalesce(trim(email), '') <> ''"
IN_MARKETS = f"country IN ({EMAIL_MARKETS})"
COUNTRY = "coalesce(nullif(trim(country), ''), 'UNKNOWN')"
HQ = "coalesce(nullif(trim(hq_country), ''), 'UNKNOWN')"
ROOT = "split_part(split_part(lower(trim(email)), '@', 2), '.', 1)"
HOST_ROOT = "split_part(lower(trim(fqdn)), '.', 1)"

BASIC_TYPE = f"""CASE WHEN {SYSTEM} THEN 'system_blocked' WHEN {GENERIC['basic']} THEN 'generic_role_based'
    WHEN {FREE['basic']} THEN 'free_provider' ELSE 'specific_company' END"""
REGIONAL_TYPE = f"""CASE WHEN {SYSTEM} THEN 'system_blocked' WHEN {FREE['regional']} THEN 'free_provider'
    WHEN {GENERIC['regional']} THEN 'generic_role_based' ELSE 'specific_company' END"""
# no well-formed address can be covered by a pattern that starts at the @
FULL_TYPE = f"""CASE WHEN {SYSTEM} THEN 'system_blocked' WHEN {GENERIC['regional']} THEN 'generic_role_based'
    ELSE 'specific_company' END"""


def _share(keys: str, source: str, count: str, percent: str, outer: str = "") -> str:
    """Counts per key and their percent of all rows of the outer group."""
    names = ", ".join(k.split(" AS ")[-1] for k in keys.split(";"))
    over = f"OVER (PARTITION BY {outer})" if outer else "OVER ()"
    return f"""SELECT *, {pct(count, f'CAST(sum({count}) {over} AS BIGINT)')} AS {percent}
        FROM (SELECT {names}, count(*) AS {count} FROM (SELECT {', '.join(keys.split(';'))} FROM {source}) GROUP BY ALL)"""


def _coverage(scope: str) -> str:
    hq = HQ if scope == "any" else "hq_country"
    where = {
        "any": "status = 'PUBLISHED'",
        "market_set": f"status = 'PUBLISHED' AND hq_country IN ({EMAIL_MARKETS})",
        "hq": f"hq_country IN ({EMAIL_MARKETS})",
    }[scope]
    has = {
        "any": "EXISTS (SELECT 1 FROM f_email e WHERE e.id = c.id AND e.email IS NOT NULL)",
        "market_set": f"EXISTS (SELECT 1 FROM f_email e WHERE e.id = c.id AND e.email IS NOT NULL AND e.{IN_MARKETS})",
        "hq": f"EXISTS (SELECT 1 FROM f_email e WHERE e.id = c.id AND {HAS_TEXT} AND e.country = c.hq_country)",
    }[scope]
    other = f", EXISTS (SELECT 1 FROM f_email e WHERE e.id = c.id AND {HAS_TEXT}) AS somewhere" if scope == "hq" else ""
    extra = ", count(*) FILTER (WHERE somewhere AND NOT has) AS has_email_other_market" if scope == "hq" else ""
    return f"""SELECT country, count(*) AS total_companies, count(*) FILTER (WHERE has) AS with_email,
        count(*) FILTER (WHERE NOT has) AS missing_email,
        {pct('count(*) FILTER (WHERE has)', 'count(*)')} AS pct_with_email,
        {pct('count(*) FILTER (WHERE NOT has)', 'count(*)')} AS pct_missing{extra}
        FROM (SELECT c.id, {hq} AS country, {has} AS has{other} FROM f_company c WHERE {where}) GROUP BY country"""


def _gap(scope: str) -> str:
    hq = HQ if scope == "any" else "hq_country"
    on = {"any": "TRUE", "market_set": f"e.{IN_MARKETS}", "hq": "e.country = h.hq_country"}[scope]
    where = "trim(h.fqdn) <> ''"
    if scope != "any":
        where += f" AND h.hq_country IN ({EMAIL_MARKETS})"
    if scope != "hq":
        where += " AND h.status = 'PUBLISHED'"
        has, without = "n > 0", "n = 0"
    else:
        has, without = "n > 0", "n < joined"
    return f"""SELECT country, count(*) AS companies_with_fqdn, count(*) FILTER (WHERE {without}) AS missing_email,
        count(*) FILTER (WHERE {has}) AS has_email,
        {pct(f'count(*) FILTER (WHERE {without})', 'count(*)')} AS pct_missing
        FROM (SELECT h.id, {hq} AS country, count(e.email) AS n, count(*) AS joined
            FROM f_company h LEFT JOIN f_email e ON e.id = h.id AND {on} WHERE {where} GROUP BY ALL)
        GROUP BY country"""


def _mismatch(scope: str, limit: str = "") -> str:
    hq = HQ if scope == "any" else "hq_country"
    on = {"any": "", "market_set": f"AND h.hq_country IN ({EMAIL_MARKETS}) AND e.{IN_MARKETS}",
          "hq": f"AND h.hq_country IN ({EMAIL_MARKETS}) AND e.country = h.hq_country"}[scope]
    return f"""SELECT country, count(*) AS total_pairs, count(*) FILTER (WHERE same) AS domain_match,
        count(*) FILTER (WHERE NOT same) AS domain_mismatch,
        {pct('count(*) FILTER (WHERE same)', 'count(*)')} AS pct_match,
        {pct('count(*) FILTER (WHERE NOT same)', 'count(*)')} AS pct_mismatch
        FROM (SELECT {hq} AS country, {HOST_ROOT} = {ROOT} AND {HOST_ROOT} <> '' AS same
            FROM f_company h JOIN f_email e ON e.id = h.id {on}
            WHERE h.fqdn LIKE '%.%' AND trim(h.fqdn) <> '' AND e.email LIKE '%@%')
        GROUP BY country {limit}"""


def _gate(open_rules: bool) -> str:
    allowed = f"{ROOT} = {HOST_ROOT} AND {HOST_ROOT} <> '' AND fqdn LIKE '%.%'"
    passes = allowed if not open_rules else f"(({allowed}) OR (hq_country = 'KR' AND {ROOT} = 'other'))"
    enabled = "" if open_rules else "AND enabled"
    return f"""
        SELECT id, country, root, email_row_id, clean AS email, email_type, deliverability_rank, domain_match
        FROM (
            SELECT e.id, e.country, {ROOT} AS root, e.email_row_id, lower(trim(e.email)) AS clean, e.email,
                enabled, {FORMED} AND NOT {SYSTEM} AS fit, {REGIONAL_TYPE} AS email_type, deliverability,
                CASE deliverability WHEN 'em-av-highly-likely' THEN 0 WHEN 'em-av-likely' THEN 1
                    WHEN 'em-av-unsure' THEN 2 ELSE 3 END AS deliverability_rank,
                coalesce({passes}, FALSE) AS domain_match,
                bool_or({FORMED} AND coalesce({allowed}, FALSE)) OVER (PARTITION BY e.id) AS has_own
            FROM f_email e JOIN f_company c ON c.id = e.id AND c.status = 'PUBLISHED'
            LEFT JOIN f_deliverability d ON d.email_row_id = e.email_row_id)
        WHERE fit {enabled} AND deliverability IS DISTINCT FROM 'em-av-undeliverable'
            AND (domain_match OR (email_type = 'free_provider' AND NOT has_own))
        QUALIFY row_number() OVER (PARTITION BY id, country ORDER BY domain_match DESC, deliverability_rank,
            CAST(email_type = 'generic_role_based' AS INTEGER), clean, email_row_id) <= 5"""


def queries() -> dict[str, str]:
    mail = lambda body: query("f_email", [], body)
    hub = lambda body: query("f_company f_email", [], body)
    deliv = lambda body: query("f_deliverability", [], body)
    formed = f"f_email WHERE {FORMED}"
    local = f"f_email WHERE {FORMED} AND {IN_MARKETS}"
    unverified = "count(*) FILTER (WHERE coalesce(trim(verification_status), '') = '')"
    per_address = """SELECT {keys} lower(trim(email)) AS address, count(DISTINCT id) AS companies, count(*) AS n
        FROM {source} GROUP BY ALL"""
    runs = query("f_email f_email_1 f_email_2", [(
        "every", "SELECT * FROM f_email UNION ALL SELECT * FROM f_email_1 UNION ALL SELECT * FROM f_email_2")],
        _share("run_date;country;coalesce(nullif(trim(source), ''), 'NULL') AS source",
               f"every WHERE {IN_MARKETS}", "email_count", "pct_of_country", "run_date, country"))
    return {
        "email_rows_by_country": mail(f"""SELECT country, count(*) AS total_email_rows,
            count(DISTINCT id) AS distinct_companies FROM f_email WHERE {IN_MARKETS} GROUP BY country"""),
        "email_format": mail(_share(f"""CASE WHEN coalesce(trim(email), '') = '' THEN 'empty'
            WHEN position('@' IN email) = 0 THEN 'invalid_no_at' WHEN NOT {FORMED} THEN 'invalid_format'
            ELSE 'valid' END AS format_status""", "f_email", "email_rows", "pct")),
        "email_type": mail(_share(f"{BASIC_TYPE} AS email_type", formed, "email_rows", "pct")),
        "email_type_by_country": mail(_share(f"country;{REGIONAL_TYPE} AS email_type", local,
            "email_rows", "pct_of_country", "country")),
        "email_type_full_match": mail(_share(f"country;{FULL_TYPE} AS email_type", local,
            "email_rows", "pct_of_country", "country")),
        "email_system_rate": mail(f"""SELECT {COUNTRY} AS country, count(*) AS total_emails,
            count(*) FILTER (WHERE {SYSTEM}) AS system_blocked,
            {pct(f'count(*) FILTER (WHERE {SYSTEM})', 'count(*)')} AS pct_system_blocked
            FROM {formed} GROUP BY 1 ORDER BY pct_system_blocked DESC, 1 LIMIT 20"""),
        "email_verification": mail(_share(
            "coalesce(nullif(trim(verification_status), ''), 'NULL/unverified') AS verification_status",
            "f_email", "row_count", "pct")),
        "email_verification_by_country": mail(f"""SELECT country, count(*) AS total, {unverified} AS unverified,
            count(*) FILTER (WHERE trim(verification_status) = 'Highly likely') AS highly_likely,
            count(*) FILTER (WHERE trim(verification_status) = 'Likely') AS likely,
            count(*) FILTER (WHERE trim(verification_status) = 'Unsure') AS unsure,
            {pct(unverified, 'count(*)')} AS pct_unverified FROM f_email WHERE {IN_MARKETS} GROUP BY country"""),
        "email_verifier_status": mail(_share(
            "coalesce(nullif(trim(primary_verifier), ''), 'NULL') AS verifier;"
            "coalesce(nullif(trim(primary_status), ''), 'NULL') AS status", "f_email", "row_count", "pct")
            + " ORDER BY row_count DESC, verifier, status LIMIT 30"),
        "email_excessive": mail(f"""SELECT country, count(*) AS company_country_pairs,
            count(*) FILTER (WHERE n > 5) AS companies_with_gt5_emails,
            {pct('count(*) FILTER (WHERE n > 5)', 'count(*)')} AS pct_gt5
            FROM (SELECT id, {COUNTRY} AS country, count(*) FILTER (WHERE {HAS_TEXT}) AS n FROM f_email GROUP BY ALL)
            GROUP BY country"""),
        "email_duplicates": mail(f"""SELECT count(*) AS total_distinct_emails,
            count(*) FILTER (WHERE n = 1) AS unique_emails, count(*) FILTER (WHERE n > 1) AS duplicate_emails,
            {pct('count(*) FILTER (WHERE n > 1)', 'count(*)')} AS duplicate_pct
            FROM ({per_address.format(keys='', source=formed)})"""),
        "email_shared": mail(f"""SELECT country, count(*) AS distinct_emails,
            count(*) FILTER (WHERE companies = 1) AS unique_to_one_co,
            count(*) FILTER (WHERE companies > 1) AS shared_across_cos,
            {pct('count(*) FILTER (WHERE companies > 1)', 'count(*)')} AS pct_shared
            FROM ({per_address.format(keys='country,', source=local)}) GROUP BY country"""),
        "email_top_shared": mail(f"""SELECT lower(trim(email)) AS email, country,
            count(DISTINCT id) AS on_n_companies,
            coalesce(string_agg(DISTINCT source, ', ' ORDER BY source), '') AS sources
            FROM {local} GROUP BY 1, 2 HAVING count(DISTINCT id) > 5 ORDER BY 3 DESC, 1, 2 LIMIT 40"""),
        "email_enabled": mail(_share("coalesce(CAST(enabled AS VARCHAR), 'NULL') AS enabled",
            "f_email", "row_count", "pct")),
        "email_deliverability": deliv(_share(
            "coalesce(nullif(trim(deliverability), ''), 'NULL') AS deliverability", "f_deliverability",
            "row_count", "pct")),
        "email_deliverability_by_country": deliv(f"""SELECT country, count(*) AS total,
            count(*) FILTER (WHERE deliverability = 'em-av-undeliverable') AS undeliverable,
            count(*) FILTER (WHERE deliverability = 'em-av-highly-likely') AS highly_likely,
            count(*) FILTER (WHERE deliverability = 'em-av-likely') AS likely,
            count(*) FILTER (WHERE deliverability = 'em-av-unsure') AS unsure,
            count(*) - count(deliverability) AS not_checked,
            {pct("count(*) FILTER (WHERE deliverability = 'em-av-undeliverable')", 'count(*)')} AS pct_undeliverable,
            {pct('count(*) - count(deliverability)', 'count(*)')} AS pct_not_checked
            FROM f_deliverability WHERE {IN_MARKETS} GROUP BY country"""),
        "email_source": mail(_share("country;coalesce(nullif(trim(source), ''), 'NULL') AS source",
            f"f_email WHERE {IN_MARKETS}", "email_count", "pct_of_country", "country")),
        "email_source_breakdown": runs,
        "email_coverage_any": hub(_coverage("any")),
        "email_coverage_market_set": hub(_coverage("market_set")),
        "email_coverage_hq": hub(_coverage("hq")),
        "email_fqdn_gap_any": hub(_gap("any")),
        "email_fqdn_gap_market_set": hub(_gap("market_set")),
        "email_fqdn_gap_hq": hub(_gap("hq")),
        "email_domain_mismatch_any": hub(_mismatch("any", "ORDER BY pct_mismatch DESC, country LIMIT 20")),
        "email_domain_mismatch_market_set": hub(_mismatch("market_set")),
        "email_domain_mismatch_hq": hub(_mismatch("hq")),
        "email_quality_gate": query("f_company f_email f_deliverability", [], _gate(False)),
        "email_quality_gate_open": query("f_company f_email f_deliverability", [], _gate(True)),
        "email_top_per_company": query("f_email f_deliverability", [], f"""
            SELECT id, country, email_row_id, clean AS email, email_type, deliverability_rank FROM (
                SELECT e.id, e.country, e.email_row_id, lower(trim(e.email)) AS clean, {REGIONAL_TYPE} AS email_type,
                    CASE d.deliverability WHEN 'em-av-highly-likely' THEN 0 WHEN 'em-av-likely' THEN 1
                        WHEN 'em-av-unsure' THEN 2 ELSE 3 END AS deliverability_rank
                FROM f_email e LEFT JOIN f_deliverability d USING (email_row_id) WHERE {HAS_TEXT})
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY
                array_position(['specific_company', 'generic_role_based', 'free_provider', 'system_blocked'], email_type),
                deliverability_rank, clean, email_row_id) <= 5"""),
        "email_dedupe_shared": hub(f"""
            SELECT e.id, e.country, e.email_row_id, lower(trim(e.email)) AS email FROM f_email e
            LEFT JOIN f_company c ON c.id = e.id AND c.fqdn LIKE '%.%'
            JOIN ({per_address.format(keys='', source=formed)}) a ON a.address = lower(trim(e.email))
            WHERE {FORMED} AND (a.companies <= 5 OR ({ROOT} = {HOST_ROOT} AND {HOST_ROOT} <> ''))"""),
        "email_suppress": query("f_email f_deliverability", [], f"""
            SELECT e.email_row_id, e.id, e.country,
                CASE WHEN d.deliverability = 'em-av-undeliverable' THEN 'undeliverable' ELSE 'system' END AS reason
            FROM f_email e JOIN f_deliverability d ON d.email_row_id = e.email_row_id
            WHERE d.deliverability = 'em-av-undeliverable' OR {SYSTEM}"""),
        "email_verifier_queue": mail(f"""SELECT country, count(*) AS waiting_rows,
            count(DISTINCT id) AS waiting_companies FROM {local}
            AND coalesce(trim(verification_status), '') = '' GROUP BY country"""),
    }
