"""Column types of the stored tables, and the check made before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PERIOD = "run_date date, run_year int, run_quarter string, run_month int, run_month_name string"
_CUSTOMER = """customer_domain_raw string, customer_domain string, customer_name string,
    crm_name string, customer_id string, icp string, sub_status string, product_name string,
    sub_plan_name string, sub_plan_interval string, sub_plan_amount_aud double, sub_created string,
    billing_country string"""
_SHARES = """matched_pct double, identity_coverage_pct double, social_coverage_pct double,
    firmographics_coverage_pct double, size_coverage_pct double, contact_coverage_pct double,
    avg_field_coverage_pct double, people_coverage_pct double"""

# metrics of the weekly country summary
SUMMARY_COUNTS = (
    "total_companies", "with_email", "missing_email", "has_email_other_market",
    "companies_with_fqdn", "has_fqdn_no_email", "has_fqdn_with_email",
    "total_email_rows", "specific_company", "generic_role_based", "system_blocked", "free_provider",
    "unverified", "highly_likely", "likely", "unsure",
    "undeliverable", "deliv_highly_likely", "deliv_likely", "deliv_unsure", "not_checked",
    "domain_pairs", "domain_match", "domain_mismatch",
    "company_country_pairs", "companies_gt5_emails",
)
SUMMARY_PERCENTS = (
    "pct_with_email", "pct_missing", "pct_fqdn_no_email", "pct_specific", "pct_generic",
    "pct_system_blocked", "pct_free_provider", "pct_unverified", "pct_undeliverable",
    "pct_not_checked", "pct_mismatch", "pct_gt5",
)

TABLES = {
    "rows": f"""record_id string, run_date date, {_CUSTOMER}, monthly_credits bigint,
        sales_team_size bigint, currency string, seats bigint""",
    "staging": f"""record_id string, {_PERIOD}, {_CUSTOMER}, seats bigint, match_status string,
        catalog_id string, catalog_name string, catalog_website string, catalog_fqdn string,
        catalog_linkedin string, catalog_industry string, catalog_founded_year int,
        catalog_hq_country string, catalog_company_size string, catalog_revenue string,
        catalog_employee_count int, catalog_phone string, catalog_email string,
        people_count bigint""",
    "summary_by_status": f"""{_PERIOD}, sub_status string, total_customers bigint,
        matched_count bigint, unmatched_count bigint, {_SHARES}, total_people bigint""",
    "monitoring": f"""{_PERIOD}, sub_status string, total_customers bigint, total_markets bigint,
        matched_count bigint, unmatched_count bigint, {_SHARES}, matched_with_people_count bigint,
        active_matched_count bigint, active_unmatched_count bigint,
        active_matched_with_people_count bigint, total_people bigint""",
    "email_delta": """run_date date, country string, category string, issue string,
        prev_count bigint, curr_count bigint, delta bigint, delta_pct double, direction string,
        root_cause string, score_impact double""",
    "email_sources": """run_date date, country string, source string, email_count bigint,
        pct_of_country double""",
    "email_summary": "run_date date, country string, " + ", ".join(
        [f"{c} bigint" for c in SUMMARY_COUNTS] + [f"{c} double" for c in SUMMARY_PERCENTS]
    ),
    "email_global": """run_date date, total_distinct_companies bigint, total_markets_13 bigint,
        total_no_location bigint, other_markets bigint, total_company_country_recs bigint,
        overall_quality_score double, avg_coverage_pct double, avg_accuracy_pct double,
        avg_consistency_pct double""",
    "trials": """trial_id string, run_id string, run_date date, domain_raw string, domain string,
        crm_name string, customer_id string, icp string, sub_status string, product_name string,
        plan_amount_aud double, billing_country string, seats bigint""",
    "match": """trial_id string, run_id string, run_date date, domain string, crm_name string,
        customer_id string, match_status string, catalog_id string, catalog_hq_country string,
        catalog_name string, catalog_website string, catalog_linkedin string,
        catalog_industry string, catalog_founded_year int, catalog_company_type string,
        catalog_phone string, catalog_email string""",
    "field_coverage": """trial_id string, run_id string, run_date date, domain string,
        crm_name string, customer_id string, match_status string, catalog_id string,
        name_covered int, website_covered int, linkedin_covered int, industry_covered int,
        founded_year_covered int, hq_country_covered int, company_type_covered int,
        phone_covered int, email_covered int, field_coverage_pct double,
        fields_missing_count int, missing_fields array<string>""",
    "gap_summary": """trial_id string, run_id string, run_date date, domain string,
        crm_name string, customer_id string, catalog_id string, market string,
        field_coverage_pct double, fields_missing_count int, missing_fields array<string>,
        people_count bigint, headcount bigint, people_gap bigint, people_coverage_pct double,
        in_catalog_at_location boolean, payload_has_location boolean, location_gap boolean,
        location_coverage_pct double""",
    "trial_payloads": """trial_id string, run_id string, run_date date, domain string,
        catalog_id string, slug string, payload_status string, payload_raw string,
        payload_slug string""",
    "people_coverage": """trial_id string, run_id string, run_date date, domain string,
        catalog_id string, market string, people_count bigint, headcount bigint,
        employee_coverage_pct double, people_coverage_pct double, people_gap bigint""",
    "location_coverage": """trial_id string, run_id string, run_date date, domain string,
        catalog_id string, market string, in_catalog_at_location boolean,
        payload_has_location boolean, location_gap boolean""",
    "quality_score": """trial_id string, run_id string, run_date date, domain string,
        crm_name string, customer_id string, catalog_id string, match_status string,
        market string, field_coverage_pct double, people_coverage_pct double,
        location_coverage_pct double, quality_score double, fields_missing_count int,
        missing_fields array<string>, people_gap bigint, location_gap_count int,
        prev_quality_score double, prev_run_id string, quality_delta double,
        quality_status string, direction string""",
    "payloads": """platform string, handle string, profile_type string, request_type string,
        priority string, state string, profile_id string, status_code int, post_count double,
        row_no bigint""",
    "landing": """run_id string, row_no bigint, source_file string, file_date date, source string,
        criteria string, full_name string, first_name string, last_name string, title string,
        company string, location string, domain string, profile_link string, country string,
        slug string, payload_status string, payload_raw string, created_at timestamp""",
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order and type; a missing or unknown column is an error."""
    names = [c.split()[0] for c in _split(TABLES[table])]
    kinds = [c.split()[1] for c in _split(TABLES[table])]
    if set(names) != set(df.columns):
        raise ValueError(f"{table}: columns differ: {sorted(set(names) ^ set(df.columns))}")
    return df.select(*[F.col(n).cast(k).alias(n) for n, k in zip(names, kinds)])


def _split(ddl: str) -> list[str]:
    return [part.strip() for part in ddl.split(",")]
