"""Record monitoring."""

from __future__ import annotations

from oracles.parts import query

PERSONS = ("persons", """
    SELECT *, CASE WHEN slug <> '' AND row_number() OVER (PARTITION BY slug ORDER BY row_no) > 1 THEN '409' END AS status
    FROM (SELECT *, regexp_extract(lower(trim(coalesce(profile_link, ''))),
        'linkedin[.]com/in/([^/?#\\s]+)', 1) AS slug FROM f_person_input)""")
COMPANIES = ("companies", """
    SELECT *, CASE WHEN slug <> '' AND row_number() OVER (PARTITION BY slug ORDER BY row_no) > 1 THEN '409' END AS mark
    FROM (SELECT *, rtrim(CASE WHEN position('linkedin.com/company/' IN lower(profile_link)) > 0
            THEN regexp_extract(lower(profile_link), 'linkedin[.]com/company/([^/?#\\s]+)', 1)
            ELSE lower(trim(profile_link)) END, '/') AS slug FROM f_company_input)""")
LOOKED_UP = ("looked_up", """
    SELECT c.*, p.raw, coalesce(c.mark, CASE WHEN p.slug IS NOT NULL THEN '200' ELSE '404' END) AS status
    FROM companies c LEFT JOIN f_payload p ON p.status = '200' AND p.slug = c.slug AND c.mark IS NULL""")


def queries() -> dict[str, str]:
    found = lambda body: query("f_company_input f_payload", [COMPANIES, LOOKED_UP], body)
    parsed = "CASE WHEN json_valid(raw) THEN raw END"
    # rows numbered over the files; blanks around values do not come through a file
    in_files = lambda body: query("f_company_input f_payload", [COMPANIES, LOOKED_UP], body).replace(
        "FROM f_company_input)", """FROM (SELECT * REPLACE (row_number() OVER (ORDER BY source_file, row_no) AS row_no,
            trim(profile_link) AS profile_link) FROM f_company_input))""")
    return {
        "files_input_marks": in_files("SELECT row_no, company, source, slug, mark AS status FROM companies"),
        "records_run": in_files("""
            SELECT 'F26.04.24' AS run_id, l.row_no, company, l.slug, l.status AS payload_status, l.raw AS payload_raw,
                a.handle, a.status_code
            FROM looked_up l LEFT JOIN (
                SELECT row_no, coalesce(nullif(slug, ''), profile_link) AS handle, CAST(status AS INTEGER) AS status_code
                FROM looked_up WHERE status IN ('200', '404')
                QUALIFY row_number() OVER (PARTITION BY handle ORDER BY row_no) = 1) a ON a.row_no = l.row_no"""),
        "records_mark_duplicates": query("f_person_input", [PERSONS],
            "SELECT row_no, source, country, slug, status FROM persons"),
        "records_mark_company_duplicates": query("f_company_input", [COMPANIES],
            "SELECT row_no, company, slug, mark AS status FROM companies"),
        "records_duplicate_counts": query("f_person_input", [PERSONS], """
            SELECT count(*) AS rows_loaded, count(*) FILTER (WHERE slug <> '') AS rows_with_slug,
                count(*) FILTER (WHERE slug = '') AS rows_no_slug,
                count(*) FILTER (WHERE status = '409') AS rows_duplicate FROM persons"""),
        "records_status_counts": found("SELECT status, count(*) AS rows FROM looked_up GROUP BY status"),
        "records_payload_upsert": found(f"""
            SELECT 'LN' AS platform, handle, 'COMPANY' AS profile_type, 'PROFILE' AS request_type,
                'P3-LOW' AS priority, 'COMPLETED' AS state,
                json_extract_string({parsed}, '$.id') AS profile_id, CAST(status AS INTEGER) AS status_code,
                CAST(json_extract_string({parsed}, '$.post_count') AS DOUBLE) AS post_count, row_no
            FROM (SELECT *, coalesce(nullif(slug, ''), profile_link) AS handle FROM looked_up WHERE status IN ('200', '404'))
            WHERE handle NOT IN (SELECT slug FROM f_payload WHERE status = '404')
            QUALIFY row_number() OVER (PARTITION BY handle ORDER BY row_no) = 1"""),
        "records_landing": found("""
            SELECT 'F26.04.24' AS run_id, row_no, source_file, DATE '2026-04-24' AS file_date, source,
                CAST(NULL AS VARCHAR) AS criteria, CAST(NULL AS VARCHAR) AS full_name,
                CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
                CAST(NULL AS VARCHAR) AS title, company, CAST(NULL AS VARCHAR) AS location,
                CAST(NULL AS VARCHAR) AS domain, profile_link, CAST(NULL AS VARCHAR) AS country, slug,
                status AS payload_status, raw AS payload_raw FROM looked_up"""),
    }
