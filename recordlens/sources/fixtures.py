"""Views that give the driver's tables the shape of the engine's inputs.

Each view is a projection of one whole table, written in the SQL that Spark and
DuckDB share, so the same text feeds the engine and its oracle. FIXTURES.md
lists the cases each view plants. There is no row filter anywhere: every view
is as long as its table, and its columns prune and push down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_MARKET = """CASE {key} % 17 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'AU' WHEN 3 THEN 'NZ'
    WHEN 4 THEN 'SG' WHEN 5 THEN 'MY' WHEN 6 THEN 'PH' WHEN 7 THEN 'ID' WHEN 8 THEN 'JP'
    WHEN 9 THEN 'HK' WHEN 10 THEN 'TH' WHEN 11 THEN 'VN' WHEN 12 THEN 'KR' WHEN 13 THEN ' '
    WHEN 14 THEN NULL ELSE 'US' END"""

# the states in which the e-mail tables are seen by three weekly runs, oldest
# first: the number shifts which case a row falls into
EMAIL_RUNS = (("2026-06-05", 2), ("2026-06-12", 1), ("2026-06-19", 0))
LATEST_RUN = EMAIL_RUNS[-1][0]


def _email_keys(run_date: str, k: str) -> list[str]:
    market = _MARKET.format(key="o_custkey")
    return [
        f"CAST('{run_date}' AS DATE) AS run_date",
        "concat('C', o_custkey) AS id",
        "o_orderkey AS email_row_id",
        f"CASE WHEN {k} % 7 = 0 THEN 'US' WHEN {k} % 11 = 0 THEN ' ' ELSE {market} END AS country",
    ]


def _email(run_date: str, shift: int) -> list[str]:
    k = f"(o_orderkey + {shift})"
    return [
        *_email_keys(run_date, k),
        f"""CASE {k} % 13 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'no-at-sign'
            WHEN 3 THEN 'bad@nodot' WHEN 4 THEN concat('NoReply@co', o_custkey, '.com')
            WHEN 5 THEN concat('info@co', o_custkey, '.com')
            WHEN 6 THEN concat('user', o_orderkey, '@gmail.com') WHEN 7 THEN 'support@gmail.com'
            WHEN 8 THEN 'sample@email.com' WHEN 9 THEN concat(' Jo', o_orderkey, '@co', o_custkey, '.com ')
            WHEN 10 THEN concat('operations@co', o_custkey, '.com')
            WHEN 11 THEN concat('k', o_orderkey, '@naver.com')
            ELSE CASE {k} % 2 WHEN 0 THEN 'Abuse@yahoo.com'
            ELSE concat('p', o_orderkey, '@other.org') END END AS email""",
        """CASE o_orderpriority WHEN '1-URGENT' THEN ' ' WHEN '3-MEDIUM' THEN NULL
            ELSE o_orderpriority END AS source""",
        f"""CASE {k} % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'Highly likely'
            WHEN 3 THEN ' Likely' ELSE 'Unsure' END AS verification_status""",
        f"CASE {k} % 3 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' ELSE '' END AS primary_verifier",
        f"""CASE {k} % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'catch-all' WHEN 2 THEN NULL
            ELSE 'unknown' END AS primary_status""",
        f"CASE {k} % 9 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS enabled",
    ]


def _deliverability(run_date: str, shift: int) -> list[str]:
    k = f"(o_orderkey + {shift})"
    return [
        *_email_keys(run_date, k),
        f"""CASE {k} % 8 WHEN 0 THEN 'em-av-undeliverable' WHEN 1 THEN 'em-av-highly-likely'
            WHEN 2 THEN 'em-av-likely' WHEN 3 THEN 'em-av-unsure' WHEN 4 THEN '' ELSE NULL
            END AS deliverability""",
    ]


# view -> (driver table, projection)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "f_company": ("customer", [
        "concat('C', c_custkey) AS id",
        _MARKET.format(key="c_custkey") + " AS hq_country",
        """CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'nodot'
            ELSE concat(' Co', c_custkey, '.com') END AS fqdn""",
        "CASE WHEN c_acctbal < 0 THEN 'DRAFT' ELSE 'PUBLISHED' END AS status",
    ]),
    "f_subscription": ("events", [
        "event_id AS row_no",
        "CAST(ts AS DATE) AS run_date",
        """CASE event_id % 10 WHEN 0 THEN 'link missing' WHEN 1 THEN 'https://app.hubspot.com/contacts/1'
            WHEN 2 THEN ' ' WHEN 3 THEN concat('HTTPS://WWW.Co', user_id, '.com/path/x')
            WHEN 4 THEN concat('http://co', user_id, '.com/') WHEN 5 THEN NULL
            WHEN 6 THEN concat('o', user_id, '.com:8080') WHEN 7 THEN concat('http://acme', user_id, '.io')
            ELSE concat(' co', user_id, '.com') END AS HUBSPOT_DOMAIN_LINK""",
        "concat('cus_', user_id) AS STRIPE_CUSTOMER_ID",
        "CAST(date_trunc('second', ts) AS STRING) AS SUB_CREATED",
        "concat('Customer ', user_id) AS STRIPE_NAME",
        "CASE WHEN user_id % 7 = 0 THEN NULL ELSE concat(' Crm ', user_id, ' ') END AS HUBSPOT_NAME",
        "CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE '' END AS HUBSPOT_ICP",
        """CASE event_type WHEN 'click' THEN 'active' WHEN 'view' THEN 'trialing'
            WHEN 'signup' THEN 'trialing - pending cancellation' WHEN 'purchase' THEN 'canceled'
            ELSE 'past_due' END AS SUB_STATUS""",
        "CASE WHEN value < 5 THEN 'Basic' ELSE 'Pro' END AS PRODUCT_NAME",
        "CASE event_id % 3 WHEN 0 THEN 'Starter' ELSE 'Growth' END AS SUB_PLAN_NAME",
        "CASE event_id % 2 WHEN 0 THEN 'month' ELSE 'year' END AS SUB_PLAN_INTERVAL",
        "CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'n/a' ELSE '99.5' END AS SUB_PLAN_AMOUNT_AUD",
        "CASE user_id % 4 WHEN 0 THEN 'AU' WHEN 1 THEN 'US' ELSE NULL END AS STRIPE_BILLING_COUNTRY",
        "CASE event_id % 5 WHEN 0 THEN '100.9' WHEN 1 THEN '-3.7' ELSE '1e3' END AS AVAILABLE_MONTHLY_SUBSCRIPTION_CREDITS",
        "CASE event_id % 7 WHEN 0 THEN 'ten' WHEN 1 THEN NULL ELSE '8' END AS HUBSPOT_SALES_TEAM_SIZE",
        "CASE user_id % 2 WHEN 0 THEN 'aud' ELSE 'usd' END AS STRIPE_CURRENCY",
        "CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN ' 12.7 ' WHEN 3 THEN NULL ELSE '3' END AS SEATS",
    ]),
    "f_catalog": ("customer", [
        "CASE WHEN c_custkey % 40 = 7 THEN concat('SYNTH_', c_custkey) ELSE concat('C', c_custkey) END AS id",
        "CASE WHEN c_custkey % 9 = 0 THEN ' ' ELSE c_name END AS name",
        """CASE WHEN c_custkey % 3 = 2 THEN concat('https://elsewhere', c_custkey, '.org/') ELSE
            CASE c_custkey % 8 WHEN 0 THEN NULL
            WHEN 3 THEN concat('https://www.my-co', c_custkey - 1, '.com.au/')
            WHEN 5 THEN concat('HTTPS://WWW.CO', c_custkey, '.COM')
            WHEN 6 THEN concat('http://host.co', c_custkey + 1, '.com:8080/co', c_custkey, '.com')
            ELSE concat('https://www.co', c_custkey, '.com/about') END END AS website""",
        """CASE WHEN c_custkey % 3 = 2 THEN
            CASE c_custkey % 5 WHEN 0 THEN NULL ELSE concat('elsewhere', c_custkey, '.org') END
            ELSE CASE c_custkey % 6 WHEN 1 THEN concat('alt', c_custkey, '.net')
            WHEN 4 THEN concat('CO', c_custkey - 1, '.com ')
            ELSE concat('co', c_custkey, '.com') END END AS fqdn""",
        """CASE WHEN c_custkey % 5 = 0 THEN '{}' WHEN c_custkey % 11 = 0 THEN concat('{"linkedin":"CO', c_custkey, '"}')
            ELSE concat('{"linkedin":"https://linkedin.com/company/co', c_custkey, '/"}') END AS social_media""",
        """CASE c_custkey % 4 WHEN 0 THEN '{"i1":"Unclassified"}' WHEN 1 THEN NULL
            ELSE '{"b2":"Retail","a1":"Software"}' END AS industries""",
        """CASE c_custkey % 3 WHEN 0 THEN '{"s":"No data available"}' ELSE '{"s":"11-50"}' END AS company_size""",
        """CASE c_custkey % 7 WHEN 0 THEN '{"r":"No data available"}' WHEN 1 THEN '{}'
            ELSE '{"r":"1M-5M"}' END AS revenue""",
        "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(1950 + c_custkey % 70 AS INT) END AS year_founded",
        """CASE WHEN c_custkey % 16 = 13 THEN '' WHEN c_custkey % 16 = 14 THEN NULL
            ELSE concat('N', c_custkey % 16) END AS hq_country""",
        "CASE WHEN c_nationkey % 5 = 3 THEN NULL WHEN c_nationkey % 5 = 4 THEN ' ' ELSE c_mktsegment END AS company_type",
        "CASE WHEN c_custkey % 5 = 3 THEN NULL ELSE CAST(c_custkey % 900 AS INT) END AS employee_count",
    ]),
    "f_contact": ("orders", [
        "concat('C', o_custkey) AS company_id",
        "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE concat('+61', o_orderkey) END AS primary_phone",
        "CASE WHEN o_custkey % 6 = 0 THEN ' ' ELSE concat('c', o_orderkey, '@x.com') END AS primary_email",
    ]),
    "f_people": ("lineitem", [
        "l_orderkey * 10 + l_linenumber AS id",
        "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE concat('C', l_partkey) END AS company_id",
        """CASE l_suppkey % 6 WHEN 0 THEN 'AU' WHEN 1 THEN 'NZ' WHEN 2 THEN 'US' WHEN 3 THEN 'SG'
            WHEN 4 THEN 'DE' ELSE 'JP' END AS country_code""",
    ]),
    "f_region": ("orders", [
        "concat('C', o_custkey) AS company_id",
        """CASE o_orderkey % 14 WHEN 0 THEN 'AU' WHEN 1 THEN 'NZ' WHEN 2 THEN 'SG' WHEN 3 THEN 'US'
            WHEN 4 THEN 'DE' ELSE 'FR' END AS country_code""",
    ]),
    "f_payload": ("customer", [
        "concat('co', c_custkey) AS slug",
        "CASE WHEN c_custkey % 7 = 0 THEN '404' WHEN c_custkey % 11 = 0 THEN '409' ELSE '200' END AS status",
        """CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 13 = 0 THEN '{broken'
            WHEN c_custkey % 5 = 2 THEN concat('{"id":', c_custkey, ',"employee_count":"n/a","locations":[]}')
            ELSE concat('{"id":', c_custkey, ',"post_count":', c_custkey % 40, ',"employee_count":"', c_custkey % 60,
                '","locations":[{"address":{"country":" au"}},"odd",{"address":"NZ"},7,null,["SG"],{"address":{"country":"US"}},{"address":{"country":"DE"}},{"address":{}}]}')
            END AS raw""",
    ]),
    "f_person_input": ("documents", [
        "doc_id AS row_no",
        "concat('person-', doc_id % 3, '.csv') AS source_file",
        "lang AS country",
        "source",
        "concat('Person ', doc_id) AS full_name",
        """CASE doc_id % 5 WHEN 0 THEN concat('https://www.linkedin.com/in/P-', doc_id % 40, '/?x=1')
            WHEN 1 THEN concat('linkedin.com/in/p-', doc_id % 40)
            WHEN 2 THEN concat('p-', doc_id) WHEN 3 THEN '' ELSE NULL END AS profile_link""",
    ]),
    "f_company_input": ("customer", [
        "c_custkey AS row_no",
        "concat('company-', c_custkey % 3, '.csv') AS source_file",
        "c_mktsegment AS source",
        "c_name AS company",
        """CASE c_custkey % 4 WHEN 0 THEN concat('https://linkedin.com/company/co', c_nationkey, '/')
            WHEN 1 THEN concat('CO', c_custkey, '/') WHEN 2 THEN ' '
            ELSE concat('www.linkedin.com/company/co', c_custkey, '?a=b') END AS profile_link""",
    ]),
}


def _in_file(expr: str) -> str:
    """A column of an export as a CSV file gives it: never NULL, some names with line breaks and quotes."""
    body, name = expr.rsplit(" AS ", 1)
    if name in ("row_no", "run_date"):
        return expr
    if name == "HUBSPOT_NAME":
        body = f"CASE WHEN user_id % 11 = 0 THEN concat('Two', chr(10), '\"lines\", ', user_id) ELSE {body} END"
    return f"coalesce({body}, '') AS {name}"


VIEWS["f_subscription_file"] = ("events", [_in_file(e) for e in VIEWS["f_subscription"][1]])
for _date, _shift in EMAIL_RUNS:
    _suffix = "" if _date == LATEST_RUN else f"_{_shift}"
    VIEWS[f"f_email{_suffix}"] = ("orders", _email(_date, _shift))
    VIEWS[f"f_deliverability{_suffix}"] = ("orders", _deliverability(_date, _shift))


def view_sql(name: str) -> str:
    """The view as a SELECT for the oracle."""
    table, exprs = VIEWS[name]
    return f"SELECT {', '.join(exprs)} FROM {table}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, exprs = VIEWS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*exprs)


def email_history(spark: SparkSession, sf_dir: str, name: str = "f_email") -> DataFrame:
    """The e-mail or deliverability table as all weekly runs saw it."""
    parts = [
        view(spark, sf_dir, name if date == LATEST_RUN else f"{name}_{shift}")
        for date, shift in EMAIL_RUNS
    ]
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionAll(part)
    return frame
