"""Lists, patterns, thresholds and lookup texts that results depend on."""

# --- markets -----------------------------------------------------------------
AUDIT_MARKETS = ("AU", "NZ", "MY", "SG", "HK", "JP", "ID", "PH", "US", "CA")
EMAIL_MARKETS = ("US", "CA", "AU", "NZ", "SG", "MY", "PH", "ID", "JP", "HK", "TH", "VN", "KR")

# --- subscription exports ----------------------------------------------------
VALID_SUBSCRIPTION_STATES = ("trialing", "trialing - pending cancellation", "active")
CRM_URL_MARK = "app.hubspot.com"
JUNK_DOMAINS = ("link missing", "(blank)", "n/a", "na", "none")
DAILY_FILE_PATTERN = r"^(\d{2})_(\d{2})_CTA\.csv$"
DAILY_FILE_SUFFIX = "_CTA.csv"
# header of the daily export -> (column here, kind)
EXPORT_COLUMNS = (
    ("HUBSPOT_DOMAIN_LINK", "customer_domain_raw", "text"),
    ("STRIPE_NAME", "customer_name", "text"),
    ("HUBSPOT_NAME", "crm_name", "text"),
    ("STRIPE_CUSTOMER_ID", "customer_id", "text"),
    ("HUBSPOT_ICP", "icp", "text"),
    ("SUB_STATUS", "sub_status", "text"),
    ("PRODUCT_NAME", "product_name", "text"),
    ("SUB_PLAN_NAME", "sub_plan_name", "text"),
    ("SUB_PLAN_INTERVAL", "sub_plan_interval", "text"),
    ("SUB_PLAN_AMOUNT_AUD", "sub_plan_amount_aud", "float"),
    ("SUB_CREATED", "sub_created", "text"),
    ("STRIPE_BILLING_COUNTRY", "billing_country", "text"),
    ("AVAILABLE_MONTHLY_SUBSCRIPTION_CREDITS", "monthly_credits", "int"),
    ("HUBSPOT_SALES_TEAM_SIZE", "sales_team_size", "int"),
    ("STRIPE_CURRENCY", "currency", "text"),
    ("SEATS", "seats", "int"),
)

# --- catalog -----------------------------------------------------------------
SYNTHETIC_ID_LIKE = "SYNTH_%"
NO_INDUSTRY = "Unclassified"
NO_DATA = "No data available"

# --- people and company input files ------------------------------------------
# header (case-folded) -> column here; several headers may feed one column
INPUT_ALIASES = (
    ("full name", "full_name"),
    ("first name", "first_name"),
    ("last name", "last_name"),
    ("title", "title"),
    ("company name", "company"),
    ("location", "location"),
    ("domain", "domain"),
    ("person linkedin", "profile_link"),
    ("country code", "country"),
    ("criteria", "criteria"),
    ("competitor", "source"),
    ("source", "source"),
    ("data source", "source"),
    ("provider", "source"),
    ("competitor name", "source"),
)
PERSON_SLUG_PATTERN = r"linkedin\.com/in/([^/?#\s]+)"
COMPANY_SLUG_PATTERN = r"linkedin\.com/company/([^/?#\s]+)"
PAYLOAD_PLATFORM = "LN"
PAYLOAD_REQUEST = "PROFILE"
PAYLOAD_PRIORITY = "P3-LOW"
PAYLOAD_STATE = "COMPLETED"

# --- e-mail classes ----------------------------------------------------------
# body of the well-formed pattern; it has to cover the whole address
EMAIL_FORMAT = r"[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}"
SYSTEM_LOCAL_PARTS = (
    "noreply", "no-reply", "donotreply", "do-not-reply", "bounce", "unsubscribe",
    "mailer-daemon", "postmaster", "abuse", "spam",
)
GENERIC_LOCAL_PARTS_BASIC = (
    "admin", "webmaster", "hostmaster", "root", "support", "info", "hello", "help", "contact",
    "sales", "enquir", "billing", "accounts", "hr", "careers", "jobs", "marketing", "press",
    "media", "legal", "privacy", "service", "team", "office", "reception", "general",
)
GENERIC_LOCAL_PARTS_REGIONAL = GENERIC_LOCAL_PARTS_BASIC + (
    "enquiries", "customerservice", "cs", "operations",
)
FREE_DOMAINS_BASIC = (
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "icloud.com", "live.com", "aol.com",
    "protonmail.com", "mail.com",
)
FREE_DOMAINS_REGIONAL = FREE_DOMAINS_BASIC + (
    "yahoo.co.jp", "yahoo.co.id", "naver.com", "daum.net", "kakao.com",
)
VERIFICATION_STATES = ("Highly likely", "Likely", "Unsure")
UNDELIVERABLE = "em-av-undeliverable"
DELIVERABILITY_STATES = (
    "em-av-undeliverable", "em-av-highly-likely", "em-av-likely", "em-av-unsure",
)

# --- weekly e-mail issues ----------------------------------------------------
# Fixed output texts and numbers: the last text of a row is the value of ``root_cause``.
# (category, issue, affected column, base column of the dashboard percent,
#  base column of the score impact, root cause, weight in tenths)
ISSUES = (
    ("Coverage", "Missing Email", "missing_email", "total_companies", "total_companies",
     "Companies in this market have no email tagged to their HQ country — source pipeline gap or no ingestion coverage", 5),
    ("Coverage", "Domain Gap", "has_fqdn_no_email", "companies_with_fqdn", "companies_with_fqdn",
     "Company has a website domain (FQDN) but no email — highest-confidence backfill target via domain scraping", 5),
    ("Quality", "Unverified", "unverified", "total_email_rows", "total_email_rows",
     "Emails were ingested but never run through the verifier waterfall (Findymail → Million Verifier → BounceBan)", 3),
    ("Quality", "Undeliverable", "undeliverable", "total_email_rows", "total_email_rows",
     "Verifier returned em-av-undeliverable — these emails are live in product and causing hard bounces", 3),
    ("Quality", "Never Checked", "not_checked", "total_email_rows", "total_email_rows",
     "Emails have no deliverability record — verifier waterfall has not been triggered for this market or source", 3),
    ("Quality", "Domain Mismatch", "domain_mismatch", "domain_pairs", "domain_pairs",
     "Email domain does not match company FQDN — likely GMAPS crawl assigning one domain's emails to all companies on that block", 3),
    ("Noise", "Generic Role-Based", "generic_role_based", "total_email_rows", "total_email_rows",
     "info@/contact@/sales@ emails ranked above specific emails — type-based ranking not applied at ingestion", 2),
)
# weights of coverage, accuracy and consistency in the overall score
SCORE_WEIGHTS = (0.5, 0.3, 0.2)

# --- thresholds --------------------------------------------------------------
QUALITY_BANDS = ((90, "EXCELLENT"), (75, "GOOD"), (60, "FAIR"), (40, "NEEDS WORK"))
LOWEST_BAND = "POOR"
DIRECTION_MARGIN = 2
MAX_EMAILS_PER_COMPANY = 5
SHARED_ADDRESS_COMPANIES = 5
# (alert, metric column of the country summary, breach when, limit)
RELEASE_ALERTS = (
    ("coverage", "pct_with_email", "below", 40.0),
    ("system_rate", "pct_system_blocked", "above", 2.0),
    ("domain_mismatch", "pct_mismatch", "above", 20.0),
    ("unverified", "pct_unverified", "above", 30.0),
    ("excessive", "pct_gt5", "above", 5.0),
)
# points of coverage a market may lose between two runs
COVERAGE_DROP_LIMITS = (("AU", 5.0), ("US", 3.0))
MISMATCH_WATCH = (("KR", 30.0), ("TH", 30.0))
GENERIC_LIMIT = 40.0
