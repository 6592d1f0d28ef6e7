"""E-mail quality: one-table profiles, joins with the company hub, publishing rules.

Inputs: companies (id, hq_country, fqdn, status); emails (id, email_row_id,
email, country, source, verification_status, primary_verifier, primary_status,
enabled); deliverability (email_row_id, country, deliverability).

Rows of one company, address or country are folded by a partial aggregate
before they are shuffled, and joins with the hub use the folded rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.functions import email as E
from recordlens.functions import measure as M
from recordlens.functions import text as T
from recordlens.operators.rows import keep_top, left_join_sparse, replicated, salted

MARKETS = K.EMAIL_MARKETS
SALTS = 16


def in_markets(df: DataFrame, column: str = "country") -> DataFrame:
    return df.filter(F.col(column).isin(*MARKETS))


def well_formed(emails: DataFrame) -> DataFrame:
    return emails.filter(E.is_well_formed(F.col("email")))


def _share(df: DataFrame, group: list[Column], within: list[str], count: str, pct: str) -> DataFrame:
    """Counts per group and their percent of the total (or of the outer group)."""
    counted = df.groupBy(*group).agg(F.count("*").alias(count))
    if within:
        total = F.sum(count).over(Window.partitionBy(*within))
    else:
        total = counted.agg(F.sum(count)).scalar()
    return counted.withColumn(pct, M.pct(F.col(count), total))


def _country() -> Column:
    return T.label(F.col("country"), "UNKNOWN").alias("country")


# --- profiles of the e-mail table ----------------------------------------------


def rows_by_country(emails: DataFrame) -> DataFrame:
    return in_markets(emails).groupBy("country").agg(
        F.count("*").alias("total_email_rows"), F.countDistinct("id").alias("distinct_companies")
    )


def formats(emails: DataFrame) -> DataFrame:
    group = E.format_class(F.col("email")).alias("format_status")
    return _share(emails, [group], [], "email_rows", "pct")


def types(emails: DataFrame, rules: str = "basic", match: str = "find") -> DataFrame:
    group = E.type_class(F.col("email"), rules, match).alias("email_type")
    return _share(well_formed(emails), [group], [], "email_rows", "pct")


def types_by_country(emails: DataFrame, rules: str = "regional", match: str = "find") -> DataFrame:
    group = [F.col("country"), E.type_class(F.col("email"), rules, match).alias("email_type")]
    rows = well_formed(in_markets(emails))
    return _share(rows, group, ["country"], "email_rows", "pct_of_country")


def system_rate(emails: DataFrame, limit: int = 20) -> DataFrame:
    """Countries with the highest share of system addresses."""
    system = F.count_if(E.is_system(F.col("email")))
    return (
        well_formed(emails)
        .groupBy(_country())
        .agg(
            F.count("*").alias("total_emails"),
            system.alias("system_blocked"),
            M.pct(system, F.count("*")).alias("pct_system_blocked"),
        )
        .orderBy(F.desc("pct_system_blocked"), F.asc("country"))
        .limit(limit)
    )


def verification(emails: DataFrame) -> DataFrame:
    group = T.label(F.col("verification_status"), "NULL/unverified").alias("verification_status")
    return _share(emails, [group], [], "row_count", "pct")


def _verification_counts() -> list[Column]:
    status = F.col("verification_status")
    known = [
        F.count_if(F.trim(status) == s).alias(s.lower().replace(" ", "_"))
        for s in K.VERIFICATION_STATES
    ]
    return [F.count_if(T.is_blank(status)).alias("unverified"), *known]


def verification_by_country(emails: DataFrame) -> DataFrame:
    unverified = F.count_if(T.is_blank(F.col("verification_status")))
    return in_markets(emails).groupBy("country").agg(
        F.count("*").alias("total"),
        *_verification_counts(),
        M.pct(unverified, F.count("*")).alias("pct_unverified"),
    )


def verifier_status(emails: DataFrame, limit: int = 30) -> DataFrame:
    group = [
        T.label(F.col("primary_verifier"), "NULL").alias("verifier"),
        T.label(F.col("primary_status"), "NULL").alias("status"),
    ]
    shares = _share(emails, group, [], "row_count", "pct")
    return shares.orderBy(F.desc("row_count"), F.asc("verifier"), F.asc("status")).limit(limit)


def enabled(emails: DataFrame) -> DataFrame:
    return _share(emails, [T.flag_text(F.col("enabled")).alias("enabled")], [], "row_count", "pct")


def sources(emails: DataFrame) -> DataFrame:
    group = [F.col("country"), T.label(F.col("source"), "NULL").alias("source")]
    return _share(in_markets(emails), group, ["country"], "email_count", "pct_of_country")


def source_breakdown(emails: DataFrame) -> DataFrame:
    """``sources`` per weekly run, for the history table."""
    group = [F.col("run_date"), F.col("country"), T.label(F.col("source"), "NULL").alias("source")]
    return _share(
        in_markets(emails), group, ["run_date", "country"], "email_count", "pct_of_country"
    )


def excessive(emails: DataFrame, limit: int = K.MAX_EMAILS_PER_COMPANY) -> DataFrame:
    """Companies with more than ``limit`` addresses in a country."""
    per_company = emails.groupBy("id", _country()).agg(
        F.count_if(T.has_text(F.col("email"))).alias("n")
    )
    over = F.count_if(F.col("n") > limit)
    return per_company.groupBy("country").agg(
        F.count("*").alias("company_country_pairs"),
        over.alias("companies_with_gt5_emails"),
        M.pct(over, F.count("*")).alias("pct_gt5"),
    )


def duplicates(emails: DataFrame) -> DataFrame:
    """How many addresses occur once and more often."""
    counts = (
        well_formed(emails)
        .groupBy(E.normal(F.col("email")).alias("address"))
        .agg(F.count("*").alias("n"))
    )
    repeated = F.count_if(F.col("n") > 1)
    return counts.agg(
        F.count("*").alias("total_distinct_emails"),
        F.count_if(F.col("n") == 1).alias("unique_emails"),
        repeated.alias("duplicate_emails"),
        M.pct(repeated, F.count("*")).alias("duplicate_pct"),
    )


def _companies_per_address(emails: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct companies per address; an address on a third of all rows folds first."""
    rows = well_formed(emails).withColumn("address", E.normal(F.col("email")))
    pairs = rows.select(*keys, "address", "id").distinct()
    return pairs.groupBy(*keys, "address").agg(F.count("id").alias("on_n_companies"))


def shared(emails: DataFrame) -> DataFrame:
    """Addresses on one company and on several, by country."""
    per_address = _companies_per_address(in_markets(emails), ["country"])
    several = F.count_if(F.col("on_n_companies") > 1)
    return per_address.groupBy("country").agg(
        F.count("*").alias("distinct_emails"),
        F.count_if(F.col("on_n_companies") == 1).alias("unique_to_one_co"),
        several.alias("shared_across_cos"),
        M.pct(several, F.count("*")).alias("pct_shared"),
    )


def top_shared(
    emails: DataFrame, more_than: int = K.SHARED_ADDRESS_COMPANIES, limit: int = 40
) -> DataFrame:
    """Most shared addresses with the sources they came from.

    Sources are gathered for the reported addresses only, which are at most
    ``limit`` rows and so may be broadcast.
    """
    top = (
        _companies_per_address(in_markets(emails), ["country"])
        .filter(F.col("on_n_companies") > more_than)
        .orderBy(F.desc("on_n_companies"), F.asc("address"), F.asc("country"))
        .limit(limit)
    )
    rows = well_formed(in_markets(emails)).withColumn("address", E.normal(F.col("email")))
    named = (
        rows.join(F.broadcast(top), ["country", "address"])
        .groupBy("address", "country", "on_n_companies", "source")
        .agg(F.count("*").alias("n"))
    )
    return named.groupBy(F.col("address").alias("email"), "country", "on_n_companies").agg(
        F.array_join(F.sort_array(F.collect_set("source")), ", ").alias("sources")
    )


# --- deliverability --------------------------------------------------------------


def deliverability(deliv: DataFrame) -> DataFrame:
    group = T.label(F.col("deliverability"), "NULL").alias("deliverability")
    return _share(deliv, [group], [], "row_count", "pct")


def deliverability_by_country(deliv: DataFrame) -> DataFrame:
    status = F.col("deliverability")
    states = {s: F.count_if(status == s) for s in K.DELIVERABILITY_STATES}
    unchecked = F.count_if(status.isNull())
    return in_markets(deliv).groupBy("country").agg(
        F.count("*").alias("total"),
        *[c.alias(s.removeprefix("em-av-").replace("-", "_")) for s, c in states.items()],
        unchecked.alias("not_checked"),
        M.pct(states[K.UNDELIVERABLE], F.count("*")).alias("pct_undeliverable"),
        M.pct(unchecked, F.count("*")).alias("pct_not_checked"),
    )


# --- joins with the company hub ----------------------------------------------------


def market_bit(column: str) -> Column:
    """Bit of a market in a company's market mask; NULL outside the markets."""
    cases = " ".join(f"WHEN '{m}' THEN {1 << i}L" for i, m in enumerate(MARKETS))
    return F.expr(f"CASE {column} {cases} END")


def market_masks(emails: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per company that tells in which markets it has which addresses.

    A mask is one number per company, so this is a hash aggregate with a
    map-side part, however many rows a company has.
    """
    email, bit = F.col("email"), market_bit("country")
    mask = lambda cond: F.bit_or(F.when(cond, bit))
    return emails.groupBy(*keys).agg(
        F.count("email").alias("n_present"),
        F.count_if(T.has_text(email)).alias("n_text"),
        F.coalesce(mask(email.isNotNull()), F.lit(0)).alias("present_mask"),
        F.coalesce(mask(email.isNull()), F.lit(0)).alias("absent_mask"),
        F.coalesce(mask(T.has_text(email)), F.lit(0)).alias("text_mask"),
    )


def has_bit(mask: str, bit: Column) -> Column:
    """Never NULL: a company without e-mails has no mask."""
    return F.coalesce(F.col(mask).bitwiseAND(bit) != 0, F.lit(False))


def _hub(companies: DataFrame, scope: str, published: bool) -> DataFrame:
    hub = companies.filter(F.col("status") == "PUBLISHED") if published else companies
    if scope == "any":
        return hub.withColumn("country", T.label(F.col("hq_country"), "UNKNOWN"))
    return in_markets(hub, "hq_country").withColumn("country", F.col("hq_country"))


def _with_masks(hub: DataFrame, emails: DataFrame, scope: str) -> DataFrame:
    """Hub rows with ``has`` (an e-mail in scope) and ``other`` (only elsewhere)."""
    joined = hub.join(market_masks(emails), "id", "left")
    n_text = F.coalesce("n_text", F.lit(0))
    here = has_bit("text_mask", market_bit("country"))
    has = {
        "any": F.coalesce("n_present", F.lit(0)) > 0,
        "market_set": F.coalesce("present_mask", F.lit(0)) != 0,
        "hq": here,
    }[scope]
    # the join left rows of one id together: this groupBy needs no further shuffle
    return joined.groupBy("id", "country").agg(
        F.max(has).alias("has"), F.max((n_text > 0) & ~here).alias("other")
    )


def coverage(companies: DataFrame, emails: DataFrame, scope: str = "any") -> DataFrame:
    """Companies with and without an e-mail, by country of the head office.

    ``any``: published companies, an e-mail in any country (also a blank one).
    ``market_set``: the same within the markets, on both sides.
    ``hq``: all companies of the markets, a non-blank e-mail in the very country.
    """
    hub = _hub(companies, scope, published=scope != "hq")
    rows = _with_masks(hub, emails, scope)
    has, total = F.count_if(F.col("has")), F.count("*")
    missing = F.count_if(~F.col("has"))
    out = [
        total.alias("total_companies"),
        has.alias("with_email"),
        missing.alias("missing_email"),
        M.pct(has, total).alias("pct_with_email"),
        M.pct(missing, total).alias("pct_missing"),
    ]
    if scope == "hq":
        out.append(F.count_if(F.col("other")).alias("has_email_other_market"))
    return rows.groupBy("country").agg(*out)


def fqdn_gap(companies: DataFrame, emails: DataFrame, scope: str = "any") -> DataFrame:
    """Companies that have a host name and no e-mail.

    ``any`` and ``market_set`` look at published companies, as ``coverage``.
    ``hq`` looks at e-mail rows of the very country and at whether the address
    is NULL: a blank one counts as an e-mail, and a company with both a NULL and
    a real address counts on both sides.
    """
    hub = _hub(companies.filter(T.has_text(F.col("fqdn"))), scope, published=scope != "hq")
    if scope != "hq":
        rows = _with_masks(hub, emails, scope)
        has, without = F.col("has"), ~F.col("has")
    else:
        bit = market_bit("country")
        joined = hub.join(market_masks(emails), "id", "left")
        present, absent = has_bit("present_mask", bit), has_bit("absent_mask", bit)
        rows = joined.groupBy("id", "country").agg(
            F.max(present).alias("has"), F.max(absent | ~present).alias("without")
        )
        has, without = F.col("has"), F.col("without")
    return rows.groupBy("country").agg(
        F.count("*").alias("companies_with_fqdn"),
        F.count_if(without).alias("missing_email"),
        F.count_if(has).alias("has_email"),
        M.pct(F.count_if(without), F.count("*")).alias("pct_missing"),
    )


def root_counts(emails: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Addresses with an '@' per key and domain root."""
    return (
        emails.filter(F.col("email").contains("@"))
        .groupBy(*keys, T.email_root(F.col("email")).alias("root"))
        .agg(F.count("*").alias("n"))
    )


def comparable_hosts(companies: DataFrame) -> DataFrame:
    """Companies whose host name has a dot, with its root."""
    return companies.filter(T.has_text(F.col("fqdn")) & F.col("fqdn").contains(".")).select(
        "id", "hq_country", T.domain_root(F.col("fqdn")).alias("root")
    )


def domain_pairs(companies: DataFrame, emails: DataFrame, scope: str, keys: tuple[str, ...]) -> DataFrame:
    """Company-address pairs and matches per key and head-office country.

    Addresses fold by (company, root) before they meet the hub. All of them
    count as pairs; those that also share the hub's root, found by an equi join
    on (company, root), count as matches. A company with very many addresses is
    spread over its roots and is one row per key in the join on the company.
    """
    hub = comparable_hosts(companies)
    at = ["id"]
    if scope != "any":
        hub = in_markets(hub, "hq_country")
        emails = in_markets(emails)
    if scope == "hq":
        hub = hub.withColumn("country", F.col("hq_country"))
        at = ["id", "country"]
    counts = root_counts(emails, (*keys, *at))
    pairs = (
        counts.groupBy(*keys, *at).agg(F.sum("n").alias("pairs"))
        .join(hub, at)
        .groupBy(*keys, "hq_country")
        .agg(F.sum("pairs").alias("pairs"))
    )
    matches = (
        counts.filter(F.col("root") != "")
        .join(hub, [*at, "root"])
        .groupBy(*keys, "hq_country")
        .agg(F.sum("n").alias("matches"))
    )
    return (
        pairs.unionByName(matches, allowMissingColumns=True)
        .groupBy(*keys, "hq_country")
        .agg(
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
            F.coalesce(F.sum("matches"), F.lit(0)).alias("matches"),
        )
    )


def domain_mismatch(
    companies: DataFrame, emails: DataFrame, scope: str = "any", limit: int | None = None
) -> DataFrame:
    """Agreement of address and company host, by head-office country.

    ``limit`` keeps the countries with the highest mismatch (a top-n report).
    """
    country = F.col("hq_country") if scope != "any" else T.label(F.col("hq_country"), "UNKNOWN")
    total, match = F.sum("pairs"), F.sum("matches")
    out = (
        domain_pairs(companies, emails, scope, ())
        .groupBy(country.alias("country"))
        .agg(
            total.alias("total_pairs"),
            match.alias("domain_match"),
            (total - match).alias("domain_mismatch"),
            M.pct(match, total).alias("pct_match"),
            M.pct(total - match, total).alias("pct_mismatch"),
        )
    )
    if limit is not None:
        out = out.orderBy(F.desc("pct_mismatch"), F.asc("country")).limit(limit)
    return out


# --- publishing rules ----------------------------------------------------------------


def quality_gate(
    companies: DataFrame,
    emails: DataFrame,
    deliv: DataFrame,
    require_enabled: bool = True,
    exceptions: DataFrame | None = None,
    top: int = K.MAX_EMAILS_PER_COMPANY,
) -> DataFrame:
    """Addresses that may be published, at most ``top`` per company and country.

    An address passes when it is well formed, enabled, not a system address,
    not known as undeliverable (never checked passes), and its root is the root
    of a published company's host or an exception ``(id, root)`` allowed for it. A
    free-provider address passes only for a published company that has no
    well-formed address on its own host in the whole table. Order within a
    company and country: own host, deliverability, specific before role
    addresses, then the address and the row id.
    """
    email = F.col("email")
    rows = (
        emails.withColumn("root", T.email_root(email))
        .withColumn("well_formed", E.is_well_formed(email))
    )
    published = companies.filter(F.col("status") == "PUBLISHED")
    allowed = comparable_hosts(published).filter(F.col("root") != "").select("id", "root")
    own = rows.filter("well_formed").select("id", "root").distinct().join(allowed, ["id", "root"])
    without_own = published.select("id").distinct().join(own.select("id"), "id", "left_anti")
    if exceptions is not None:
        known = exceptions.select("id", "root").join(published.select("id"), "id", "left_semi")
        allowed = allowed.unionByName(known)
    allowed = allowed.distinct()

    kept = rows.filter(F.col("well_formed") & ~E.is_system(email))
    if require_enabled:
        kept = kept.filter(F.col("enabled"))
    candidates = (
        kept.join(deliv.select("email_row_id", "deliverability"), "email_row_id", "left")
        .filter(~F.col("deliverability").eqNullSafe(F.lit(K.UNDELIVERABLE)))
        .select(
            "id", "country", "email_row_id", "root", E.normal(email).alias("email"),
            E.type_class(email).alias("email_type"),
            _deliverability_rank().alias("deliverability_rank"),
        )
    )
    order = [
        F.col("deliverability_rank"),
        F.when(F.col("email_type") == "generic_role_based", 1).otherwise(0),
        F.col("email"),
        F.col("email_row_id"),
    ]
    # Rows of one root pass or fail together (free ones apart), so the first rows
    # per root are all that can reach the result. Joins see these rows only.
    free = F.col("email_type") == "free_provider"
    best = keep_top(candidates, ["id", "country", "root", free], order, top)
    matched, alone = F.col("domain_match"), F.col("without_own")
    passed = (
        best.join(allowed.withColumn("domain_match", F.lit(True)), ["id", "root"], "left")
        .withColumn("domain_match", F.coalesce(matched, F.lit(False)))
        .filter(matched | free)
        .join(without_own.withColumn("without_own", F.lit(True)), "id", "left")
        .filter(matched | alone)
        .drop("without_own")
    )
    return keep_top(passed, ["id", "country"], [F.when(matched, 0).otherwise(1), *order], top)


def _deliverability_rank() -> Column:
    """0 best: confirmed, likely, unsure, then not checked."""
    state = F.col("deliverability")
    return (
        F.when(state == "em-av-highly-likely", 0)
        .when(state == "em-av-likely", 1)
        .when(state == "em-av-unsure", 2)
        .otherwise(3)
    )


def top_per_company(
    emails: DataFrame, deliv: DataFrame, top: int = K.MAX_EMAILS_PER_COMPANY
) -> DataFrame:
    """The best addresses of every company, for display; nothing is excluded.

    Order: not a system address, not free, specific, deliverability; then the
    address and the row id, so that ties have an order.
    """
    email = F.col("email")
    kind = F.col("email_type")
    ranked = (
        emails.filter(T.has_text(email))
        .join(deliv.select("email_row_id", "deliverability"), "email_row_id", "left")
        .select(
            "id", "country", "email_row_id", E.normal(email).alias("email"),
            E.type_class(email).alias("email_type"),
            _deliverability_rank().alias("deliverability_rank"),
        )
    )
    order = [
        F.when(kind == "system_blocked", 1).otherwise(0),
        F.when(kind == "free_provider", 1).otherwise(0),
        F.when(kind == "specific_company", 0).otherwise(1),
        F.col("deliverability_rank"),
        F.col("email"),
        F.col("email_row_id"),
    ]
    return keep_top(ranked, ["id"], order, top)


def dedupe_shared(
    companies: DataFrame, emails: DataFrame, more_than: int = K.SHARED_ADDRESS_COMPANIES
) -> DataFrame:
    """Well-formed rows; of addresses on many companies only those on the own host.

    The list of shared addresses is short next to the table, so it is copied per
    salt and the rows of one address spread over the salts.
    """
    rows = well_formed(emails).withColumn("address", E.normal(F.col("email")))
    shared_list = (
        _companies_per_address(emails, [])
        .filter(F.col("on_n_companies") > more_than)
        .select("address", F.lit(True).alias("is_shared"))
    )
    flagged = salted(rows, ["email_row_id"], SALTS).join(
        replicated(shared_list, SALTS), ["address", "_salt"], "left"
    )
    key = F.concat_ws("\x00", "id", "root")
    hosts = comparable_hosts(companies).filter(F.col("root") != "")
    hosts = hosts.select(key.alias("own_key")).distinct().withColumn("own", F.lit(True))
    keyed = flagged.withColumn("root", T.email_root(F.col("address"))).withColumn(
        "own_key", F.when(F.col("is_shared"), key)
    )
    return (
        left_join_sparse(keyed, hosts, "own_key", "email_row_id")
        .filter(F.col("is_shared").isNull() | F.col("own"))
        .select("id", "country", "email_row_id", F.col("address").alias("email"))
    )


def suppress(emails: DataFrame, deliv: DataFrame) -> DataFrame:
    """Rows to switch off: known as undeliverable, or a system address."""
    bad = (
        deliv.filter(F.col("deliverability") == K.UNDELIVERABLE)
        .select("email_row_id", F.lit(True).alias("undeliverable"))
        .distinct()
    )
    system = E.is_system(F.col("email"))
    reason = F.when(F.col("undeliverable"), "undeliverable").when(system, "system")
    return (
        emails.join(bad, "email_row_id", "left")
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select("email_row_id", "id", "country", "reason")
    )


def verifier_queue(emails: DataFrame) -> DataFrame:
    """Rows that wait for verification, per market."""
    waiting = in_markets(well_formed(emails)).filter(T.is_blank(F.col("verification_status")))
    return waiting.groupBy("country").agg(
        F.count("*").alias("waiting_rows"),
        F.countDistinct("id").alias("waiting_companies"),
    )
