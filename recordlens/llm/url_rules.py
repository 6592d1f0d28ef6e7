"""URL filter: pattern rules found through their rarest literal word."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    """A pattern over host and path with the words that any fitting URL must hold.

    ``text`` is shown as the rule; a listed rule (``site``) wins over a pattern, a
    longer text over a shorter one. Rules without words are tried on every URL.
    """

    text: str
    action: str
    pattern: str
    words: tuple[str, ...]
    site: bool = False


def site_rule(action: str, host: str, path: str = "/") -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    host = host.translate(str.maketrans(UPPER, LOWER))
    pattern = rf"^(?:[^/]*\.)?{_quote(host)}{_quote(path)}"
    # a word at the open end of the path may go on in the URL, so it cannot be asked for
    closed = path if re.search(r"[^A-Za-z0-9]$", path) else re.sub(r"[A-Za-z0-9]+$", "", path)
    return Rule(host + path, action, pattern, _words(host + closed), True)


def path_rule(action: str, part: str) -> Rule:
    """Fits where the path holds ``part`` between characters that are not letters or digits."""
    inner = _quote(part.strip("/"))
    return Rule(part, action, rf"^[^/]*/(?:.*[^A-Za-z0-9])?{inner}(?:[^A-Za-z0-9]|$)", _words(part))


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def _words(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(re.findall(r"[A-Za-z0-9]+", text)))


# The listed sites, and path parts of pages that are not prose.
SITES = (
    site_rule("block", "net"),
    site_rule("allow", "example.net", "/en/"),
    site_rule("block", "example.com", "/de/"),
    site_rule("allow", "org", "/fr/"),
)
PATHS = tuple(
    path_rule("block", p)
    for p in ("/login/", "/signup/", "/cart/", "/checkout/", "/ads/", "/advert/", "/tracking/", "/wp-admin/", "/cgi-bin/")
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.filter(F.split(target, "[^A-Za-z0-9]+"), lambda t: t != ""))


def index_rules(targets: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rules by their rarest word: ``token, text, action, pattern, site``; null where a rule has no word.

    How often the rules' words stand in the URLs is counted over all URLs. Only
    counts of words of rules reach the driver.
    """
    spark = targets.sparkSession
    words = spark.createDataFrame([(w,) for w in sorted({w for r in rules for w in r.words})], "token string")
    seen = (
        targets.select(F.explode(_tokens(F.col("target"))).alias("token"))
        .join(F.broadcast(words) if len(rules) <= BROADCAST_RULES else words, "token", "left_semi")
        .groupBy("token").count()
    )
    counts = {r["token"]: r["count"] for r in seen.collect()}  # at most the words of the rules
    rows = [
        (min(r.words, key=lambda w: (counts.get(w, 0), w), default=None), r.text, r.action, r.pattern, r.site)
        for r in rules
    ]
    return spark.createDataFrame(rows, "token string, text string, action string, pattern string, site boolean")


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = SITES + PATHS,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern_rule`` of every row.

    Distinct host-and-path texts are cut into words; a word fetches the rules
    indexed by it, and only these run their regular expression. The best listed
    site that fits gives ``rule`` and ``verdict``; else the best path rule gives the
    verdict, else ``default``. Rules are configuration held by the driver; up to
    ``BROADCAST_RULES`` the index is broadcast, beyond that joined by a shuffle.

    A null URL, or one without ``://``, has an empty host and path and fits no
    site. Repeated rows are judged alike and all returned; null ids stay null; an
    empty table gives no rows; other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("target", F.concat("host", "path"))
    targets = rows.select("target").distinct()
    index = index_rules(targets, rules)
    few = len(rules) <= BROADCAST_RULES
    small = F.broadcast if few else (lambda df: df)
    found = targets.select("target", F.explode(F.array_append(_tokens(F.col("target")), F.lit(None))).alias("word")).join(
        small(index), F.col("word").eqNullSafe(F.col("token"))
    )
    fits = found.filter(F.expr("target rlike pattern"))
    order = F.struct(F.length("text"), "text", "action")
    best = fits.groupBy("target").agg(
        F.max(F.when(F.col("site"), order)).alias("s"), F.max(F.when(~F.col("site"), order)).alias("p")
    )
    return rows.join(best, "target", "left").select(
        "page_id",
        "host",
        "path",
        F.col("s.text").alias("rule"),
        F.coalesce("s.action", "p.action", F.lit(default)).alias("verdict"),
        F.col("p.text").alias("pattern_rule"),
    )


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    list_filter(
      ['/wp-admin/', '/tracking/', '/checkout/', '/cgi-bin/', '/signup/', '/advert/', '/login/', '/cart/', '/ads/'],
      lambda p: regexp_matches(host || path, '^[^/]*/(?:.*[^A-Za-z0-9])?' || trim(p, '/') || '(?:[^A-Za-z0-9]|$)')
    )[1] AS pattern_rule
  FROM parts
)
SELECT page_id, host, path, rule, pattern_rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
       WHEN rule IS NOT NULL OR pattern_rule IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
