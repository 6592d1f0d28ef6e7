"""Cleaning of domains, links, numbers, labels and JSON values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlens import constants as K

_NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
_LARGEST = 1.7976931348623157e308


# every character that counts as white space in a text file
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks as SQL trim does."""
    return F.btrim(c, F.lit(_SPACES))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def has_text(c: Column) -> Column:
    """Never NULL: true when a value other than blanks is there."""
    return c.isNotNull() & (F.trim(c) != "")


def label(c: Column, missing: str) -> Column:
    """The trimmed value, or a label for NULL and blank."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(missing))


def clean_domain(raw: Column) -> Column:
    """Bare lower-case host of a domain or link; NULL for CRM links and junk words."""
    text = F.lower(strip(raw))
    junk = text.contains(K.CRM_URL_MARK) | text.isin(*K.JUNK_DOMAINS)
    host = F.regexp_replace(F.regexp_replace(text, r"^https?://", ""), r"^www\.", "")
    host = strip(F.split_part(host, F.lit("/"), F.lit(1)))
    return F.when(~junk, F.nullif(host, F.lit("")))


def company_slug(raw: Column) -> Column:
    """Slug of a company profile link; other text is taken as the slug itself."""
    text = F.lower(strip(F.coalesce(raw, F.lit(""))))
    slug = F.regexp_extract(text, K.COMPANY_SLUG_PATTERN, 1)
    return F.regexp_replace(F.when(slug != "", slug).otherwise(text), r"/+$", "")


def person_slug(raw: Column) -> Column:
    """Slug of a personal profile link; '' for anything else."""
    text = F.lower(strip(F.coalesce(raw, F.lit(""))))
    return F.regexp_extract(text, K.PERSON_SLUG_PATTERN, 1)


def run_id(day: Column, prefix: str) -> Column:
    return F.date_format(day, f"'{prefix}'yy.MM.dd")


def md5_key(*parts: Column) -> Column:
    """MD5 of the parts put together, NULL taken as ''."""
    return F.md5(F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _number(raw: Column) -> Column:
    return F.when(raw.rlike(_NUMBER), raw.try_cast("double"))


def safe_float(raw: Column) -> Column:
    """Number in a text field, NULL when it is not a finite number."""
    value = _number(raw)
    return F.when(value.between(-_LARGEST, _LARGEST), value)


def safe_int(raw: Column) -> Column:
    """Number in a text field cut toward zero, NULL when it is not one or does not fit."""
    return _number(raw).try_cast("bigint")


def first_map_value(json: Column) -> Column:
    """Value of the smallest key of a JSON object of strings."""
    entries = F.from_json(json, "map<string,string>")
    key = F.array_min(F.map_keys(entries))
    return F.when(F.size(entries) > 0, F.try_element_at(entries, key))


def unless(c: Column, sentinel: str) -> Column:
    return F.nullif(c, F.lit(sentinel))


def json_text(json: Column, path: str) -> Column:
    return F.get_json_object(json, path)


def payload_value(raw: Column, path: str, kind: str) -> Column:
    """Value of a payload path; NULL when the JSON or the value cannot be read."""
    return F.try_variant_get(F.try_parse_json(raw), path, kind)


def domain_root(fqdn: Column) -> Column:
    return F.split_part(F.lower(F.trim(fqdn)), F.lit("."), F.lit(1))


def email_root(email: Column) -> Column:
    host = F.split_part(F.lower(F.trim(email)), F.lit("@"), F.lit(2))
    return F.split_part(host, F.lit("."), F.lit(1))


def flag_text(flag: Column) -> Column:
    return F.coalesce(flag.cast("string"), F.lit("NULL"))


def date_parts(day: Column) -> list[Column]:
    return [
        F.year(day).alias("run_year"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("run_quarter"),
        F.month(day).alias("run_month"),
        F.date_format(day, "MMM").alias("run_month_name"),
    ]
