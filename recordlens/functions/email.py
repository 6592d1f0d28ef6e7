"""Format and type classes of e-mail addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.functions.text import has_text, is_blank


def normal(email: Column) -> Column:
    return F.lower(F.trim(email))


def is_well_formed(email: Column) -> Column:
    """Never NULL: the whole trimmed address fits the pattern."""
    return has_text(email) & normal(email).rlike(rf"\A(?:{K.EMAIL_FORMAT})\z")


def format_class(email: Column) -> Column:
    return (
        F.when(is_blank(email), "empty")
        .when(~email.contains("@"), "invalid_no_at")
        .when(~is_well_formed(email), "invalid_format")
        .otherwise("valid")
    )


def _local_part(email: Column) -> Column:
    return F.split_part(normal(email), F.lit("@"), F.lit(1))


def is_system(email: Column) -> Column:
    return _local_part(email).isin(*K.SYSTEM_LOCAL_PARTS) & email.contains("@")


def is_generic(email: Column, rules: str) -> Column:
    words = {
        "basic": K.GENERIC_LOCAL_PARTS_BASIC,
        "regional": K.GENERIC_LOCAL_PARTS_REGIONAL,
    }[rules]
    return _local_part(email).isin(*words) & email.contains("@")


def is_free(email: Column, rules: str, match: str = "find") -> Column:
    """Free-provider host.

    ``match="find"`` looks for the host inside the address, which is the stated
    intent. ``match="full"`` wants the pattern, which starts at the ``@``, to
    cover the whole address; no well-formed address can do that.
    """
    hosts = {"basic": K.FREE_DOMAINS_BASIC, "regional": K.FREE_DOMAINS_REGIONAL}[rules]
    pattern = "@(" + "|".join(re.escape(h) for h in hosts) + ")"
    if match == "full":
        pattern = rf"\A{pattern}\z"
    return normal(email).rlike(pattern)


def type_class(email: Column, rules: str = "regional", match: str = "find") -> Column:
    """system_blocked, generic_role_based, free_provider or specific_company.

    The rule sets differ in their word lists and in what wins for a role
    address at a free provider: generic in ``basic``, free in ``regional``.
    """
    generic = (is_generic(email, rules), "generic_role_based")
    free = (is_free(email, rules, match), "free_provider")
    second, third = (generic, free) if rules == "basic" else (free, generic)
    return (
        F.when(is_system(email), "system_blocked")
        .when(*second)
        .when(*third)
        .otherwise("specific_company")
    )
