"""Percents, scores, bands and directions.

Percents are taken from whole numbers with integer arithmetic, so that a tie at
the third digit is always rounded up and no result depends on the order in
which partial sums of doubles happen to arrive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlens import constants as K


def int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole with two digits, for counts; NULL when whole is NULL or 0."""
    whole = F.nullif(whole, F.lit(0))
    return int_div(part.cast("bigint") * 20000 + whole, whole * 2) / 100


def signed_pct(part: Column, whole: Column) -> Column:
    """As pct, for a part that may be negative: the size is rounded, not the value."""
    return pct(F.abs(part), whole) * F.signum(part.cast("double"))


def mean_pct(c: Column, digits: int = 2) -> Column:
    """Average of a two-digit percent column, exact, rounded to 1 or 2 digits."""
    total = F.sum(F.round(c * 100).cast("bigint"))
    step = 10 ** (2 - digits)
    count = F.nullif(F.count(c), F.lit(0))
    return int_div(total * 2 + count * step, count * (2 * step)) / 10**digits


def round2(c: Column) -> Column:
    """Two digits, halves up; for values that are not negative."""
    return F.floor(c * 100 + 0.5) / 100


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Into [low, high], with NULL kept (greatest and least skip NULLs)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def flag(condition: Column) -> Column:
    """1 or 0, also for a NULL condition."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def quality_band(score: Column) -> Column:
    cases = [(score >= low, name) for low, name in K.QUALITY_BANDS]
    first = F.when(cases[0][0], cases[0][1])
    return reduce(lambda c, case: c.when(*case), cases[1:], first).otherwise(K.LOWEST_BAND)


def direction(delta: Column) -> Column:
    return (
        F.when(delta.isNull(), "FIRST_RUN")
        .when(delta > K.DIRECTION_MARGIN, "IMPROVED")
        .when(delta < -K.DIRECTION_MARGIN, "DECLINED")
        .otherwise("STABLE")
    )


def severity(share: Column) -> Column:
    """Colour of an issue by its share."""
    return F.when(share >= 20, "red").when(share >= 5, "amber").when(share.isNotNull(), "green")


def coverage_colour(share: Column) -> Column:
    return F.when(share < 50, "red").when(share <= 75, "amber").when(share.isNotNull(), "green")


def weighted_score(coverage: Column, accuracy: Column, consistency: Column) -> Column:
    w = K.SCORE_WEIGHTS
    return round2(coverage * w[0] + accuracy * w[1] + consistency * w[2])
