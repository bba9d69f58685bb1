"""Labels and scores as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400.0

# Fixed values of the freshness profile.
FRESHNESS_BOOST = 2.0
FRESHNESS_DAYS = 7


def dominant_sentiment(positive: Column, negative: Column, neutral: Column, mode: str = "cascade") -> Column:
    """Label of averaged scores.

    ``cascade`` is the established rule: positive wins against negative alone, negative then has to
    beat neutral, NULLs end at neutral. ``argmax`` compares all three.
    """
    if mode == "argmax":
        top = F.greatest(positive, negative, neutral)
        return F.when(top == positive, "positive").when(top == negative, "negative").when(top == neutral, "neutral")
    if mode != "cascade":
        raise ValueError(f"unknown mode {mode!r}")
    return (
        F.when(positive >= negative, F.lit("positive"))
        .when(negative > neutral, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def trend_score(current: Column, prior: Column) -> Column:
    return F.round(current / (prior + F.lit(1)), 4)


def freshness(
    published_at: Column, as_of: Column, boost: float = FRESHNESS_BOOST, days: int = FRESHNESS_DAYS
) -> Column:
    """Score factor from ``boost`` for a new article down to 1 after ``days``, logarithmic decay."""
    age = (F.unix_micros(as_of) - F.unix_micros(published_at)) / F.lit(DAY_SECONDS * 1e6 * days)
    share = (
        F.when(published_at.isNull() | (age >= 1), F.lit(0.0))
        .when(age <= 0, F.lit(1.0))
        .otherwise(F.lit(1.0) - F.log(F.lit(1.0) + age * F.lit(math.e - 1)))
    )
    return F.lit(1.0) + F.lit(boost - 1.0) * share
