"""Display values: dates, ages, freshness and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MICROS_PER_HOUR = 3_600_000_000.0
_MICROS_PER_DAY = 24 * _MICROS_PER_HOUR

# Age texts shown to readers.
AGE_NOW = "방금 전"
AGE_HOURS = "시간 전"
AGE_DAYS = "일 전"
MISSING = "-"

# Freshness tones.
HEALTHY, WATCH, STALE, NEUTRAL = "healthy", "watch", "stale", "neutral"


def utc_instant(wall_clock: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session zone is."""
    return F.to_timestamp(F.concat(wall_clock.cast("string"), F.lit("Z")))


def _hours_between(now: Column, then: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / F.lit(_MICROS_PER_HOUR)


def age_bucket(seen_at: Column, now: Column) -> Column:
    """Age text of an instant: just now, whole hours up to a day, then whole days."""
    hours = _hours_between(now, seen_at)
    return (
        F.when(seen_at.isNull(), MISSING)
        .when(hours < 1, AGE_NOW)
        .when(hours < 24, F.concat(F.floor(hours).cast("string"), F.lit(AGE_HOURS)))
        .otherwise(F.concat(F.floor(hours / 24).cast("string"), F.lit(AGE_DAYS)))
    )


def freshness_tone(last_loaded_at: Column, latest_post_date: Column, now: Column) -> Column:
    """Tone of a load instant and a newest post day (its UTC midnight) at ``now``."""
    hours = _hours_between(now, last_loaded_at)
    midnight = F.unix_date(latest_post_date).cast("double") * F.lit(_MICROS_PER_DAY)
    days = (F.unix_micros(now) - midnight) / F.lit(_MICROS_PER_DAY)
    return (
        F.when(last_loaded_at.isNull() | latest_post_date.isNull(), NEUTRAL)
        .when((hours <= 12) & (days <= 1), HEALTHY)
        .when((hours <= 24) & (days <= 2), WATCH)
        .otherwise(STALE)
    )


def date_label(value: Column) -> Column:
    """First ten characters of a date or timestamp text; ``-`` when missing or empty."""
    text = F.nullif(value.cast("string"), F.lit(""))
    return F.coalesce(F.left(text, F.lit(10)), F.lit(MISSING))


def month_label(value: Column) -> Column:
    """First seven characters of a date text."""
    return F.left(value.cast("string"), F.lit(7))


def with_bar_share(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Each value in percent of the greatest of the shown rows, which counts as at least 1.

    The shown rows are one page, so a window over them is small, and they are computed once.
    """
    top = F.greatest(F.max(value).over(Window.partitionBy()).cast("double"), F.lit(1.0))
    return df.withColumn(name, F.col(value) / top * F.lit(100.0))


def with_first_row_share(
    df: DataFrame, value: str, rank: str = "rank", name: str = "share"
) -> DataFrame:
    """Each value in percent of the first shown row; 0 when that row holds 0."""
    first = F.min_by(value, rank).over(Window.partitionBy()).cast("double")
    share = F.col(value) / F.nullif(first, F.lit(0.0)) * F.lit(100.0)
    return df.withColumn(name, F.coalesce(share, F.lit(0.0)))
