"""Numeric expressions of the trend score and of the price cards."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the scoring rule.
DAILY_RETENTION = 0.666667
SECONDS_PER_DAY = 86400.0
SATURATION_OFFSET = 2.0
DEAD_BELOW = 0.001


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sentiment_text(summary: Column | str, title: Column | str) -> Column:
    """Summary if it has characters, else title, else empty."""
    return F.coalesce(
        F.nullif(_col(summary), F.lit("")), F.nullif(_col(title), F.lit("")), F.lit("")
    )


def volume_saturation(volume: Column | str) -> Column:
    volume = _col(volume).cast("double")
    return volume / (volume + SATURATION_OFFSET)


def surge(sentiment: Column | str, volume: Column | str, cohesion: Column | str) -> Column:
    return _col(sentiment) * volume_saturation(volume) * _col(cohesion)


def elapsed_seconds(since: Column | str, as_of: Column) -> Column:
    """Seconds with their fraction; negative when ``since`` lies after ``as_of``."""
    return (F.unix_micros(as_of) - F.unix_micros(_col(since))) / F.lit(1_000_000.0)


def decayed(score: Column | str, since: Column | str, as_of: Column) -> Column:
    """Score after a third of it is lost per day. A future ``since`` makes the score grow."""
    return _col(score) * F.pow(F.lit(DAILY_RETENTION), elapsed_seconds(since, as_of) / SECONDS_PER_DAY)


def clamp_unit(value: Column | str) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _col(value)))


def is_dead(score: Column | str) -> Column:
    """Tested on the unrounded score."""
    return F.abs(_col(score)) < DEAD_BELOW


def percent_change(current: Column | str, previous: Column | str) -> Column:
    """Change against the previous value in percent, two places; null for a zero previous value."""
    current, previous = _col(current), _col(previous)
    return F.round((current - previous) / F.nullif(previous, F.lit(0.0)) * 100, 2)
