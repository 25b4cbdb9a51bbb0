"""Time columns of the lifecycle jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carlot.functions.text import _as_col


def iso_utc(ts) -> Column:
    """J31 — ISO-8601 text with ``Z`` (``datetime.utcnow().isoformat() + "Z"``)."""
    return F.concat(F.date_format(_as_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def report_day(ts) -> Column:
    """J32 — first ten characters of the ISO text (``YYYY-MM-DD``)."""
    return F.date_format(_as_col(ts), "yyyy-MM-dd")


def report_minute(ts) -> Column:
    """J32 — ``YYYY-MM-DD à HH:MM`` (first sixteen characters, ``T`` → `` à ``)."""
    return F.date_format(_as_col(ts), "yyyy-MM-dd' à 'HH:mm")
