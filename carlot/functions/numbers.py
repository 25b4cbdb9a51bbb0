"""Typing of price, mileage and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carlot.functions.text import WS, _as_col, pystrip


def price_to_double(c) -> Column:
    """J8 — drop ``€``, thin / no-break / plain spaces; digits and dots only → double.

    ``"12.990 €"`` → 12.99 (kept as in the reference); ``"1.2.3"`` → NULL (the reference
    raises there).
    """
    s = pystrip(F.translate(_as_col(c), "€ \u202f\u00a0", ""))
    # digits and dots with at least one digit, else NULL; "1.2.3" fails the cast → NULL.
    # (one reference to the input: a CASE would evaluate it twice)
    return F.nullif(F.regexp_extract(s, r"^([0-9.]*[0-9][0-9.]*)$", 1), F.lit("")).try_cast("double")


def unreadable_price(c) -> Column:
    """Digits and dots that are no number (``"1.2.3"``): the text passes for a price, but has no value."""
    s = F.nullif(F.regexp_extract(pystrip(F.translate(_as_col(c), "€ \u202f\u00a0", "")), r"^([0-9.]*[0-9][0-9.]*)$", 1), F.lit(""))
    return s.isNotNull() & s.try_cast("double").isNull()


def mileage_to_double(c) -> Column:
    """J9 — as J8 with ``km`` removed and no dots allowed."""
    s = pystrip(F.translate(F.replace(_as_col(c), F.lit("km"), F.lit("")), " \u202f\u00a0", ""))
    return F.nullif(F.regexp_extract(s, "^([0-9]+)$", 1), F.lit("")).try_cast("double")


def digits_to_long(c) -> Column:
    """J10 / J19 — every non-digit removed, then integer; NULL when no digit is left.

    ``"12,50 €"`` → 1250 (kept). The definition repairs mojibake first; that step can
    be skipped exactly: re-reading Latin-1 bytes as UTF-8 only touches bytes ≥ 0x80, so
    it never adds or removes an ASCII digit.
    """
    d = F.regexp_replace(_as_col(c), "[^0-9]+", "")
    return F.nullif(d, F.lit("")).try_cast("long")


def first_nonzero(a: Column, b: Column) -> Column:
    """J11 — ``a or b`` over two parsed numbers."""
    return F.coalesce(F.nullif(a, F.lit(0)), b)  # a referenced once


def display_number(c, unit: str) -> Column:
    """J12 / J13 — keep digits and single spaces, append the unit; ``N/A`` when empty."""
    ws = WS()
    # keep digits and whitespace; whitespace runs → one space; strip
    d = F.regexp_replace(_as_col(c), "[^\\p{Nd}" + ws[1:-1] + "]+", "")
    d = F.trim(F.regexp_replace(d, ws + "+", " "))
    return F.coalesce(F.concat(F.nullif(d, F.lit("")), F.lit(" " + unit)), F.lit("N/A"))


def registration_split(c) -> tuple[Column, Column]:
    """J16 — ``MM-YYYY`` → (``MM/YYYY``, ``YYYY``); otherwise (``N/A``, ``N/A``)."""
    s = _as_col(c)
    parts = F.split(s, "-", 2)
    ok = s.isNotNull() & (s != "") & F.contains(s, F.lit("-"))
    date_mec = F.when(ok, F.concat(F.get(parts, 0), F.lit("/"), F.get(parts, 1))).otherwise(F.lit("N/A"))
    annee = F.when(ok, F.get(parts, 1)).otherwise(F.lit("N/A"))
    return date_mec, annee


def year_prefix4(c) -> Column:
    """J17 — ``int(str(x).strip()[:4])``; NULL on failure (``03/2019`` fails)."""
    s = F.substring(pystrip(_as_col(c).cast("string")), 1, 4)
    return pystrip(s).try_cast("int")


def year_after_slash(c) -> Column:
    """J18 — ``int(s.split("/")[-1])``; NULL for empty, ``N/A`` or failure."""
    s = _as_col(c).cast("string")
    last = F.element_at(F.split(s, "/"), -1)
    return F.when(s.isNotNull() & (s != "") & (s != "N/A"), pystrip(last).try_cast("int"))


def is_year_like(c) -> Column:
    """J30 — digits of the value form one 4-digit number within 1990–2030."""
    d = F.regexp_replace(_as_col(c), "[^0-9]", "")
    return d.rlike("^[0-9]{4}$") & d.try_cast("int").between(1990, 2030)
