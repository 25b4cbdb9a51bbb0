"""Text column functions: slugs, case, whitespace, encoding repair, keyword tests.

All are JVM-side expressions (regexp / translate / higher-order functions); none is a
Python UDF. Python's ``str`` semantics are matched where the listing logic depends on
them: Unicode whitespace for ``split``/``strip``/``\\s``, mark removal after canonical
decomposition for slugs, titlecasing after every non-cased character.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _esc(cp: int) -> str:
    return "\\x{%X}" % cp


def _ranges_class(cps: list[int], negate: bool = False) -> str:
    """Regex character class from code points, as ranges (Java and RE2 syntax)."""
    parts: list[str] = []
    cps = sorted(cps)
    i = 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        parts.append(_esc(cps[i]) if i == j else f"{_esc(cps[i])}-{_esc(cps[j])}")
        i = j + 1
    return "[" + ("^" if negate else "") + "".join(parts) + "]"


@lru_cache(maxsize=1)
def whitespace_class() -> str:
    """Exactly the characters Python's ``str.isspace`` accepts (``split()``, ``strip()``, ``\\s``)."""
    return _ranges_class([cp for cp in range(sys.maxunicode + 1) if chr(cp).isspace()])


def WS() -> str:
    return whitespace_class()


# Python str.splitlines() boundaries
LINE_BREAK_CHARS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def line_break_class() -> str:
    return _ranges_class([ord(ch) for ch in LINE_BREAK_CHARS])


@lru_cache(maxsize=1)
def _decompose_table() -> tuple[str, str]:
    """``translate`` arguments mapping each precomposed BMP character to its canonical
    decomposition with combining marks removed (``é``→``e``, ``Å``→``A``).

    Built from ``unicodedata`` by rule. Characters whose decomposition keeps more than
    one base character (Hangul syllables) are left as they are.
    """
    src, dst = [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.category(ch) == "Mn":
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


@lru_cache(maxsize=1)
def _to_space_table() -> tuple[str, str]:
    ws = whitespace_chars()
    return ws, " " * len(ws)


def squash(c) -> Column:
    """J7 — collapse whitespace runs to one space and strip (``" ".join(s.split())``).

    Every whitespace character becomes a space (``translate``: a per-character map
    lookup), then runs of spaces collapse — no large character-class regex."""
    src, dst = _to_space_table()
    return F.trim(F.regexp_replace(F.translate(_as_col(c), src, dst), " {2,}", " "))


@lru_cache(maxsize=1)
def whitespace_chars() -> str:
    return "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())


def pystrip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (a set-based
    ``trim``, no regex)."""
    return F.trim(_as_col(c), F.lit(whitespace_chars()))


@lru_cache(maxsize=1)
def _mark_chars() -> str:
    return "".join(chr(cp) for cp in range(sys.maxunicode + 1)
                   if not 0xD800 <= cp <= 0xDFFF and unicodedata.category(chr(cp)) == "Mn")


def strip_marks(c) -> Column:
    """Canonical decomposition followed by removal of non-spacing marks (one
    ``translate``: precomposed → base, marks deleted)."""
    src, dst = _decompose_table()
    return F.translate(_as_col(c), src + _mark_chars(), dst)


@lru_cache(maxsize=1)
def _slug_table() -> tuple[str, str]:
    src, dst = _decompose_table()
    seps = "-_/" + whitespace_chars()
    return src + seps + _mark_chars(), dst + " " * len(seps)


def slug(c) -> Column:
    """J1 — lower, decompose, drop marks, ``/``→space, ``[-_\\s]+``→space, strip.

    One ``translate`` maps precomposed letters to their base, separators and
    whitespace to a space and deletes combining marks; runs of spaces then collapse.
    NULL stays NULL (the reference maps a falsy input to ``""``).
    """
    src, dst = _slug_table()
    s = F.translate(F.lower(_as_col(c)), src, dst)
    return F.trim(F.regexp_replace(s, " {2,}", " "))


# The accent list of the catalogue builder's slug variant.
VARIANT_ACCENTS_FROM = "éèêëàâäüùûöôîïç"
VARIANT_ACCENTS_TO = "eeeeaaauuuooiic"


def variant_slug(c) -> Column:
    """J2 — catalogue-builder slug: fixed accent list, ``/``→``_``, ``[-\\s]+``→space."""
    s = F.lower(pystrip(_as_col(c)))
    s = F.translate(s, VARIANT_ACCENTS_FROM, VARIANT_ACCENTS_TO)
    s = F.regexp_replace(s, "/", "_")
    s = F.regexp_replace(s, "(?:-|" + WS() + ")+", " ")
    return F.trim(s)


def nospace(c) -> Column:
    """Slug with every whitespace run removed (``re.sub(r"\\s+", "", s)``)."""
    return F.regexp_replace(_as_col(c), WS() + "+", "")


def is_short_or_numeric(slug_col) -> Column:
    """J3 — fuzzy guard: ≤ 4 chars, or ≤ 6 chars of ``[a-z0-9\\s]`` holding a digit."""
    s = pystrip(_as_col(slug_col))
    ws = WS()
    short = F.length(s) <= 4
    alnum6 = s.rlike("^(?:[a-z0-9]|" + ws + "){1,6}$") & s.rlike(r"\p{Nd}")
    return short | alnum6


_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_case(c) -> Column:
    """J5 — Python ``str.title()``: a capital after any non-cased character.

    ``initcap`` alone only capitalises after spaces (``Mercedes-benz``); splitting into
    runs of cased / non-cased characters first gives ``Mercedes-Benz``.
    """
    runs = F.regexp_extract_all(_as_col(c), F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), 1)
    return F.array_join(F.transform(runs, lambda t: F.initcap(t)), "")


def capitalize(c) -> Column:
    """Python ``str.capitalize()``: first character upper, the rest lower."""
    s = _as_col(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def repair_encoding(c) -> Column:
    """J14 — undo Latin-1 mojibake: re-read the Latin-1 bytes of ``s`` as UTF-8.

    Unchanged when ``s`` holds a character above U+00FF (not Latin-1 encodable) or
    when the bytes are not valid UTF-8 — the two failure branches of the definition.
    NULL → ``""`` as in the reference.
    """
    s = _as_col(c)
    latin1 = s.rlike(r"^[\x{0}-\x{FF}]*$")
    redecoded = F.try_validate_utf8(F.encode(s, "ISO-8859-1").cast("string"))
    return F.when(s.isNull(), F.lit("")).when(latin1, F.coalesce(redecoded, s)).otherwise(s)


def force_mojibake(c) -> Column:
    """UTF-8 bytes read back as Latin-1 (the damage J14 repairs)."""
    return F.decode(F.encode(_as_col(c), "UTF-8"), "ISO-8859-1")
