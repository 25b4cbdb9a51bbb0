"""J4 — Ratcliff–Obershelp similarity, the one scoring step that runs in Python.

It runs as an Arrow-batched pandas UDF on candidate pairs that already passed the
native length bound ``2·min(la, lb) / (la + lb) ≥ cutoff`` and the bound by shared signs
(``ratio_bound``); neither removes a true match, since the ratio is at most either.

Argument order matters (the ratio is not symmetric): the catalogue entry is the
first sequence, the input value the second, as in ``get_close_matches``.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def ratio_py(candidate: str, word: str) -> float:
    """Python-side reference value (used by tests and the UDF)."""
    return SequenceMatcher(None, candidate, word).ratio()


@pandas_udf(DoubleType())
def _ratio_udf(candidate: pd.Series, word: pd.Series) -> pd.Series:
    sm = SequenceMatcher(None)
    out = []
    last_word = None
    for a, b in zip(candidate, word):
        if a is None or b is None:
            out.append(None)
            continue
        if b != last_word:
            sm.set_seq2(b)  # seq2 holds the cached index; reuse it across a batch
            last_word = b
        sm.set_seq1(a)
        out.append(sm.ratio())
    return pd.Series(out, dtype="float64")


def ratio(candidate, word) -> Column:
    """``SequenceMatcher(None, candidate, word).ratio()`` as a column."""
    return _ratio_udf(F.col(candidate) if isinstance(candidate, str) else candidate,
                      F.col(word) if isinstance(word, str) else word)


def sign_mask(s: Column) -> Column:
    """struct(lo, hi): 128 bits, one for each sign and how often it has occurred before ("n1", "n2", ...)."""
    def bit(i: Column) -> Column:
        upto, sign = F.substr(s, F.lit(1), i), F.substr(s, i, F.lit(1))
        nth = F.length(upto) - F.length(F.replace(upto, sign, F.lit("")))
        return F.pmod(F.xxhash64(sign, nth), F.lit(128)).cast("int")

    bits = F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), bit)).otherwise(F.array().cast("array<int>"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def half(first: int) -> Column:
        return F.aggregate(bits, none, lambda acc, b: F.when((b >= first) & (b < first + 64), acc.bitwiseOR(
            F.call_function("shiftleft", one, b - first))).otherwise(acc))

    return F.struct(half(0).alias("lo"), half(64).alias("hi"))


def ratio_bound(a: Column, a_mask: Column, b: Column, b_mask: Column) -> Column:
    """What the ratio of two texts can't exceed. Equal signs are matched at most as often as both hold
    them; a sign of one text whose bit the other lacks is in no match, and signs that share a bit only
    make the bound wider."""
    def lacking(x: Column, y: Column) -> Column:
        return F.bit_count(x["lo"].bitwiseAND(F.bitwise_not(y["lo"]))) + F.bit_count(x["hi"].bitwiseAND(F.bitwise_not(y["hi"])))

    la, lb = F.length(a), F.length(b)
    return F.least(la - lacking(a_mask, b_mask), lb - lacking(b_mask, a_mask)) * 2.0 / F.greatest(la + lb, F.lit(1))


def compatible_lengths(n: Column, cutoff: float, lengths: Sequence[int]) -> Column:
    """Those of the catalogue's ``lengths`` that an input of length ``n`` can reach the cut-off
    against: ``m`` with ``2·min(n, m)/(n + m) ≥ cutoff``, that is within
    ``[n·c/(2−c), n·(2−c)/c]``.

    Used to turn the similarity candidate search into an equi-join on length.
    """
    lo = F.ceil(n * F.lit(cutoff / (2.0 - cutoff)) - F.lit(1e-9))
    hi = F.floor(n * F.lit((2.0 - cutoff) / cutoff) + F.lit(1e-9))
    known = F.array(*[F.lit(int(m)) for m in sorted(lengths) if m > 0]).cast("array<int>")
    return F.filter(known, lambda m: (m >= lo) & (m <= hi))
