"""Link and page-URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carlot.functions.text import _as_col


def drop_query(c) -> Column:
    """Everything before the first ``?``."""
    return F.split_part(_as_col(c), F.lit("?"), F.lit(1))


def url_key(c) -> Column:
    """J21 — query and every trailing ``/`` removed (``url.split("?")[0].rstrip("/")``)."""
    return F.regexp_replace(drop_query(c), "/+$", "")


def absolute_link(href, base: str, path_prefix: str = "/",
                  guid=None, make=None, model=None, offer_path: str = "/offres/") -> Column:
    """J20 — listing link from a card.

    * ``http…`` → query dropped;
    * starting with ``path_prefix`` → ``base`` + path, query dropped;
    * else, when a ``guid`` column is given and non-empty →
      ``base + offer_path + "{make}-{model}" + "-" + guid`` (make / model lowered,
      spaces → ``-``, empty parts skipped; the ``-`` before the guid is always there);
    * else ``N/A``.
    """
    h = F.coalesce(_as_col(href), F.lit(""))
    out = F.when(h.startswith("http"), drop_query(h)).when(
        h.startswith(path_prefix), F.concat(F.lit(base), drop_query(h)))
    if guid is not None:
        g = F.coalesce(_as_col(guid), F.lit(""))

        def part(c):
            v = F.regexp_replace(F.lower(F.coalesce(_as_col(c), F.lit(""))), " ", "-")
            return F.when(v != "", v)

        slug = F.concat_ws("-", part(make), part(model))
        synth = F.concat(F.lit(base + offer_path), slug, F.lit("-"), g)
        out = out.when(g != "", synth)
    return out.otherwise(F.lit("N/A"))


def next_page_url(c, page_num) -> Column:
    """J22 — every ``page=<digits>`` rewritten, else ``page=n`` appended with ``?`` / ``&``."""
    u = _as_col(c)
    n = _as_col(page_num).cast("string") if not isinstance(page_num, int) else F.lit(str(page_num))
    replaced = F.regexp_replace(u, F.lit(r"(page=)\d+"), F.concat(F.lit("$1"), n))
    sep = F.when(F.contains(u, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.when(F.contains(u, F.lit("page=")), replaced).otherwise(F.concat(u, sep, F.lit("page="), n))


def page_url(c, page_num) -> Column:
    """J23 — page 1 is the base; with a query only ``[?&]page=<digits>`` is rewritten
    (``&page=n`` appended first when absent); without a query ``?page=n`` is appended."""
    u = _as_col(c)
    pn = F.lit(page_num) if isinstance(page_num, int) else _as_col(page_num)
    n = pn.cast("string")
    with_page = F.when(F.contains(u, F.lit("page=")), u).otherwise(F.concat(u, F.lit("&page="), n))
    rewritten = F.regexp_replace(with_page, F.lit(r"([?&]page=)\d+"), F.concat(F.lit("$1"), n))
    return (F.when(pn == 1, u)
            .when(F.contains(u, F.lit("?")), rewritten)
            .otherwise(F.concat(u, F.lit("?page="), n)))
