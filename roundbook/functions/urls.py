"""URL handling: host normalisation (C1) and lookup-header rules.

All column functions are built-in Spark expressions, so they stay inside
whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_url(url: Column | str) -> Column:
    """Lower-cased host of a URL.

    Lower-case first (so ``HTTPS://`` is stripped too), drop a leading
    ``http://``/``https://`` and ``www.``, then keep the text before the first
    ``/``. ``?query``, ``#frag`` and ``:port`` stay when no ``/`` precedes them,
    as in the reference. NULL stays NULL.
    """
    c = F.lower(_col(url))
    c = F.regexp_replace(c, r"^https?://", "")
    c = F.regexp_replace(c, r"^www\.", "")
    return F.substring_index(c, "/", 1)


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()`` for the ASCII whitespace class."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def lookup_host(url: Column | str) -> Column:
    """Match key of a lookup cell: NULL for a missing/blank cell or an empty host.

    An empty host (``"https://"``, ``"/"``) would match every company with a
    website under a ``%%`` pattern; here it matches nothing.
    """
    s = strip_ws(url)
    h = normalize_url(s)
    return F.when(s.isNull() | (s == "") | (h == ""), F.lit(None).cast("string")).otherwise(h)


# Fixed values that must equal the reference: header keywords of the URL column.
URL_KEYWORDS = ["url", "website", "domain", "website_url", "site", "web"]
SECONDARY_KEYWORDS = ["company_url", "firm", "organization"]
PRIORITY_KEYWORDS = ["url", "website"]


class NoUrlColumn(ValueError):
    """No header names a URL column."""


class AmbiguousUrlColumn(ValueError):
    """More than one header could be the URL column."""


def clean_header(header: list[str | None]) -> list[str]:
    """Strip each header; an empty one becomes ``Column_{i+1}``.

    The reference keeps a whitespace-only header as an empty name; Spark
    columns cannot sensibly be empty, so it is named like a missing one.
    """
    out = []
    for i, name in enumerate(header):
        s = (name or "").strip()
        out.append(s if s else f"Column_{i + 1}")
    return out


def _naming(header: list[str], keywords) -> set[int]:
    """Positions of the headers that contain any of the keywords, in any case."""
    return {i for i, name in enumerate(header) if any(k in (name or "").lower() for k in keywords)}


def find_url_column(header: list[str]) -> int:
    """Index of the URL column in a (cleaned) header.

    The candidates are the headers with any keyword; if that leaves a choice,
    the candidates with a priority keyword (``url``, ``website``) decide it,
    provided there is just one. Raises NoUrlColumn / AmbiguousUrlColumn.
    """
    candidates = _naming(header, [*URL_KEYWORDS, *SECONDARY_KEYWORDS])
    for choice in (candidates, candidates & _naming(header, PRIORITY_KEYWORDS)):
        if len(choice) == 1:
            return choice.pop()
    if candidates:
        raise AmbiguousUrlColumn(f"several columns may hold the URL: {sorted(header[i] for i in candidates)}")
    raise NoUrlColumn(f"none of these columns is named like a URL column: {header}")
