"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAFE_SCHEMES = ["http", "https"]


def host(c: Column) -> Column:
    """Network location (port included) with every ``www.`` removed; empty when there is none."""
    return F.regexp_replace(F.regexp_extract(F.coalesce(c, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), r"www\.", "")


def safe_url(c: Column) -> Column:
    """Trimmed http(s) URL with a host, else NULL."""
    u = F.trim(c)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return F.when(scheme.isin(SAFE_SCHEMES) & (F.regexp_extract(u, r"^[^:]+://([^/?#]*)", 1) != ""), u)
