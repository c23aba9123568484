"""Scalar field functions of the ingest stage: source host and publish time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (shared spelling with the DuckDB oracle).
URL_UNSAFE_RE = r"[\t\r\n]"
URL_LEADING_RE = r"^[\x00-\x20]+"
NETLOC_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PUBLISH_RE = r"^[0-9]{12}$"
PUBLISH_IN = "yyyyMMddHHmm"
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def source_host(url) -> Column:
    """URL authority with every 'www.' removed; null for an unbalanced '[' / ']'.

    The authority keeps user info, port and case; a URL without '//' after the
    scheme has an empty authority.
    """
    u = F.regexp_replace(F.regexp_replace(_c(url), URL_UNSAFE_RE, ""), URL_LEADING_RE, "")
    host = F.regexp_extract(u, NETLOC_RE, 1)
    bad = F.instr(host, "[") > 0
    bad = bad != (F.instr(host, "]") > 0)
    return F.when(bad, F.lit(None).cast("string")).otherwise(F.replace(host, F.lit("www."), F.lit("")))


def publish_time(ts) -> Column:
    """'yyyyMMddHHmm' (exactly 12 digits) -> 'yyyy-MM-ddTHH:mm:ss'; anything else -> ''."""
    t = _c(ts)
    parsed = F.date_format(F.try_to_timestamp(t, F.lit(PUBLISH_IN)), ISO_OUT)
    return F.when(t.rlike(PUBLISH_RE), F.coalesce(parsed, F.lit(""))).otherwise(F.lit(""))


def fetched_at() -> Column:
    """Ingestion time, UTC, ISO text (one value per query)."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
