"""Numeric helpers: request status classes, back-off and guarded rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the fetch policy.
TRANSIENT_STATUSES = (429, 500, 502, 503, 504)
BACKOFF_BASE = 2
MAX_ATTEMPTS = 4  # one call plus three retries


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status_class(status) -> Column:
    """``success`` (2xx), ``transient`` (listed codes or NULL = transport
    error) or ``permanent`` (anything else)."""
    s = _col(status)
    return (F.when(s.isNull(), F.lit("transient"))
            .when((s >= 200) & (s < 300), F.lit("success"))
            .when(s.isin(*TRANSIENT_STATUSES), F.lit("transient"))
            .otherwise(F.lit("permanent")))


def backoff_seconds(attempt) -> Column:
    """Wait after a failed attempt ``n``: ``BASE ** n`` seconds."""
    return F.pow(F.lit(BACKOFF_BASE), _col(attempt)).cast("bigint")


def safe_rate(numerator, denominator, scale: int | None = 6) -> Column:
    """``numerator / denominator``, NULL when the denominator is 0 or NULL."""
    r = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    return F.round(r, scale) if scale is not None else r
