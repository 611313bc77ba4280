"""S7 request grid and S8 fetch-attempt outcome.

The HTTP transport itself is not part of the engine: payloads are landed by
whatever fetches them.  What is kept is (a) the grid of requests — every
region for every year of a range, one URL each — and (b) the retry policy,
evaluated as a query over a log of attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.functions.numeric import MAX_ATTEMPTS, backoff_seconds, status_class

# Query parameters of the monthly demand request.
TIME_TRUNC = "month"
GEO_TRUNC = "electric_system"


def request_grid(regions: DataFrame, first_year: Column | int, last_year: Column | int | None,
                 base_url: str, geo_limit: str = "geo_limit", geo_id: str = "geo_id") -> DataFrame:
    """One row per region and year with its URL.

    Years are generated per region row with ``explode(sequence(...))`` — a
    generator, not a join; bounds may be scalar-subquery columns.  Without a
    last year the grid runs to the current year (a partial year is normal).
    """
    lo = first_year if isinstance(first_year, Column) else F.lit(first_year)
    if last_year is None:
        hi = F.year(F.current_date())
    else:
        hi = last_year if isinstance(last_year, Column) else F.lit(last_year)
    g = regions.select("*", F.explode(F.sequence(lo, hi)).alias("year"))
    y = F.col("year").cast("string")
    url = F.concat(
        F.lit(base_url), F.lit("?start_date="), y, F.lit("-01-01T00:00&end_date="), y,
        F.lit(f"-12-31T23:59&time_trunc={TIME_TRUNC}&geo_trunc={GEO_TRUNC}&geo_limit="),
        F.col(geo_limit).cast("string"), F.lit("&geo_ids="), F.col(geo_id).cast("string"))
    return g.withColumn("url", url)


def fetch_outcome(attempts: DataFrame, request: str = "request_id", attempt_order: list[str] | None = None,
                  status: str = "status", klass: str | None = None,
                  max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Outcome per request from its attempt log.

    Attempts are numbered in ``attempt_order``; at most ``max_attempts`` are
    made and attempts stop after the first non-transient one.  Per request:
    ``attempts_used``, ``final_class``, ``outcome`` (``success``,
    ``permanent_error`` or ``exhausted``) and ``wait_seconds`` (``2**n`` after
    every transient attempt ``n`` that was retried).

    The per-request numbering is a ``row_number() <= max_attempts`` window,
    which Spark plans with a partial WindowGroupLimit before the shuffle, so a
    request with a huge log is cut to ``max_attempts`` rows on every task.
    """
    order = [F.col(c) for c in (attempt_order or ["attempt"])]
    cls = F.col(klass) if klass else status_class(F.col(status))
    w = Window.partitionBy(request).orderBy(*order)
    numbered = (attempts.select(request, *[F.col(c) for c in (attempt_order or ["attempt"])],
                                cls.alias("_class"))
                .withColumn("_n", F.row_number().over(w))
                .where(F.col("_n") <= max_attempts))
    # first attempt (by number) that is not transient ends the sequence
    per_request = numbered.groupBy(request).agg(
        F.min(F.when(F.col("_class") != "transient", F.col("_n"))).alias("_stop"),
        F.max("_n").alias("_last"),
        F.collect_list(F.struct("_n", "_class")).alias("_tries"))
    used = F.coalesce(F.col("_stop"), F.col("_last"))
    final_class = F.element_at(F.filter("_tries", lambda t: t["_n"] == used), 1)["_class"]
    waits = F.aggregate(
        F.filter("_tries", lambda t: (t["_n"] < used) & (t["_class"] == "transient")),
        F.lit(0).cast("bigint"), lambda acc, t: acc + backoff_seconds(t["_n"]))
    outcome = (F.when(final_class == "success", F.lit("success"))
               .when(final_class == "permanent", F.lit("permanent_error"))
               .otherwise(F.lit("exhausted")))
    return per_request.select(request, used.cast("int").alias("attempts_used"),
                              final_class.alias("final_class"), outcome.alias("outcome"),
                              waits.alias("wait_seconds"))
