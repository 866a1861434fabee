"""Landed request logs: verdicts, warm-ups, timings, failures in a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.base import any_of
from feedmill.shared import small_side, written
from feedmill.sources.catalog import ATTEMPTS, BACKOFF

#: What names of protection cookies begin with: fixed values.
PROTECTION = ("__ddg", "ddg2", "cf_clearance", "cf_bm", "cf_chl_")


def once(log: DataFrame) -> DataFrame:
    """The log without lines logged twice: of equal attempts the one logged first."""
    keys = ["host", "url", "phase", "attempt", "attempted_at"]
    fields = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.min_by(F.struct(*fields), F.struct("logged_at", "log_no")).alias("x")).select(*keys, "x.*")


def protected(names: Column) -> Column:
    """Whether any cookie is one of a protection service."""
    return F.coalesce(F.exists(names, lambda n: any_of([F.lower(n).startswith(p) for p in PROTECTION])), F.lit(False))


def unreachable(error: Column) -> Column:
    return F.coalesce(F.lower(error).contains("network is unreachable"), F.lit(False))


def warmup_outcome(status: Column, names: Column) -> Column:
    """What came of a warm-up: success below 400; above, an error with or without protection cookies."""
    return F.when(status < 400, "http_success").when(protected(names), "http_4xx_with_cookies").when(status.isNotNull(), "http_error").otherwise("failed")


def wait_after(attempt: Column, factor: Column | float = BACKOFF) -> Column:
    """Seconds to wait after an attempt, twice as long each time; 0 for factors up to 0."""
    f = factor if isinstance(factor, Column) else F.lit(factor)
    return F.when(f > 0, f * F.pow(F.lit(2.0), attempt - 1)).otherwise(F.lit(0.0))


def timings(log: DataFrame) -> DataFrame:
    """The log with the time that connecting took: what the response took beyond the name's lookup, never less than 0."""
    return log.withColumn("connect_ms", F.greatest(F.lit(0.0), F.col("response_ms") - F.col("dns_ms")))


def outcomes(log: DataFrame, strategies: DataFrame | None = None) -> DataFrame:
    """(host, url, attempts, status, verdict, errors): what became of each address requested.

    An attempt that answers with a status its host retries counts only if it is the last one allowed; the first that counts
    ends the chain. Chains without one are unavailable, or unfinished if attempts are left. ``strategies`` has (host,
    strategy); a host without one retries nothing and tries three times. ``errors`` has the first error of each attempt.
    """
    rows = once(log).where(F.col("phase") == "request")
    limits = strategies.select("host", F.col("strategy.max_attempts").alias("_most"), F.col("strategy.retry_statuses").alias("_again")) if strategies is not None else None
    rows = rows.join(F.broadcast(limits), "host", "left") if limits is not None else rows.withColumn("_most", F.lit(None).cast("int")).withColumn("_again", F.lit(None).cast("array<int>"))
    most = F.coalesce("_most", F.lit(ATTEMPTS))
    again = F.coalesce(F.array_contains("_again", F.col("status")), F.lit(False)) & (F.col("attempt") < most)
    answered = F.col("status").isNotNull() & F.col("error").isNull() & ~again
    # attempts are numbered up to a host's limit: an address has few of them, whatever share of the log is its
    moment = F.struct("attempted_at", "log_no")
    tries = rows.groupBy("host", "url", "attempt").agg(F.min_by("error", F.when(F.col("error").isNotNull(), moment)).alias("error"), F.min_by("status", F.when(answered, moment)).alias("status"), F.max(answered.cast("int")).alias("ok"), F.max(most).alias("most"))
    ended = F.min_by(F.struct("attempt", "status"), F.when(F.col("ok") == 1, F.col("attempt")))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("attempt", "error")))), lambda x: x["error"]), ", ")
    found = tries.groupBy("host", "url").agg(ended.alias("e"), F.max("attempt").alias("last"), F.max("most").alias("most"), F.max("ok").alias("ok"), listed.alias("errors"))
    verdict = F.when(F.col("ok") == 1, F.when(F.col("e.status") < 400, "ok").otherwise("http_error")).when(F.col("last") >= F.col("most"), "unavailable").otherwise("unfinished")
    return found.select("host", "url", F.when(F.col("ok") == 1, F.col("e.attempt")).otherwise(F.col("last")).alias("attempts"), F.when(F.col("ok") == 1, F.col("e.status")).alias("status"), verdict.alias("verdict"), "errors")


def last_metrics(log: DataFrame) -> DataFrame:
    """(host, attempt, status, error, dns_ms, connect_ms, response_ms) of each host's last request."""
    order = F.struct("attempted_at", "logged_at", "log_no")
    fields = ["attempt", "status", "error", "dns_ms", "connect_ms", "response_ms"]
    return timings(once(log)).where(F.col("phase") == "request").groupBy("host").agg(F.max_by(F.struct(*fields), order).alias("x")).select("host", "x.*")


def failing(log: DataFrame) -> DataFrame:
    """(host, consecutive_failures, last_error, last_ts): requests that failed since a host's last success.

    Two aggregations, the first of them partial: a host may have any share of the log.
    """
    rows = once(log).where(F.col("phase") == "request")
    good = (F.col("error").isNull()) & (F.col("status") < 400)
    moment = F.struct("attempted_at", "logged_at", "log_no")
    since = written(rows.groupBy("host").agg(F.max(F.when(F.coalesce(good, F.lit(False)), moment)).alias("_last")), "last-success")
    after = rows.join(small_side(since), "host").where(F.col("_last").isNull() | (moment > F.col("_last")))
    failed = after.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.max_by(F.coalesce("error", F.concat(F.lit("HTTP "), F.col("status").cast("string"))), moment).alias("last_error"), F.max("attempted_at").alias("last_ts"))
    return since.select("host").join(failed, "host", "left").select("host", F.coalesce("n", F.lit(0)).alias("consecutive_failures"), "last_error", "last_ts")


def islands(log: DataFrame) -> DataFrame:
    """(host, log_no, failures): for each request, how many failed in a row up to it.

    A host's requests are counted hour by hour, and what an hour leaves to the next is carried over the hours' sums: a host
    may have any share of the log.
    """
    rows = once(log).where(F.col("phase") == "request").withColumn("_hour", F.date_trunc("HOUR", "attempted_at"))
    rows = rows.withColumn("_good", F.coalesce(F.col("error").isNull() & (F.col("status") < 400), F.lit(False)).cast("int"))
    order = ["attempted_at", "logged_at", "log_no"]
    upto = (Window.unboundedPreceding, 0)
    inside = rows.withColumn("_island", F.sum("_good").over(Window.partitionBy("host", "_hour").orderBy(*order).rowsBetween(*upto)))
    inside = inside.withColumn("_failed", F.sum(1 - F.col("_good")).over(Window.partitionBy("host", "_hour", "_island").orderBy(*order).rowsBetween(*upto)))
    hours = inside.groupBy("host", "_hour").agg(F.max("_good").alias("good"), F.max_by("_failed", F.struct("_island", *order)).alias("left"))
    by_hour = Window.partitionBy("host").orderBy("_hour").rowsBetween(*upto)
    hours = hours.withColumn("_run", F.sum("good").over(by_hour))
    hours = hours.withColumn("_out", F.sum("left").over(Window.partitionBy("host", "_run").orderBy("_hour").rowsBetween(*upto)))
    carried = hours.select("host", "_hour", F.coalesce(F.lag("_out").over(Window.partitionBy("host").orderBy("_hour")), F.lit(0)).alias("_in"))
    joined = inside.join(carried, (inside["host"] == carried["host"]) & inside["_hour"].eqNullSafe(carried["_hour"]), "left").drop(carried["host"])
    return joined.select("host", "log_no", (F.col("_failed") + F.when(F.col("_island") == 0, F.col("_in")).otherwise(0)).alias("failures"))
