"""The source catalogue: reading, defaults, selection, request strategies."""

from __future__ import annotations

import json
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions.base import truthy
from feedmill.functions.urls import part

# What holds where a source says nothing.
MAX_LINKS, MIN_TEXT, MIN_WORDS = 100, 0, 0
ATTEMPTS, BACKOFF, BROWSER_WAIT, TIMEOUT, WARMUP_DELAY = 3, 1.5, 5.0, 30.0, (5.0, 10.0)

STRATEGY = "struct<connect_timeout: double, read_timeout: double, max_attempts: int, backoff_factor: double, retry_statuses: array<int>, capture_cookies: boolean, browser_wait: double, headers: map<string,string>, proxies: array<map<string,string>>, warmup: struct<url: string, delay_min: double, delay_max: double, timeout: double>>"
SCHEMA = (
    "ord int, name string, base_url string, start_url string, mode string, api_endpoint string, include_patterns array<string>, include_regex array<string>, exclude_regex array<string>, link_min_text_len int, "
    f"accept_empty_anchor boolean, restrict_domain boolean, max_links int, min_words int, content_selectors array<string>, enabled boolean, request_strategy {STRATEGY}, time_zone string"
)


def as_list(value: Any) -> list[str] | None:
    """A single value or a list as a list of texts without empty ones; null for null."""
    if value is None:
        return None
    return [str(x) for x in (value if isinstance(value, list) else [value]) if x]


def with_sound_patterns(sources: DataFrame) -> DataFrame:
    """The catalogue with patterns as the JVM runs them: named groups in its spelling, bad patterns left out.

    The catalogue is a table of fixed size; its patterns are tested on the driver, with the engine that will match them.
    """
    lists = ("include_regex", "exclude_regex")
    spelt = {c: F.transform(c, lambda p: F.regexp_replace(F.regexp_replace(F.regexp_replace(p, r"\(\?P<", "(?<"), r"\(\?P=(\w+)\)", r"\\k<$1>"), r"\\Z", r"\\z")) for c in lists}
    df = sources.withColumns(spelt)
    patterns = [r[0] for r in df.select(F.explode(F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in lists]))).distinct().collect()]
    java = df.sparkSession._jvm.java.util.regex.Pattern
    bad = []
    for p in patterns:
        try:
            java.compile(p or "")
        except (IllegalArgumentException, Py4JJavaError):
            bad.append(p)
    return df.withColumns({c: F.filter(c, lambda p: p.isNotNull() & ~p.isin(bad)) for c in lists})


def proxies_of(value: Any) -> list[dict[str, str]] | None:
    """Proxies as maps: a text serves both schemes, a map keeps its filled entries, anything else is dropped."""
    out = []
    for p in value if isinstance(value, list) else [value] if value else []:
        if isinstance(p, str) and p:
            out.append({"http": p, "https": p})
        elif isinstance(p, dict) and (kept := {str(k): str(v) for k, v in p.items() if v}):
            out.append(kept)
    return out or None


def warmup_of(value: Any) -> tuple | None:
    """(address, least and most delay, timeout): a pair of delays, one for both, or the usual ones."""
    if not isinstance(value, dict) or not value.get("url"):
        return None
    delay = value.get("delay") or value.get("delay_range")
    pair = (float(delay[0]), float(delay[1])) if isinstance(delay, list) and len(delay) >= 2 else (float(delay),) * 2 if isinstance(delay, (int, float)) else WARMUP_DELAY
    return (str(value["url"]), *pair, float(value["timeout"]) if value.get("timeout") else None)


def strategy_of(value: Any) -> tuple | None:
    """A request strategy with its defaults; null where a source has none."""
    if not isinstance(value, dict):
        return None
    number = lambda k: float(value[k]) if value.get(k) is not None else None
    statuses = value.get("retry_statuses")
    statuses = [int(statuses)] if isinstance(statuses, int) else [int(x) for x in statuses or []]
    headers = {str(k): str(v) for k, v in (value.get("headers") or {}).items() if v}
    first = lambda k, d: d if value.get(k) is None else value[k]
    return (number("connect_timeout"), number("read_timeout"), int(first("max_attempts", ATTEMPTS)), float(first("backoff_factor", BACKOFF)), statuses, bool(first("capture_cookies", True)), float(first("selenium_wait", BROWSER_WAIT)), headers, proxies_of(value.get("proxies")), warmup_of(value.get("warmup")))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue of a JSON file, one row a source in the file's order. Lists may be written as single values; bad
    patterns are left out. The catalogue is a configuration file and read on the driver; a missing file raises."""
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    rows = []
    for n, s in enumerate(json.loads(text)):
        whole = lambda k: int(s[k]) if s.get(k) is not None else None  # noqa: B023, E731
        flag = lambda k: bool(s[k]) if s.get(k) is not None else None  # noqa: B023, E731
        rows.append((n, s.get("name"), s.get("base_url"), s.get("start_url"), s.get("mode"), s.get("api_endpoint"), as_list(s.get("include_patterns")), as_list(s.get("include_regex")), as_list(s.get("exclude_regex")), whole("link_min_text_len"), flag("accept_empty_anchor"), flag("restrict_domain"), whole("max_links"), whole("min_words"), as_list(s.get("content_selectors")), flag("enabled"), strategy_of(s.get("request_strategy")), s.get("time_zone")))
    return with_sound_patterns(spark.createDataFrame(rows, SCHEMA))


def with_defaults(sources: DataFrame) -> DataFrame:
    """The catalogue with what holds where a source says nothing: base address, limits, flags, empty lists; bad patterns are
    left out."""
    empty = F.array().cast("array<string>")
    filled = {
        "base_url": F.coalesce(truthy(F.col("base_url")), F.col("start_url"), F.col("api_endpoint")),
        "mode": F.coalesce("mode", F.lit("html")),
        "link_min_text_len": F.coalesce("link_min_text_len", F.lit(MIN_TEXT)),
        "accept_empty_anchor": F.coalesce("accept_empty_anchor", F.lit(False)),
        "restrict_domain": F.coalesce("restrict_domain", F.lit(False)),
        "max_links": F.coalesce("max_links", F.lit(MAX_LINKS)),
        "min_words": F.coalesce("min_words", F.lit(MIN_WORDS)),
        "enabled": F.coalesce("enabled", F.lit(True)),
    }
    return with_sound_patterns(sources).withColumns(filled | {c: F.coalesce(c, empty) for c in ("include_patterns", "include_regex", "exclude_regex", "content_selectors")})


def selected(sources: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Enabled sources, and of these the named ones if any are named (blanks around and between names don't count)."""
    wanted = [n.strip() for n in names or [] if n.strip()]
    enabled = sources.where(F.coalesce("enabled", F.lit(True)))
    return enabled.where(F.col("name").isin(wanted)) if wanted else enabled


def missing_names(names: DataFrame, sources: DataFrame) -> DataFrame:
    """The requested names that no source has."""
    return names.join(sources.select("name"), "name", "left_anti").distinct()


def strategies(sources: DataFrame) -> DataFrame:
    """(host, source, strategy) of every host with a request strategy; of several sources of a host the last one counts."""
    host = part(F.coalesce(truthy(F.col("base_url")), truthy(F.col("start_url"))), 2)
    rows = sources.where(F.col("request_strategy").isNotNull()).withColumn("host", host).where(truthy(F.col("host")).isNotNull())
    return rows.groupBy("host").agg(F.max_by("name", "ord").alias("source"), F.max_by("request_strategy", "ord").alias("strategy"))


def timeouts(strategy: Column) -> Column:
    """(connect, read) of a strategy: one stands in for the other; null where neither is set."""
    connect, read = strategy["connect_timeout"], strategy["read_timeout"]
    return F.when(connect.isNotNull() | read.isNotNull(), F.struct(F.coalesce(connect, read, F.lit(TIMEOUT)).alias("connect"), F.coalesce(read, connect, F.lit(TIMEOUT)).alias("read")))
