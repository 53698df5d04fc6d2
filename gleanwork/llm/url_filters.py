"""URL filters: every capture against the list entries that were active when it was fetched.

Lists change over time: dated entries add and remove rules. The entries of one (list, rule) form
validity intervals, each from its entry to the next one; an as-of join finds the interval that
holds a capture's fetch time. Nothing but the rules a URL could match is compared: its exact
address, its directories, and its host with every parent domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.asof import asof_join


def host_of(url: Column | str) -> Column:
    """Lower-case host of an address, without user, port and final dot; empty if there is none."""
    url = F.col(url) if isinstance(url, str) else url
    host = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]*)", 1))
    return F.regexp_replace(host, r"\.+$", "")


def path_of(url: Column | str) -> Column:
    """Path without query, fragment and slashes at its ends."""
    url = F.col(url) if isinstance(url, str) else url
    return F.regexp_replace(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"^/+|/+$", "")


def candidate_rules(url: Column | str) -> Column:
    """The rules an address could match: the host, its parents, and host/path for every leading part of the path."""
    host, path = host_of(url), path_of(url)
    labels, steps = F.split(host, r"\."), F.split(path, "/+")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/"))
    )
    empty = F.expr("cast(array() as array<string>)")
    return F.when((host != "") & (path != ""), F.concat(domains, prefixes)).when(host != "", domains).otherwise(empty)


def interval_starts(entries: DataFrame) -> DataFrame:
    """Validity intervals (list, rule, active, valid_from) of dated entries (list, rule, action, dated).

    An interval ends where the next one of the same list and rule starts, so the last start at or
    before a moment names the interval that holds it. Several entries of one moment count as one;
    ``remove`` beats ``add``. Entries with a null in any field, or another action, are ignored.
    """
    return (
        entries.where("action in ('add', 'remove') and list is not null and rule is not null and dated is not null")
        .groupBy("list", "rule", "dated")
        .agg((F.max("action") == "add").alias("active"))
        .withColumnRenamed("dated", "valid_from")
    )


def filter_captures(
    captures: DataFrame,
    entries: DataFrame,
    allow: tuple[str, ...] = ("allow",),
    capture_id: str = "capture_id",
    url: str = "url",
    fetched_at: str = "fetched_at",
) -> DataFrame:
    """One row per distinct capture: capture_id, url, fetched_at, n_active, lists, rule, blocked.

    ``lists``: names of the lists with an active matching entry at fetch time, sorted and joined by
    commas; ``rule``: the longest active rule. A capture is blocked if its longest active rule of a
    blocking list is longer than its longest active rule of a list named in ``allow``.

    Defined results: a null or malformed address matches nothing; neither does a null fetch time;
    repeated rows (same id, address and time) are one; no entries block nothing.
    """
    rows = captures.select(
        F.col(capture_id).alias("capture_id"), F.col(url).cast("string").alias("url"), F.col(fetched_at).alias("fetched_at")
    ).distinct()
    valid = interval_starts(entries)
    named = entries.where("list is not null and rule is not null").select("list", "rule").distinct()
    candidates = rows.select("capture_id", "fetched_at", "url", F.explode(F.array_distinct(candidate_rules("url"))).alias("rule"))
    matched = candidates.join(named, "rule").select("rule", "list", F.col("fetched_at").alias("at"), "capture_id", "url")
    states = asof_join(
        matched, valid.select("rule", "list", F.col("valid_from").alias("at"), "active"), ["rule", "list"], ["at"], ["active"]
    )
    allowed = F.col("list").isin(*allow) if allow else F.lit(False)
    active = states.where("match.active")
    decided = active.groupBy("capture_id", "url", F.col("at").alias("fetched_at")).agg(
        F.count("*").alias("n_active"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.max(F.struct(F.length("rule"), "rule"))["rule"].alias("rule"),
        F.coalesce(F.max(F.when(~allowed, F.length("rule"))), F.lit(0)).alias("__block"),
        F.coalesce(F.max(F.when(allowed, F.length("rule"))), F.lit(0)).alias("__allow"),
    )
    found = decided.select(
        F.col("capture_id").alias("__id"),
        F.col("url").alias("__url"),
        F.col("fetched_at").alias("__at"),
        "n_active",
        "lists",
        "rule",
        (F.col("__block") > F.col("__allow")).alias("blocked"),
    )
    same = (
        F.col("capture_id").eqNullSafe(F.col("__id"))
        & F.col("url").eqNullSafe(F.col("__url"))
        & F.col("fetched_at").eqNullSafe(F.col("__at"))
    )
    return rows.join(found, same, "left").select(
        "capture_id",
        "url",
        "fetched_at",
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce("rule", F.lit("")).alias("rule"),
        F.coalesce("blocked", F.lit(False)).alias("blocked"),
    )
