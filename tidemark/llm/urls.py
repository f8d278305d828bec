"""URL filters: dated list entries, evaluated as they stood when a page was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A longer name is no host name.
HOST_LENGTH = 253


def host(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and closing dot; null if it has none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    found = F.rtrim(found, F.lit("."))
    return F.when((found != "") & (F.length(found) <= HOST_LENGTH), found)


def segments(url: Column) -> Column:
    """Segments of a URL's path, empty ones left out."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.filter(F.split(path, "/", -1), lambda s: s != "")


def rule_keys(url: Column, depth: Column) -> Column:
    """All keys that a rule for this URL can have, with their rank: the host's parent domains
    and the host (``example.org``), then the host with path prefixes of up to ``depth``
    segments (``example.org/a/b``). A higher rank is more specific."""
    labels, parts = F.split(host(url), r"\."), segments(url)
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.array_join(F.slice(labels, F.size(labels) - i + 1, i), ".").alias("key"), i.cast("int").alias("rank")
        ),
    )
    deepest = F.least(F.size(parts), depth)
    paths = F.when(
        deepest > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(deepest, F.lit(1))),
            lambda i: F.struct(
                F.concat(host(url), F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")).alias("key"),
                (i + HOST_LENGTH).cast("int").alias("rank"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<key:string,rank:int>>"))
    return F.when(host(url).isNotNull(), F.concat(domains, paths))


def _listed(key: Column) -> Column:
    """A list entry's key, its host in lower case; a path keeps its case, as in ``rule_keys``."""
    name = F.substring_index(key, "/", 1)
    return F.concat(F.lower(name), F.substring(key, F.length(name) + 1, F.length(key)))


def validity(entries: DataFrame) -> DataFrame:
    """(key, verdict, since, until) from dated entries (key, verdict, since): an entry holds
    until the next one of its key, the last one without end (null).

    Times keep their type, a date being its midnight. Several entries of a key at the same
    instant are one: ``block`` goes before ``allow``, that before ``remove``. Entries without
    key, time or a known verdict are none. What is listed as ``remove`` ends the key's entry and
    is not active itself.
    """
    order = F.when(F.col("verdict") == "block", 3).when(F.col("verdict") == "allow", 2).when(F.col("verdict") == "remove", 1)
    instants = (
        entries.select(_listed(F.col("key")).alias("key"), "since", order.alias("order"))
        .filter("key IS NOT NULL AND since IS NOT NULL AND order IS NOT NULL")
        .groupBy("key", "since")
        .agg(F.max("order").alias("order"))
    )
    # The list alone, without captures: a key's own entries.
    until = F.lead("since").over(Window.partitionBy("key").orderBy("since"))
    verdict = F.element_at(F.array(F.lit("remove"), F.lit("allow"), F.lit("block")), F.col("order"))
    return instants.select("key", verdict.alias("verdict"), "since", until.alias("until"))


def _instant(time: Column) -> Column:
    """Dates and timestamps on one scale."""
    return time.cast("timestamp_ntz")


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """``captures`` with verdict, matched, since and until; columns of these names are replaced.

    A capture is judged by the entries that were active when it was fetched: of those whose key is a
    parent domain, the host or a path prefix of its URL, the most specific one decides. The
    verdict is ``block`` or ``allow``, and ``none`` where no entry is active, where the URL is
    null or has no host, or where the time is null; ``matched`` and the dates are null then.

    A verdict depends on URL and time alone. So distinct pairs are looked up, each (key, time)
    once by an as-of join, and the verdicts are joined to the captures. Copies of a URL at one
    time fold before any shuffle. The as-of join goes along a key's hours, two rows each, and
    then within each hour: a hot key is dealt out by its hours.
    """
    rules = validity(entries)
    asked = (
        captures.select(F.col(f"`{url}`").alias("u"), _instant(F.col(f"`{fetched}`")).alias("at"))
        .filter("u IS NOT NULL AND at IS NOT NULL")
        .distinct()
    )
    deepest = rules.agg(
        F.coalesce(F.max(F.size(F.split("key", "/")) - 1), F.lit(0)).alias("depth")
    ).first()["depth"]
    listed = rules.select("key").distinct()
    keys = (
        asked.select("u", "at", F.inline(rule_keys(F.col("u"), F.lit(deepest))))
        .join(listed, "key", "left_semi")
    )
    states = rules.select("key", _instant(F.col("since")).alias("at"), F.struct("verdict", "since", "until").alias("state"))
    answers = _as_of(keys.select("key", "at").distinct(), states).filter(F.col("now.verdict") != "remove")
    best = (
        keys.join(answers, ["key", "at"])
        .groupBy("u", "at")
        .agg(F.max(F.struct("rank", "key", "now")).alias("best"))
    )
    judged = captures.withColumns({"__u": F.col(f"`{url}`"), "__at": _instant(F.col(f"`{fetched}`"))}).join(
        best.select(F.col("u").alias("__u"), F.col("at").alias("__at"), F.col("best").alias("__best")),
        ["__u", "__at"],
        "left",
    )
    return judged.withColumns(
        {
            "verdict": F.coalesce("__best.now.verdict", F.lit("none")),
            "matched": F.col("__best.key"),
            "since": F.col("__best.now.since"),
            "until": F.col("__best.now.until"),
        }
    ).drop("__u", "__at", "__best")


def _as_of(questions: DataFrame, states: DataFrame) -> DataFrame:
    """``questions`` (key, at) with ``now``, the last of ``states`` (key, at, state) at or before
    it; without one before it, a question goes."""
    kind = states.schema["state"].dataType
    hour = F.date_trunc("hour", F.col("at")).cast("timestamp_ntz")
    questions, states = questions.withColumn("hour", hour), states.withColumn("hour", hour)
    nothing = F.lit(None).cast(kind).alias("state")
    # The state that each hour with questions begins with: at most two rows an hour.
    ends = states.groupBy("key", "hour").agg(F.max_by("state", "at").alias("state"))
    asked = questions.select("key", "hour").distinct()
    hours = ends.select("key", "hour", "state", F.lit(0).alias("asks")).unionByName(
        asked.select("key", "hour", nothing, F.lit(-1).alias("asks"))
    )
    before = Window.partitionBy("key").orderBy("hour", "asks").rowsBetween(Window.unboundedPreceding, 0)
    carried = hours.withColumn("state", F.last("state", ignorenulls=True).over(before)).filter("asks = -1")
    # Within the hour: what it begins with, its own states, and the questions after them.
    rows = (
        carried.select("key", "hour", F.col("hour").alias("at"), "state", F.lit(0).alias("asks"))
        .unionByName(states.join(asked, ["key", "hour"], "left_semi").select("key", "hour", "at", "state", F.lit(1).alias("asks")))
        .unionByName(questions.select("key", "hour", "at", nothing, F.lit(2).alias("asks")))
    )
    so_far = Window.partitionBy("key", "hour").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("now", F.last("state", ignorenulls=True).over(so_far))
    return found.filter("asks = 2 AND now IS NOT NULL").select("key", "at", "now")
