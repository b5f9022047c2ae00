"""URL filters by dated lists: validity intervals and an as-of join at fetch time.

A list entry names a domain (with its subdomains) or a host and path prefix, and from its
date on blocks it, allows it, or removes it from the list. An entry holds until the next
one for the same key: entries become intervals. A capture is looked up under every key of
its url (domains from the top down, then path prefixes), each as of its fetch time, and
the most specific entry that holds decides.

Both the intervals and the as-of join work on blocks of time inside a key. Each block is
ordered on its own and one row per block carries the last entry on, so a key with most of
the entries or captures is spread over as many tasks as its times allow.

Nulls and odd input: a null url or fetch time matches nothing, and its row is kept. Of
entries with one key and time the last by action counts (allow, block, remove). Entries
with null key, time or action are ignored. Repeated captures are looked up each. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.llm.columns import numbered

#: Microseconds of a block.
BLOCK = 3_600_000_000


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def keys(url: Column) -> Column:
    """(key, depth) of every domain and path prefix of a url."""
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    parts = F.filter(F.split(path(url), "/"), lambda x: x != "")
    pair = F.struct(F.lit("").alias("key"), F.lit(0).alias("depth"))
    none = F.filter(F.array(pair), lambda x: F.lit(False))
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.struct(F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".").alias("key"), n.alias("depth")),
    )
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.struct(
            F.concat(host(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/")).alias("key"),
            (F.size(labels) + n).alias("depth"),
        ),
    )
    found = F.concat(domains, F.when(F.size(parts) > 0, prefixes).otherwise(none))
    return F.when(F.size(labels) > 0, found).otherwise(none)


def _blocked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__block", F.floor(F.unix_micros("at") / BLOCK))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, active_from, active_until) from (key, listed_at, action); the last ones have no end."""
    rows = _blocked(
        entries.where("key IS NOT NULL AND listed_at IS NOT NULL AND action IS NOT NULL")
        .groupBy("key", F.col("listed_at").alias("at"))
        .agg(F.max("action").alias("action"))
    )
    by_block = Window.partitionBy("key").orderBy("__block")
    carried = rows.groupBy("key", "__block").agg(F.min("at").alias("__first"))
    carried = carried.select("key", "__block", F.lead("__first").over(by_block).alias("__next"))
    inside = Window.partitionBy("key", "__block").orderBy("at")
    return (
        rows.withColumn("__near", F.lead("at").over(inside))
        .join(carried, ["key", "__block"])
        .select("key", "action", F.col("at").alias("active_from"), F.coalesce("__near", "__next").alias("active_until"))
    )


def as_of(probes: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds to probes (key, at, ...) the ``fact`` of their key with the latest time not after theirs.

    ``facts`` has key, at and a struct ``fact``.
    """
    kind = facts.schema["fact"].dataType
    columns = [c for c in probes.columns if c not in ("key", "at")]
    both = probes.select("key", "at", F.struct(*columns).alias("probe"), F.lit(None).cast(kind).alias("fact"))
    none = F.lit(None).cast(both.schema["probe"].dataType).alias("probe")
    rows = _blocked(both.unionByName(facts.select("key", "at", none, "fact")))
    last = rows.where("fact IS NOT NULL").groupBy("key", "__block").agg(F.max_by("fact", "at").alias("__last"))
    marks = rows.select("key", "__block").distinct().join(last, ["key", "__block"], "left")
    before = Window.partitionBy("key").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("key", "__block", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    upto = Window.partitionBy("key", "__block").orderBy("at", F.col("fact").isNull())
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("__near", F.last("fact", ignorenulls=True).over(upto))
        .where("probe IS NOT NULL")
        .join(carried, ["key", "__block"])
        .select("key", "at", "probe.*", F.coalesce("__near", "__carry").alias("fact"))
    )


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Captures (page_id, url, fetched_at) with the entry that decides and ``blocked``."""
    rows = numbered(captures.select("page_id", "url", "fetched_at"))
    spans = intervals(entries)
    looked_up = (
        rows.where("url IS NOT NULL AND fetched_at IS NOT NULL")
        .select("row", F.col("fetched_at").alias("at"), F.inline(keys(F.col("url"))))
        .join(spans.select("key").distinct(), "key", "left_semi")
    )
    facts = spans.select("key", F.col("active_from").alias("at"), F.struct("action", "active_from", "active_until").alias("fact"))
    found = as_of(looked_up, facts).where("fact.action <> 'remove' AND (fact.active_until IS NULL OR at < fact.active_until)")
    best = found.groupBy("row").agg(F.max_by(F.struct("key", "fact"), "depth").alias("best"))
    return rows.join(best, "row", "left").select(
        "page_id",
        "url",
        "fetched_at",
        F.col("best.key").alias("entry"),
        F.col("best.fact.action").alias("action"),
        F.col("best.fact.active_from").alias("active_from"),
        F.col("best.fact.active_until").alias("active_until"),
        F.coalesce(F.col("best.fact.action") == "block", F.lit(False)).alias("blocked"),
    )
