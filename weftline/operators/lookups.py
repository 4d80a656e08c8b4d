"""Lookups of stored state: which events, contracts and names belong to given keys. All are joins; no key list passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import or_default

#: Fixed value: the code of event contracts among the security types.
EVENT_CONTRACT = 5


def unresolved(events: DataFrame) -> DataFrame:
    """Events not resolved; an unset flag counts as not resolved."""
    return events.filter(~F.coalesce("resolved", F.lit(False)))


def tradeable(securities: DataFrame, event_contract: int = EVENT_CONTRACT) -> DataFrame:
    """Active securities that are no event contracts; one without type is none."""
    return securities.filter(F.col("active") & (F.col("type") != event_contract))


def open_contracts(links: DataFrame, events: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Links of unresolved events; of the ``wanted`` event ids only, where given."""
    open_ = unresolved(events).select("event_id")
    if wanted is not None:
        open_ = open_.join(wanted.select("event_id").distinct(), "event_id", "left_semi")
    return links.join(open_, "event_id", "left_semi")


def open_events_of(links: DataFrame, events: DataFrame, securities: DataFrame) -> DataFrame:
    """Distinct unresolved events that hold any of the securities."""
    of = links.join(securities.select("security_id").distinct(), "security_id", "left_semi").select("event_id").distinct()
    return of.join(unresolved(events).select("event_id"), "event_id", "left_semi")


def events_of(links: DataFrame, securities: DataFrame) -> DataFrame:
    """Distinct events, resolved or not, that hold any of the securities."""
    return links.join(securities.select("security_id").distinct(), "security_id", "left_semi").select("event_id").distinct()


def securities_of(links: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct securities of the events."""
    return links.join(events.select("event_id").distinct(), "event_id", "left_semi").select("security_id").distinct()


def open_venue_events(venue_events: DataFrame, events: DataFrame) -> DataFrame:
    """Native events of the venues whose event is unresolved."""
    return venue_events.join(unresolved(events).select("event_id"), "event_id", "left_semi")


def event_info(events: DataFrame, wanted: DataFrame) -> DataFrame:
    """(event_id, title, category, tags) of the wanted events, resolved ones too; unset categories are OTHER, unset tags none."""
    rows = events.join(wanted.select("event_id").distinct(), "event_id", "left_semi")
    return rows.select("event_id", "title", or_default(F.col("category"), "OTHER").alias("category"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))


def event_rows(events: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whole rows of the wanted events, resolved ones too."""
    return events.join(wanted.select("event_id").distinct(), "event_id", "left_semi")


def cached_or_stored(keys: DataFrame, cache: DataFrame, stored: DataFrame, on: list[str], value: str) -> DataFrame:
    """(*on, value) of every distinct key: what the cache says, else what is stored, else null. A cached 0 says nothing."""
    c = cache.groupBy(*on).agg(F.max(value).alias("_c"))
    s = stored.groupBy(*on).agg(F.max(value).alias("_s"))
    found = F.coalesce(F.nullif("_c", F.lit(0)), F.col("_s"))
    return keys.select(*on).distinct().join(c, on, "left").join(s, on, "left").select(*on, found.alias(value))


def new_links(links: DataFrame, stored: DataFrame) -> DataFrame:
    """Links of (event_id, security_id) pairs not stored yet."""
    return links.join(stored.select("event_id", "security_id"), ["event_id", "security_id"], "left_anti")


def united_ids(new: DataFrame, extra: DataFrame) -> DataFrame:
    """Distinct security ids of both."""
    return new.select("security_id").unionByName(extra.select("security_id")).distinct()


def latest_names(messages: DataFrame, key: str, name: str, order: str) -> DataFrame:
    """(key, name): of repeated keys the last message in order names it."""
    return messages.groupBy(key).agg(F.max_by(name, order).alias(name))


def ids_in_order(messages: DataFrame, key: str, order: str) -> DataFrame:
    """(order, key) of every message that has a key, repeated ones as often as they come."""
    return messages.filter(F.col(key).isNotNull()).select(order, key)


def enrich_new(securities: DataFrame, links: DataFrame, created: DataFrame) -> DataFrame:
    """New securities with the created event they belong to; of several the highest id, of none null."""
    of = links.join(created.select("event_id", F.col("title").alias("event_name")), "event_id").groupBy("security_id").agg(F.max_by(F.struct("event_id", "event_name"), "event_id").alias("_e"))
    return securities.join(of, "security_id", "left").select(*securities.columns, F.col("_e.event_id").alias("created_event_id"), F.col("_e.event_name").alias("created_event_name"))


def with_neighbours(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs of events both of which hold a contract, whether it is new or was there before."""
    held = links.select("event_id").distinct()
    return pairs.join(held.withColumnRenamed("event_id", "a"), "a", "left_semi").join(held.withColumnRenamed("event_id", "b"), "b", "left_semi").select(*pairs.columns)


def counters(parts: dict[str, DataFrame], conditions: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """(name, n): rows of every part, and under ``<part>_<name>`` how many of them fulfil each of its conditions."""
    out = None
    for part, df in parts.items():
        named = {part: F.count(F.lit(1)), **{f"{part}_{k}": F.count_if(c) for k, c in (conditions or {}).get(part, {}).items()}}
        row = df.agg(*[c.alias(n) for n, c in named.items()])
        rows = row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in named])))
        out = rows if out is None else out.unionByName(rows)
    return out
