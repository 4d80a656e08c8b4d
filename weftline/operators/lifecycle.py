"""The cascade listing -> security -> event, as a function of the state before and the listings hit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Cascade:
    """What goes off: listings, securities without any active listing left, events without any active security left."""

    listings: DataFrame
    securities: DataFrame
    events: DataFrame


def cascade(listings: DataFrame, securities: DataFrame, links: DataFrame, events: DataFrame, hit: DataFrame, key: list[str]) -> Cascade:
    """``listings``: *key, security_id, active; ``securities``: security_id, active; ``links``: event_id, security_id; ``events``: event_id, resolved; ``hit``: *key.

    Reads see the patches made before them, so the state after is worked out by anti joins. Only
    securities and events that the hit reaches are looked at; a second run changes nothing.
    """
    off = listings.filter("active").join(hit.select(*key).distinct(), key, "left_semi")
    left = listings.filter("active").join(hit.select(*key).distinct(), key, "left_anti")
    touched = off.select("security_id").distinct()
    dead = securities.filter("active").join(touched, "security_id", "left_semi").join(left.select("security_id"), "security_id", "left_anti").select("security_id")
    near = links.join(dead, "security_id", "left_semi").select("event_id").distinct()
    alive = securities.filter("active").join(dead, "security_id", "left_anti").select("security_id")
    living = links.join(alive, "security_id", "left_semi").select("event_id")
    over = events.filter(~F.col("resolved")).join(near, "event_id", "left_semi").join(living, "event_id", "left_anti").select("event_id")
    return Cascade(off.select(*key, "security_id"), dead, over)


def resolve_ids(listings: DataFrame, securities: DataFrame, links: DataFrame, events: DataFrame, resolved: DataFrame) -> Cascade:
    """The cascade from what venues report as resolved: (exchange_id, native_id) of listings, repeated and unknown ones included."""
    hit = resolved.select("exchange_id", F.col("native_id").alias("exchange_security_id")).distinct()
    return cascade(listings, securities, links, events, hit, ["exchange_id", "exchange_security_id"])


def apply_cascade(out: Cascade, securities: DataFrame, events: DataFrame, vectors: DataFrame, at: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(securities, events, vectors) after the cascade: inactive, resolved at the given time, without vectors of resolved events; what was resolved before keeps its time."""
    off = securities.join(out.securities.select("security_id", F.lit(True).alias("_off")), "security_id", "left")
    off = off.withColumn("active", F.col("active") & F.col("_off").isNull()).select(*securities.columns)
    done = events.join(out.events.select("event_id", F.lit(True).alias("_off")), "event_id", "left")
    done = done.withColumns({"resolved": F.coalesce("resolved", F.lit(False)) | F.col("_off").isNotNull(), "resolved_at": F.when(F.col("_off"), at).otherwise(F.col("resolved_at"))}).select(*events.columns)
    return off, done, vectors.join(out.events, "event_id", "left_anti")


def still_active(listings: DataFrame) -> DataFrame:
    """Distinct securities with an active listing."""
    return listings.filter("active").select("security_id").distinct()


def active_count(links: DataFrame, securities: DataFrame) -> DataFrame:
    """Active securities per event; events without any count 0."""
    flags = links.join(securities.select("security_id", F.col("active").alias("_a")), "security_id", "left")
    return flags.groupBy("event_id").agg(F.count_if(F.coalesce("_a", F.lit(False))).alias("n_active"))


def reconcile(listings: DataFrame, batch: DataFrame, native: list[str], key: list[str]) -> DataFrame:
    """Active listings of native events in the batch that the batch no longer lists."""
    return listings.filter("active").join(batch.select(*native).distinct(), native, "left_semi").join(batch.select(*key).distinct(), key, "left_anti").select(*key)
