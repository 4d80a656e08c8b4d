"""The domain's handlers of micro-batches: entities from contracts, cascades from resolved and stale messages, vectors and relations of new securities, notifications.

State is a set of keyed logs in a ``TableStore``. Every handler reads the state before its batch and writes under the batch's number, so a replay gives what it gave.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import lifecycle, lookups
from weftline.plans import pipeline, ports
from weftline.sources.store import TableStore
from weftline.streaming.ingest import Handler

#: name -> (schema, keys)
TABLES = {
    "events": ("event_id long, title string, description string, category string, expiry timestamp, resolved boolean, resolved_at timestamp", ["event_id"]),
    "venue_events": ("exchange_id long, native_id string, event_id long", ["exchange_id", "native_id"]),
    "securities": ("security_id long, symbol string, active boolean", ["security_id"]),
    "listings": ("exchange_id long, exchange_security_id string, native_id string, security_id long, active boolean", ["exchange_id", "exchange_security_id"]),
    "links": ("event_id long, security_id long, outcome_label string", ["event_id", "security_id"]),
    "currencies": ("symbol string", ["symbol"]),
    "specs": ("exchange_id long, exchange_security_id string, tick_size double, lot_size double, min_notional double, contract_multiplier double", ["exchange_id", "exchange_security_id"]),
    "embeddings": ("event_id long, embedding array<float>", ["event_id"]),
    "relations": ("security_id_a long, security_id_b long, relationship_type string, confidence double, method string", ["security_id_a", "security_id_b", "relationship_type", "method"]),
    "messages": ("type string, security_id long, security_symbol string, event_id long, event_name string", ["type", "security_id"]),
}
_TEXTS = ("exchange_security_id", "event_title", "outcome_label", "event_category", "event_description", "event_expiry", "base_currency", "quote_currency", "settle_currency")
CONTRACTS = f"array<struct<{', '.join([*(f'{c}:string' for c in _TEXTS), *(f'{c}:double' for c in pipeline.SPECS)])}>>"


def current(store: TableStore, name: str, before: int | None = None) -> DataFrame:
    """A table's state, with the changes of batches below ``before`` only where given."""
    schema, keys = TABLES[name]
    return store.state(name, schema, keys, before)


class Worker:
    """Handlers over one store. Messages of one batch and kind are handled together; kinds run in order, so each kind has a part of the batch's number for itself."""

    KINDS = 4

    def __init__(self, store: TableStore, config: pipeline.EngineConfig, judge: pipeline.Judge = pipeline.label_judge, embed: Callable[[DataFrame], DataFrame] = ports.hashing_embedder, canonical: ports.Canonicalizer = ports.identity_canonicalizer):
        self.store, self.config, self.judge, self.embed, self.canonical = store, config, judge, embed, canonical

    def _write(self, name: str, df: DataFrame, at: int) -> None:
        self.store.log(name, df.select(*[c.split()[0] for c in TABLES[name][0].split(", ")]), at)

    def _cascade(self, hit: DataFrame, at: int) -> None:
        """Patches of listings, securities, events and vectors that a set of listings brings with it."""
        now = {n: current(self.store, n, at) for n in ("listings", "securities", "links", "events", "embeddings")}
        out = lifecycle.cascade(now["listings"], now["securities"], now["links"], now["events"], hit, pipeline.LISTING)
        _, events, _ = lifecycle.apply_cascade(out, now["securities"], now["events"], now["embeddings"], F.current_timestamp())
        changed = events.join(out.events, "event_id", "left_semi")
        self._write("events", changed, at)
        self._write("securities", now["securities"].join(out.securities, "security_id", "left_semi").withColumn("active", F.lit(False)), at)
        self._write("embeddings", now["embeddings"].join(out.events, "event_id", "left_semi").withColumn("embedding", F.lit(None).cast("array<float>")), at)
        self._write("listings", now["listings"].join(out.listings.select(*pipeline.LISTING), pipeline.LISTING, "left_semi").withColumn("active", F.lit(False)), at)

    def resolved(self, df: DataFrame, number: int) -> None:
        """Listings that venues report as resolved, by their own id."""
        self._cascade(df.select("exchange_id", F.col("native_id").alias("exchange_security_id")).distinct(), self.KINDS * number)

    def stale(self, df: DataFrame, number: int) -> None:
        """Native events that are gone: all their listings."""
        at = self.KINDS * number + 1
        gone = current(self.store, "listings", at).join(df.select("exchange_id", "native_id").distinct(), ["exchange_id", "native_id"], "left_semi")
        self._cascade(gone.select(*pipeline.LISTING), at)

    def new(self, df: DataFrame, number: int) -> None:
        """Contracts of changed groups: entities, and a message per new security."""
        at = self.KINDS * number + 2
        rows = df.select("exchange_id", "native_id", "seq", F.posexplode(F.from_json("body", CONTRACTS)).alias("i", "c"))
        contracts = rows.select("exchange_id", F.col("native_id").alias("exchange_event_native_id"), "c.*", (F.coalesce("seq", F.lit(0)) * 1_000_000 + F.col("i")).alias("ingest_pos"))
        now = {n: current(self.store, n, at) for n in ("events", "venue_events", "securities", "listings", "links", "currencies", "specs")}
        made = pipeline.resolve_contracts(contracts, pipeline.State(**now), self.config, self.canonical)
        off = now["listings"].join(made.stale_listings, pipeline.LISTING, "left_semi").withColumn("active", F.lit(False))
        self._write("events", made.events.withColumns({"resolved": F.lit(False), "resolved_at": F.lit(None).cast("timestamp")}), at)
        self._write("venue_events", made.venue_events, at)
        self._write("securities", made.securities.withColumn("active", F.lit(True)), at)
        self._write("listings", made.listings.withColumn("active", F.lit(True)).unionByName(off), at)
        self._write("links", made.links, at)
        self._write("currencies", made.currencies, at)
        self._write("specs", made.specs, at)
        self._write("messages", pipeline.outgoing_messages(made), at)

    def embed_new(self, df: DataFrame, number: int) -> None:
        """Vectors of unresolved events that have none yet, whatever the messages name."""
        at = self.KINDS * number + 3
        events, there = current(self.store, "events", at), current(self.store, "embeddings", at).filter("embedding is not null")
        done = ports.embed_missing(events, there, self.embed)
        self._write("embeddings", done.join(there.select("event_id"), "event_id", "left_anti"), at)

    def relate(self, df: DataFrame, number: int) -> None:
        """Relations of the new securities that the messages name, repeated ones once."""
        at = self.KINDS * number + 3
        events, links = current(self.store, "events", at), current(self.store, "links", at)
        stored = current(self.store, "relations", at)
        new = df.select("security_id").filter("security_id is not null").distinct()
        open_links = lookups.open_contracts(links, events)
        vectors = current(self.store, "embeddings").filter("embedding is not null").join(lookups.unresolved(events).select("event_id"), "event_id", "left_semi")
        pairs = pipeline.candidate_pairs(vectors, events, open_links, self.config, lookups.open_events_of(links, events, new))
        self._write("relations", pipeline.classify_semantic(pairs, events, open_links, stored, self.config, self.judge, new=new).relations, at)

    def normalizing(self) -> dict[str, Handler]:
        """Handlers of the first stage; ``run_batches`` runs them in its order: resolved, stale, new."""
        return {"resolved": self.resolved, "stale": self.stale, "new": self.new}

    def notify(self, df: DataFrame, number: int, most: int = 20) -> DataFrame:
        """Sections of a notification from a batch's messages; where they go is the caller's."""
        return ports.notification(df, most)

