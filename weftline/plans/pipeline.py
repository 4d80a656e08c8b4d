"""The whole path: contracts in, new entities, judged and derived relations out. State goes in and what changes comes out; nothing is written here."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions.scalars import first_is_a, pair_key, parse_utc, security_symbol
from weftline.operators import changes, entities, lifecycle, lookups, relations, vectors
from weftline.plans import ports
from weftline.plans.ports import Canonicalizer, hashing_embedder, identity_canonicalizer
from weftline.session import cut

SPECS = ["tick_size", "lot_size", "min_notional", "contract_multiplier"]
LISTING = ["exchange_id", "exchange_security_id"]
#: (vectors, key, vector column, k, least similarity) -> (a, b, sim), each pair once; the exact form, or an approximate one given as a port.
Neighbours = Callable[[DataFrame, str, str, int, float], DataFrame]
#: (pairs with titles, descriptions and labels) -> responses (pair_id, text).
Judge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class EngineConfig:
    """Parameters of a run; fixed for a micro-batch."""

    least_volume: float | None = None
    most_messages: int | None = None
    tolerance_s: int = 3600
    neighbours: int = 60
    least_similarity: float = 0.85
    least_judged: float = 0.7
    least_confidence: float = 0.7
    hedge_confidence: float = 1.0
    allowed_categories: tuple[str, ...] = ()
    stale_after: int = 3
    model: str = "judge-1"
    extra: dict = field(default_factory=dict)


@dataclass
class State:
    """What is stored. events: event_id, title, description, category, expiry, resolved; venue_events: exchange_id, native_id, event_id; securities: security_id, symbol;
    listings: exchange_id, exchange_security_id, native_id, security_id, active; links: event_id, security_id, outcome_label; currencies: symbol; specs: keys of the listing and values, the last of each."""

    events: DataFrame
    venue_events: DataFrame
    securities: DataFrame
    listings: DataFrame
    links: DataFrame
    currencies: DataFrame
    specs: DataFrame


@dataclass
class Entities:
    """What a batch adds, and the listings of its native events that it no longer has."""

    events: DataFrame
    venue_events: DataFrame
    securities: DataFrame
    listings: DataFrame
    links: DataFrame
    currencies: DataFrame
    specs: DataFrame
    stale_listings: DataFrame


def prepare(contracts: DataFrame, venue_events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, groups of known native events with their event_id, groups still to be named): only the latter need a canonical form."""
    rows = contracts.select(
        "exchange_id", F.col("exchange_event_native_id").alias("native_id"), "exchange_security_id", "event_title", "outcome_label", "event_category", "event_description",
        parse_utc(F.col("event_expiry")).alias("expiry"), F.col("ingest_pos").alias("pos"), "base_currency", "quote_currency", "settle_currency", *SPECS,
    )
    rows = rows.filter("exchange_id is not null and native_id is not null and exchange_security_id is not null and event_title is not null")
    groups = changes.first_of_group(rows, changes.NATIVE, "pos", "event_title", "event_category", "event_description", "expiry", "pos")
    known = venue_events.groupBy(*changes.NATIVE).agg(F.min("event_id").alias("event_id"))
    return rows, *entities.split_known(groups, known, changes.NATIVE)


def resolve_contracts(contracts: DataFrame, state: State, config: EngineConfig, canonical: Canonicalizer = identity_canonicalizer) -> Entities:
    """New entities of a batch; the first contract in order stands for its event.

    A native event that is stored keeps its event, whatever its title says now. A new one of the same canonical title with a close expiry is the
    same event: first an open stored one (the lowest id), then an earlier leader of the batch. A symbol that exists is the same security; stored links and
    listings are not added again. Of a listing delivered more than once the last specs count.
    """
    rows, known, new = prepare(contracts, state.venue_events)
    named = canonical(new.select(F.col("pos").alias("key"), F.col("event_title").alias("title"), F.col("event_category").alias("category")))
    heads = cut(new.select(*changes.NATIVE, F.col("pos").alias("key"), "expiry", F.col("event_description").alias("description")).join(named, "key"))
    same = entities.tolerance_join(heads.select("key", "title", "expiry"), lookups.unresolved(state.events), config.tolerance_s)
    fresh = heads.join(same, "key", "left_anti").withColumn("t", F.unix_micros("expiry"))
    led = entities.leaders(fresh, "title", "t", "key", config.tolerance_s * 1_000_000).withColumnsRenamed({"title": "_title", "t": "_t"})
    placed = fresh.join(led, (F.col("title") == F.col("_title")) & F.col("t").eqNullSafe(F.col("_t")))
    new_events = cut(entities.with_ids(placed.filter("key = leader_pos").select(F.col("leader_pos"), "title", "description", "category", "tags", "expiry"), state.events, "event_id", ["leader_pos"]))
    of_key = same.unionByName(placed.join(new_events.select("leader_pos", "event_id"), "leader_pos").select("key", "event_id"))
    added = heads.join(of_key, "key").select(*changes.NATIVE, "title", "event_id")
    titles = state.events.select("event_id", F.col("title").alias("_stored"))
    kept = known.join(titles, "event_id", "left").select(*changes.NATIVE, F.coalesce("_stored", "event_title").alias("title"), "event_id")
    full = rows.join(added.unionByName(kept), changes.NATIVE).withColumn("symbol", security_symbol(F.col("title"), F.col("outcome_label"), F.col("expiry")))
    # five outputs read what follows; it is worked out once
    full = cut(full)
    wanted = entities.new_first(full, state.securities, ["symbol"], "pos", ["outcome_label", "expiry"])
    new_securities = cut(entities.with_ids(wanted.select("symbol", "outcome_label", "expiry"), state.securities, "security_id", ["symbol"]))
    every = state.securities.select("symbol", "security_id").unionByName(new_securities.select("symbol", "security_id"))
    owned = full.join(every, "symbol")
    listings = entities.new_first(owned, state.listings, LISTING, "pos", ["native_id", "security_id"])
    links = owned.groupBy("event_id", "security_id").agg(F.min_by("outcome_label", "pos").alias("outcome_label"))
    current = entities.latest_spec(full, LISTING, SPECS, ["pos"])
    active = state.listings.filter("active")
    return Entities(
        new_events.drop("leader_pos"),
        added.select(*changes.NATIVE, "event_id"),
        new_securities,
        listings.select(*LISTING, "native_id", "security_id"),
        lookups.new_links(links, state.links),
        entities.new_currencies(full, state.currencies),
        entities.spec_changes(current, state.specs, LISTING, SPECS),
        lifecycle.reconcile(active, full, changes.NATIVE, LISTING),
    )


def _primary(links: DataFrame) -> DataFrame:
    """Links of every event's primary contracts."""
    return relations.primary_contracts(links.select("event_id", "security_id")).join(links.select("event_id", "security_id", "outcome_label"), ["event_id", "security_id"])


def _labels(links: DataFrame) -> DataFrame:
    """Labels and securities of every event's primary contracts, in order of security."""
    return _primary(links).groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("security_id", F.coalesce("outcome_label", F.lit("")).alias("label")))).alias("_c"))


def candidate_pairs(
    embedded: DataFrame, events: DataFrame, links: DataFrame, config: EngineConfig, new_events: DataFrame | None = None, neighbours: Neighbours = vectors.exact_neighbours
) -> DataFrame:
    """(a, b, sim): pairs of events close enough to be judged, both with contracts.

    Without ``new_events`` a pair goes only where neither side's category is allowed; with it, a pair has a new event of an allowed category on at least one side.
    """
    pairs = neighbours(embedded, "event_id", "embedding", config.neighbours, config.least_similarity)
    pairs = lookups.with_neighbours(pairs.select("a", "b", "sim"), links)
    allowed = list(config.allowed_categories)
    if new_events is not None:
        starts = relations.allowed_sources(events.join(new_events.select("event_id").distinct(), "event_id", "left_semi"), allowed).select("event_id", F.lit(True).alias("_s"))
        pairs = pairs.join(starts.toDF("a", "_sa"), "a", "left").join(starts.toDF("b", "_sb"), "b", "left").filter(F.coalesce("_sa", "_sb", F.lit(False)))
    elif allowed:
        cats = events.select("event_id", F.nullif("category", F.lit("")))
        both = pairs.join(cats.toDF("a", "category_a"), "a").join(cats.toDF("b", "category_b"), "b")
        pairs = relations.allowed_pairs(both, allowed)
    return pairs.select("a", "b", "sim")


def to_judge(pairs: DataFrame, events: DataFrame, links: DataFrame, config: EngineConfig) -> DataFrame:
    """Pairs with what a judge is told of them: titles, descriptions and labels of the primary contracts, and the key under which judgements are kept."""
    told = events.select("event_id", "title", "description").join(_labels(links), "event_id")
    for side in ("a", "b"):
        named = told.select(F.col("event_id").alias(side), F.col("title").alias(f"title_{side}"), F.col("description").alias(f"description_{side}"), F.transform("_c", lambda x: x["label"]).alias(f"labels_{side}"), F.transform("_c", lambda x: x["security_id"]).alias(f"ids_{side}"))
        pairs = pairs.join(named, side)
    sides = [F.col(c) for c in ("title_a", "labels_a", "title_b", "labels_b")]
    key = pair_key(F.lit(config.model), *sides)
    # events of the same title and labels share a key, so a pair is known by its events
    return pairs.withColumns({"pair_id": F.concat_ws("-", "a", "b"), "pair_key": key, "a_first": first_is_a(*sides)})


def places(asked: DataFrame) -> DataFrame:
    """(pair_id, side, place, security_id): what the numbers in a response stand for, from 1."""
    parts = [asked.select("pair_id", F.lit(s).alias("side"), F.posexplode(f"ids_{s}").alias("place", "security_id")) for s in ("a", "b")]
    return parts[0].unionByName(parts[1]).withColumn("place", F.col("place") + 1)


@dataclass
class Classified:
    """Relations to append, how many were left out for low confidence, and judgements to add to the cache."""

    relations: DataFrame
    counts: DataFrame
    cache: DataFrame | None = None


def cache_rows(responses: DataFrame, asked: DataFrame) -> DataFrame:
    """(pair_key, first_label, second_label, type, confidence, direction): judgements as the cache keeps them, by label and in the order of the pair's key, whichever side
    was asked for first. Places that do not exist and items without confidence are not kept; of pairs of one key the lowest speaks for all."""
    items = responses.select("pair_id", F.inline(relations.parse_judgement(F.col("text"))))
    items = items.select("pair_id", F.col("a").try_cast("int").alias("pa"), F.col("b").try_cast("int").alias("pb"), "type", F.col("confidence").try_cast("double").alias("confidence"), "direction").filter("confidence is not null")
    at = items.join(asked.select("pair_id", "pair_key", "a_first", "labels_a", "labels_b"), "pair_id")
    label = lambda c, place: F.get(c, F.col(place) - 1)
    la, lb = label("labels_a", "pa"), label("labels_b", "pb")
    rows = at.select("pair_key", "pair_id", F.when(F.col("a_first"), la).otherwise(lb).alias("first_label"), F.when(F.col("a_first"), lb).otherwise(la).alias("second_label"), "type", "confidence", "direction")
    rows = rows.filter("first_label is not null and second_label is not null")
    lowest = rows.groupBy("pair_key").agg(F.min("pair_id").alias("pair_id"))
    return rows.join(lowest, ["pair_key", "pair_id"]).drop("pair_id")


def classify_structural(contracts: DataFrame, keywords: DataFrame, existing: DataFrame, config: EngineConfig, new: DataFrame | None = None) -> Classified:
    """Relations by keyword. contracts: security_id, text; keywords: keyword, keyword_security_id."""
    found = relations.hedge_relations(contracts, keywords, config.hedge_confidence).withColumn("seq", F.col("security_id_b"))
    kept = relations.to_write(found.drop("method"), existing, "seq", config.least_confidence, new).withColumn("method", F.lit("rule"))
    return Classified(kept.drop("seq"), relations.write_counts(found.drop("method"), existing, "seq", config.least_confidence, new))


def classify_semantic(
    pairs: DataFrame, events: DataFrame, links: DataFrame, existing: DataFrame, config: EngineConfig, judge: Judge, cache: DataFrame | None = None, new: DataFrame | None = None
) -> Classified:
    """Candidates, their judgements (cached ones are not asked for), what follows from them, and of all that what is to be written.

    cache: pair_key, first_label, second_label, type, confidence, direction. Complements come from the contracts of all events concerned, not only of the new ones.
    """
    asked = cut(to_judge(pairs, events, links, config))
    judged = None
    pending = asked
    if cache is not None:
        hit, pending = ports.split_cached(asked, cache.select("pair_key").distinct())
        at = hit.select("pair_key", "pair_id", F.col("a").alias("event_a"), F.col("b").alias("event_b"), "a_first")
        items = cache.join(at.select("pair_key", "pair_id"), "pair_key").drop("pair_key")
        judged = relations.cached_relations(items, _primary(links), at.drop("pair_key"))
    responses = cut(judge(pending))
    answered = relations.judged_pairs(responses, places(pending), config.least_judged)
    judged = answered if judged is None else judged.unionByName(answered)
    every = relations.derive(judged, relations.complement_map(links.select("event_id", "security_id")))
    # one order for equal confidences, the same in every run
    matches = every.distinct().withColumn("seq", F.row_number().over(Window.partitionBy("security_id_a", "security_id_b").orderBy("relationship_type", F.desc("confidence"))).cast("long"))
    kept = relations.to_write(matches, existing, "seq", config.least_confidence, new).withColumn("method", F.lit("embedding"))
    return Classified(kept.drop("seq"), relations.write_counts(matches, existing, "seq", config.least_confidence, new), cache_rows(responses, pending))


@dataclass
class Run:
    """Everything one run of the pipeline would append, and its counters (name, n)."""

    entities: Entities
    embeddings: DataFrame
    structural: Classified
    semantic: Classified
    counters: DataFrame


def run_pipeline(
    contracts: DataFrame,
    state: State,
    embeddings: DataFrame,
    relationships: DataFrame,
    keywords: DataFrame,
    config: EngineConfig,
    judge: Judge,
    canonical: Canonicalizer = identity_canonicalizer,
    embed: Callable[[DataFrame], DataFrame] = hashing_embedder,
    cache: DataFrame | None = None,
    neighbours: Neighbours = vectors.exact_neighbours,
) -> Run:
    """A batch of contracts to entities, vectors of events that had none, and relations of the new securities; with a batch that brings none, of all."""
    made = resolve_contracts(contracts, state, config, canonical)
    cols = ["event_id", "title", "description", "category", "expiry"]
    events = state.events.select(*cols, "resolved").unionByName(made.events.select(*cols, F.lit(False).alias("resolved")))
    links = cut(state.links.select("event_id", "security_id", "outcome_label").unionByName(made.links))
    vectors_ = cut(ports.embed_missing(events, embeddings, embed))
    new = cut(made.securities.select("security_id"))
    some = not new.isEmpty()
    open_links = lookups.open_contracts(links, events)
    wanted = lookups.open_events_of(links, events, new) if some else None
    texts = (open_links if wanted is None else open_links.join(wanted, "event_id", "left_semi")).join(events.select("event_id", "title"), "event_id")
    structural = classify_structural(texts.select("security_id", F.concat_ws(" ", "title", "outcome_label").alias("text")), keywords, relationships, config, new if some else None)
    live = vectors_.join(lookups.unresolved(events).select("event_id"), "event_id", "left_semi").filter("embedding is not null")
    pairs = candidate_pairs(live, events, open_links, config, wanted, neighbours)
    semantic = classify_semantic(pairs, events, links, relationships, config, judge, cache, new if some else None)
    parts = {"events": made.events, "securities": made.securities, "listings": made.listings, "links": made.links, "specs": made.specs}
    return Run(made, vectors_, structural, semantic, lookups.counters(parts))


def label_judge(asked: DataFrame) -> DataFrame:
    """The offline judge: contracts of equal labels (case aside) mean the same, at the pair's similarity; answers as JSON, one list a pair."""
    low = lambda c: F.transform(c, F.lower)
    hits = asked.select("pair_id", "sim", F.posexplode(low("labels_a")).alias("i", "label"), low("labels_b").alias("lb"))
    hits = hits.select("pair_id", "sim", "i", "label", F.posexplode("lb").alias("j", "other")).filter("label = other and label <> ''")
    item = F.to_json(F.struct((F.col("i") + 1).cast("string").alias("a"), (F.col("j") + 1).cast("string").alias("b"), F.lit("EQUIVALENT").alias("type"), F.format_number(F.col("sim"), 4).alias("confidence")))
    texts = hits.groupBy("pair_id").agg(F.array_join(F.array_sort(F.collect_list(item)), ",").alias("t"))
    return texts.select("pair_id", F.concat(F.lit("["), "t", F.lit("]")).alias("text"))


def incoming_messages(contracts: DataFrame, diff: changes.Diff, resolved: DataFrame, stale: DataFrame) -> DataFrame:
    """Messages of a tick: (type, exchange_id, native_id, body): changed event groups with their contracts as JSON, resolved ids, stale events."""
    body = contracts.join(diff.messages.select(*changes.NATIVE), changes.NATIVE, "left_semi").groupBy(*changes.NATIVE).agg(F.to_json(F.array_sort(F.collect_list(F.struct("pos", "security_id", "title", "label")))).alias("body"))
    kinds = [body.select(F.lit("new").alias("type"), *changes.NATIVE, "body")]
    for name, rows in (("resolved", resolved), ("stale", stale)):
        kinds.append(rows.select(F.lit(name).alias("type"), *changes.NATIVE, F.lit(None).cast("string").alias("body")).distinct())
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def outgoing_messages(made: Entities) -> DataFrame:
    """One message per new security, with the created event it belongs to."""
    new = made.securities.select("security_id", F.col("symbol").alias("security_symbol"))
    return lookups.enrich_new(new, made.links, made.events).select(F.lit("new_security").alias("type"), "security_id", "security_symbol", F.col("created_event_id").alias("event_id"), F.col("created_event_name").alias("event_name"))

