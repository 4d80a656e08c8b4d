"""Every query against its SQL on the smallest tables, and what the operators' state rules promise."""

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from weftline.operators import changes, entities, lifecycle, relations
from weftline.plans import pipeline, registry


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, Decimal):
        return float(v)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(name, spark, data, con):
    df = registry.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(registry.ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_gives_rows_with_unique_keys(name, spark, data):
    df = registry.QUERIES[name](spark, data)
    keys = {"p7_found": ["feed_pos", "market_pos", "field", "value_pos"]}[name]
    assert 0 < df.count() == df.select(*keys).distinct().count()


def test_what_is_told_decides_little_that_neighbours_do_not(spark, data):
    told, found = (registry.QUERIES[q](spark, data) for q in ("p2_found", "p2_undeclared"))
    both = told.join(found.withColumnRenamed("epoch_us", "alone"), ["source", "row_id", "market_pos"])
    n = both.count()
    assert n == told.count() and both.filter("epoch_us = alone").count() >= 0.99 * n


def feed(spark, rows):
    return spark.createDataFrame([(1, n, s, lb, "t", v, p) for p, (n, s, lb, v) in enumerate(rows)], "exchange_id long, native_id string, security_id string, label string, title string, volume double, pos long")


def test_diff_twice_sends_nothing_and_caps_come_again(spark):
    now = feed(spark, [("a", "a1", "Yes", 5.0), ("a", "a2", "No", 5.0), ("b", "b1", "Yes", None), ("c", "c1", "Yes", 0.5)])
    none = spark.createDataFrame([], "exchange_id long, security_id string, hash string")
    one = changes.diff_contracts(now, none, least_volume=1.0, most=1)
    assert [r.native_id for r in one.messages.collect()] == ["a"]
    assert {r.security_id for r in one.hashes.collect()} == {"a1", "a2"}
    two = changes.diff_contracts(now, one.hashes, least_volume=1.0)
    assert [r.native_id for r in two.messages.collect()] == ["b"]
    assert changes.diff_contracts(now, two.hashes, least_volume=1.0).messages.count() == 0


def test_failed_exchange_keeps_its_hashes(spark):
    known = spark.createDataFrame([(2, "x", "h")], "exchange_id long, security_id string, hash string")
    failed = spark.createDataFrame([(2,)], "exchange_id long")
    assert ("x",) in [(r.security_id,) for r in changes.diff_contracts(feed(spark, []), known, failed).hashes.collect()]


def test_tracker(spark):
    t = spark.createDataFrame([(1, "gone", 1), (1, "here", 2), (1, "first", 0)], "exchange_id long, native_id string, misses int")
    a = spark.createDataFrame([(1, "here"), (1, "new"), (1, "new")], "exchange_id long, native_id string")
    state, stale = changes.update_tracker(t, a, 2)
    assert {(r.native_id, r.misses) for r in state.collect()} == {("here", 0), ("new", 0), ("first", 1)}
    assert [r.native_id for r in stale.collect()] == ["gone"]


def test_tracker_overflow_stays_at_the_threshold(spark):
    t = spark.createDataFrame([(1, k, 1) for k in "abc"] + [(2, "f", 1)], "exchange_id long, native_id string, misses int")
    none = spark.createDataFrame([(2, "new")], "exchange_id long, native_id string")
    state, stale = changes.update_tracker(t, none, 2, F.col("exchange_id") == 2, most=2)
    assert [r.native_id for r in stale.orderBy("native_id").collect()] == ["a", "b"]
    assert {(r.native_id, r.misses) for r in state.collect()} == {("c", 2), ("f", 1), ("new", 0)}


def test_derived_edges(spark):
    judged = spark.createDataFrame([(1, 3, "IMPLIES", 0.9), (1, 5, "EQUIVALENT", 0.8), (3, 9, "MUTUALLY_EXCLUSIVE", 0.7)], "security_id_a long, security_id_b long, relationship_type string, confidence double")
    comp = spark.createDataFrame([(1, 2), (2, 1), (3, 4), (4, 3)], "security_id long, other_id long")
    got = {tuple(r)[:3] for r in relations.derive(judged, comp).collect()}
    assert got == {(1, 3, "IMPLIES"), (4, 2, "IMPLIES"), (1, 5, "EQUIVALENT"), (3, 9, "MUTUALLY_EXCLUSIVE"), (9, 4, "IMPLIES")}


def test_cascade_spares_what_is_still_listed_and_settles(spark):
    listings = spark.createDataFrame([(1, "l1", 10, True), (2, "l2", 10, True), (1, "l3", 11, True)], "exchange_id long, sid string, security_id long, active boolean")
    securities = spark.createDataFrame([(10, True), (11, True)], "security_id long, active boolean")
    links = spark.createDataFrame([(100, 10), (101, 11), (102, 10), (102, 11)], "event_id long, security_id long")
    events = spark.createDataFrame([(100, False), (101, False), (102, False)], "event_id long, resolved boolean")
    hit = spark.createDataFrame([(1, "l1"), (1, "l3"), (1, "l3")], "exchange_id long, sid string")
    out = lifecycle.cascade(listings, securities, links, events, hit, ["exchange_id", "sid"])
    assert {r.sid for r in out.listings.collect()} == {"l1", "l3"}
    assert [r.security_id for r in out.securities.collect()] == [11]
    assert [r.event_id for r in out.events.collect()] == [101]


def test_leaders_are_not_transitive(spark):
    rows = spark.createDataFrame([("t", 0, 0), ("t", 8, 1), ("t", 16, 2), ("t", None, 3), ("t", None, 4), ("u", 0, 5)], "title string, v long, pos long")
    got = {(r.title, r.v): r.leader_pos for r in entities.leaders(rows, "title", "v", "pos", 10).collect()}
    assert got == {("t", 0): 0, ("t", 8): 0, ("t", 16): 2, ("t", None): 3, ("u", 0): 5}


def test_ids_are_dense_and_after_the_taken_ones(spark):
    rows = spark.range(1000).selectExpr("id * 7 % 1000 as k")
    got = entities.with_ids(rows, spark.createDataFrame([(41,)], "id long"), "id", ["k"]).orderBy("k").collect()
    assert [r.id for r in got] == list(range(42, 1042))


def test_written_pairs_are_unique_and_blocked_both_ways(spark):
    m = spark.createDataFrame([(1, 2, "EQUIVALENT", 0.9, 1), (1, 2, "IMPLIES", 0.9, 2), (3, 4, "IMPLIES", 0.8, 3), (5, 6, "IMPLIES", 0.6, 4)], "security_id_a long, security_id_b long, relationship_type string, confidence double, seq long")
    there = spark.createDataFrame([(4, 3, "rule"), (2, 1, "manual")], "security_id_a long, security_id_b long, method string")
    got = relations.to_write(m, there, "seq", 0.7).collect()
    assert [(r.security_id_a, r.relationship_type) for r in got] == [(1, "EQUIVALENT")]


def test_one_bad_judgement_voids_the_response(spark):
    ok, bad = '```json\n[{"a":1,"b":1,"type":"implies","confidence":0.9,"direction":"B_IMPLIES_A"}]\n```', '[{"a":1,"b":1,"type":"IMPLIES","confidence":"high"}]'
    r = spark.createDataFrame([("p", ok), ("q", bad), ("z", "no json")], "pair_id string, text string")
    c = spark.createDataFrame([(p, s, 1, n) for p in "pqz" for s, n in (("a", 1), ("b", 2))], "pair_id string, side string, place int, security_id long")
    assert [tuple(x) for x in relations.judged_pairs(r, c).collect()] == [(2, 1, "IMPLIES", 0.9)]


def test_the_whole_run(spark):
    contract = lambda ex, nat, sid, title, label, pos: (ex, nat, sid, title, label, "Politics", None, "2026-05-01", "USDC", "USDC", "USDC", 0.01, 1.0, 0.0, 1.0, pos)
    schema = "exchange_id long, exchange_event_native_id string, exchange_security_id string, event_title string, outcome_label string, event_category string, event_description string, event_expiry string, base_currency string, quote_currency string, settle_currency string, tick_size double, lot_size double, min_notional double, contract_multiplier double, ingest_pos long"
    rows = [contract(1, "n1", "a1", "harbour vote", "Yes", 1), contract(1, "n1", "a2", "harbour vote", "No", 2), contract(2, "n2", "b1", "harbour vote now", "Yes", 3), contract(2, "n2", "b2", "harbour vote now", "No", 4), contract(2, "k", "c1", "reworded", "Yes", 5)]
    none = lambda ddl: spark.createDataFrame([], ddl)
    state = pipeline.State(
        spark.sql("select 7L event_id, 'stored title' title, cast(null as string) description, 'Politics' category, timestamp'2026-05-01' expiry, false resolved"), spark.sql("select 2L exchange_id, 'k' native_id, 7L event_id"),
        none("security_id long, symbol string"), none("exchange_id long, exchange_security_id string, native_id string, security_id long, active boolean"), none("event_id long, security_id long, outcome_label string"),
        none("symbol string"), none("exchange_id long, exchange_security_id string, tick_size double, lot_size double, min_notional double, contract_multiplier double"),
    )
    config = pipeline.EngineConfig(neighbours=5, least_similarity=0.8)
    words = spark.createDataFrame([("harbour", 900)], "keyword string, keyword_security_id long")
    rel = none("security_id_a long, security_id_b long, relationship_type string, confidence double, method string")
    out = pipeline.run_pipeline(spark.createDataFrame(rows, schema), state, none("event_id long, embedding array<float>"), rel, words, config, pipeline.label_judge)
    assert {r.name: r.n for r in out.counters.collect()} == {"events": 2, "securities": 5, "listings": 5, "links": 5, "specs": 5}
    assert {r.event_id for r in out.entities.venue_events.collect()} == {8, 9} and out.embeddings.count() == 3
    assert out.structural.relations.filter("security_id_b = 900").count() == 4
    found = out.semantic.relations.collect()
    # Yes with Yes and, by complement, No with No, in both directions
    assert len(found) == 4 and {r.relationship_type for r in found} == {"EQUIVALENT"} and tuple(out.semantic.counts.first()) == (4, 0)
    symbols = {r.security_id: r.symbol for r in out.entities.securities.collect()}
    assert all(symbols[r.security_id_a].rsplit("-", 1)[1] == symbols[r.security_id_b].rsplit("-", 1)[1] for r in found)
    cache = spark.createDataFrame([("k0", "No", "No", "MUTUALLY_EXCLUSIVE", 0.9, None)], "pair_key string, first_label string, second_label string, type string, confidence double, direction string")
    asked = pipeline.to_judge(pipeline.candidate_pairs(out.embeddings, state.events.select("event_id", "title", "description", "category").unionByName(out.entities.events.select("event_id", "title", "description", "category")), out.entities.links, config), out.entities.events, out.entities.links, config)
    cache = cache.withColumn("pair_key", F.lit(asked.first().pair_key))
    cached = pipeline.run_pipeline(spark.createDataFrame(rows, schema), state, none("event_id long, embedding array<float>"), rel, words, config, pipeline.label_judge, cache=cache).semantic.relations.collect()
    # what is cached is not asked for: the primary contracts exclude each other, so each implies the other's complement
    assert {r.relationship_type for r in cached} == {"MUTUALLY_EXCLUSIVE", "IMPLIES"} and len(cached) == 4


def test_judgements_are_cached_by_label_and_come_back_the_same(spark):
    events = spark.createDataFrame([(1, "B title", None, "x"), (2, "A title", None, "x")], "event_id long, title string, description string, category string")
    links = spark.createDataFrame([(1, 10, "u"), (1, 11, "v"), (1, 12, "w"), (2, 20, "p"), (2, 21, "q"), (2, 22, "r")], "event_id long, security_id long, outcome_label string")
    pairs = spark.createDataFrame([(1, 2, 0.9)], "a long, b long, sim double")
    rel = spark.createDataFrame([], "security_id_a long, security_id_b long, relationship_type string, confidence double, method string")
    text = '[{"a": 2, "b": 3, "type": "IMPLIES", "confidence": 0.8, "direction": "B_IMPLIES_A"}, {"a": 9, "b": 1, "type": "EQUIVALENT", "confidence": 0.9}]'
    asked = []

    def judge(df):
        asked.append(df.count())
        return df.select("pair_id", F.lit(text).alias("text"))

    one = pipeline.classify_semantic(pairs, events, links, rel, pipeline.EngineConfig(), judge)
    assert [tuple(r)[:3] for r in one.relations.collect()] == [(22, 11, "IMPLIES")]
    assert [tuple(r)[1:] for r in one.cache.collect()] == [("r", "v", "IMPLIES", 0.8, "B_IMPLIES_A")]
    two = pipeline.classify_semantic(pairs, events, links, rel, pipeline.EngineConfig(), judge, one.cache)
    assert asked == [1, 0] and sorted(map(tuple, two.relations.collect())) == sorted(map(tuple, one.relations.collect()))
