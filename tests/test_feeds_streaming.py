import json

import pytest
from pyspark.sql import functions as F

from weftline.plans import ports
from weftline.plans.ports import hashing_embedder, identity_canonicalizer, response_canonicalizer
from weftline.sources import feeds
from weftline.sources.store import TableStore
from weftline.streaming import ingest, workers


def land(spark, tmp_path, venue, page):
    p = tmp_path / f"{venue}.json"
    p.write_text(json.dumps(page))
    return feeds.landed(spark, str(p), venue)


def market(i, **k):
    return {"conditionId": f"c{i}", "question": f"q{i}", "outcomes": '["Yes", "No"]', "clobTokenIds": f'["{i}1", "{i}2"]', "negRisk": False, "closed": False, "volumeNum": 2.0} | k


def test_venue_a(spark, tmp_path):
    page = {"events": [
        {"title": "E", "slug": "e", "endDate": "2026", "description": "d", "tags": [{"label": "T"}], "markets": [market(1, negRisk=True, groupItemTitle="G"), market(2, negRisk=True), market(3, closed=True)]},
        {"title": "F", "slug": "f", "markets": [market(4, question="", clobTokenIds='["41"]'), market(5, conditionId=""), market(6, outcomes="bad")]},
    ]}
    events = land(spark, tmp_path, "a", page)
    got = {(r.exchange_security_id, r.event_title, r.outcome_label, r.exchange_event_native_id, r.event_volume) for r in feeds.venue_a(events).collect()}
    assert got == {("c1:11", "E", "G", "e", 4.0), ("c2:21", "E", "q2", "e", 4.0), ("c4:41", "F", "Yes", "c4", 2.0)}
    assert {r.native_id for r in feeds.resolved_a(events).collect()} == {"c3:31", "c3:32"}


def test_venue_b_decides_the_shape_before_dropping(spark, tmp_path):
    m = lambda t, s="active", y=None: {"ticker": t, "status": s, "yes_sub_title": y, "rules_primary": "r", "close_time": "2026", "volume_fp": "3"}
    events = land(spark, tmp_path, "b", {"events": [
        {"event_ticker": "X", "title": "Pope", "mutually_exclusive": True, "markets": [m("X1", y="A"), m("X2", "finalized")]},
        {"event_ticker": "Y", "title": "Mars", "sub_title": "landing", "series_ticker": "KXM", "mutually_exclusive": True, "markets": [m("Y1", y="by 2099")]},
        {"event_ticker": "Z", "title": "Rain", "markets": [m("Z1", y="May"), m("Z2"), m("", y="June")]},
        {"event_ticker": "", "title": "None", "markets": [m("N1")]},
    ]})
    rows = feeds.venue_b(events).collect()
    got = {(r.exchange_security_id, r.event_title, r.outcome_label, r.exchange_event_native_id, r.event_volume) for r in rows}
    want = {("X1", "Pope", "A", "X", 6.0)} | {(f"Y1:{s.lower()}", "Mars: by 2099", s, "Y", 3.0) for s in ("Yes", "No")} | {(f"{t}:{s.lower()}", f"Rain: {y}", s, t, 3.0) for t, y in (("Z1", "May"), ("Z2", "Z2")) for s in ("Yes", "No")}
    assert got == want and {r.exchange_event_native_url for r in rows if r.exchange_event_native_id == "Y"} == {"https://venue-b.example/event/kxm/mars-landing"}
    assert rows[0].asDict().keys() == set(feeds.CONTRACT) and {(r.contract_type, len(r.exchange_security_symbol) <= 100) for r in rows} == {(2, True), (3, True)}
    assert {r.native_id for r in feeds.resolved_b(events).collect()} == {"X2"}


def test_venue_c(spark, tmp_path):
    o = lambda i, *s: {"outcome": i, "name": f"n{i}", "description": "x", "sideSpecs": [{"name": v} for v in s]}
    q = {"name": "Q", "description": "class:x|category: CRYPTO |expiry:20260301-1030|category:CRYPTO", "namedOutcomes": [1, 2, 3], "fallbackOutcome": 3, "settledNamedOutcomes": []}
    r = {"name": "R", "description": "d", "namedOutcomes": [4, 5], "fallbackOutcome": None, "settledNamedOutcomes": [5]}
    pages = land(spark, tmp_path, "c", {"outcomes": [o(1), o(2), o(3), o(4, "Up", "Down"), o(5), o(6, None, None), o(7)], "questions": [q, r]})
    got = {(x.exchange_security_id, x.event_title, x.outcome_label, x.exchange_event_native_id) for x in feeds.venue_c(pages).collect()}
    assert got == {("@1", "Q", "n1", "q:1"), ("@2", "Q", "n2", "q:1"), ("@4:0", "R", "Up", "o:4"), ("@4:1", "R", "Down", "o:4"), ("@6:0", "n6", "Yes", "o:6"), ("@6:1", "n6", "No", "o:6")}
    assert {(x.exchange_security_id, x.event_category, x.event_expiry, x.event_description) for x in feeds.venue_c(pages).collect() if x.exchange_security_id in ("@1", "@4:0", "@6:1")} == {("@1", "CRYPTO", "2026-03-01T10:30:00Z", None), ("@4:0", None, None, "d"), ("@6:1", None, None, "x")}
    assert {x.native_id for x in feeds.resolved_c(pages).collect()} == {"@5", "@5:0", "@5:1"}


def test_fetch_all_skips_the_unregistered_and_caps(spark, tmp_path):
    events = land(spark, tmp_path, "a", {"events": [{"title": "F", "slug": "f", "markets": [market(1), market(2)]}]})
    exchanges = spark.createDataFrame([(9, "Venue_A")], "exchange_id long, exchange_name string")
    exchanges = exchanges.union(spark.createDataFrame([(8, "venue_b")], exchanges.schema))
    got = feeds.fetch_all({"venue_a": events, "venue_b": events, "other": events}, exchanges, 3)
    assert got.rows.select("exchange_id").distinct().collect()[0][0] == 9 and list(got.failed) == ["venue_b"]
    assert feeds.fetch_all({"venue_a": events}, exchanges, 3).rows.count() == 3
    closed = land(spark, tmp_path, "a", {"events": [{"title": "F", "slug": "f", "markets": [market(1, closed=True), market(2)]}]})
    done = feeds.fetch_resolved({"venue_a": closed, "venue_b": closed}, exchanges)
    assert {tuple(r) for r in done.rows.collect()} == {(9, "c1:11"), (9, "c1:12")} and list(done.failed) == ["venue_b"]
    assert feeds.open_or_closed(closed, "endDate", "2026-01-01", 9).count() == 1
    with pytest.raises(ValueError):
        feeds.exchange_id(exchanges, "nowhere")


def test_store_survives_a_broken_write(spark, tmp_path):
    s = TableStore(spark, str(tmp_path))
    assert s.read("t", "a long").count() == 0
    for i in range(5):
        s.write("t", spark.range(i + 1).selectExpr("id as a"))
    (tmp_path / "t" / "v9").mkdir()
    assert s.read("t", "a long").count() == 5 and s.version("t") == 5


def test_stream_routes_inserts_once_and_keeps_dead_letters(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [{"type": "security", "security_id": 1}, {"type": "security", "security_id": 1}, {"type": "odd"}, {"type": "new", "exchange_id": 1, "native_id": "n", "body": "b"}]
    (src / "1.json").write_text("\n".join([*map(json.dumps, rows), "{broken"]))
    store = TableStore(spark, str(tmp_path / "state"))
    handlers = {"security": ingest.insert_once(store, "securities", "security_id long", ["security_id"]), "new": ingest.changed_groups(store)}

    def go():
        ingest.run_batches(ingest.parse_messages(ingest.file_stream(spark, str(src))), handlers, str(tmp_path / "dead"), str(tmp_path / "cp")).awaitTermination()

    go()
    (src / "2.json").write_text("\n".join(map(json.dumps, [rows[0], {"type": "security", "security_id": 2}, rows[3]])))
    go()
    assert sorted(r[0] for r in store.changes("securities", "security_id long").collect()) == [1, 2]
    assert [r.batch for r in store.changes("hashes", ingest.HASHES).collect()] == [0]
    assert spark.read.text(str(tmp_path / "dead")).count() == 2


def test_a_replayed_batch_keeps_its_changes_and_the_latest_body_counts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    handle = ingest.changed_groups(store)
    one = spark.createDataFrame([(1, "n1", 1, "z"), (1, "n1", 2, "a"), (1, "n2", 1, "b")], "exchange_id long, native_id string, seq long, body string")
    handle(one, 0)
    first = sorted(map(tuple, store.changes("hashes", ingest.HASHES).collect()))
    handle(one, 0)
    assert len(first) == 2 and sorted(map(tuple, store.changes("hashes", ingest.HASHES).collect())) == first
    handle(one.filter("seq = 2"), 1)  # the latest body again changes nothing
    handle(spark.createDataFrame([(1, "n1", 3, "new")], one.schema), 2)
    assert sorted((r.batch, r.native_id) for r in store.changes("hashes", ingest.HASHES).collect()) == [(0, "n1"), (0, "n2"), (2, "n1")]
    before = sorted(map(tuple, store.state("hashes", ingest.HASHES, ["exchange_id", "native_id"]).collect()))
    store.compact("hashes", ingest.HASHES, ["exchange_id", "native_id"])
    assert sorted(map(tuple, store.state("hashes", ingest.HASHES, ["exchange_id", "native_id"]).collect())) == before


def test_a_handler_that_keeps_failing_leaves_dead_letters(spark, tmp_path):
    src, calls = tmp_path / "in", []
    src.mkdir()
    (src / "1.json").write_text(json.dumps({"type": "bad"}) + "\n" + json.dumps({"type": "good"}))

    def bad(df, number):
        calls.append(number)
        raise RuntimeError

    ingest.run_batches(ingest.parse_messages(ingest.file_stream(spark, str(src))), {"bad": bad, "good": lambda df, n: None}, str(tmp_path / "dead"), str(tmp_path / "cp")).awaitTermination()
    assert calls == [0, 0, 0] and [json.loads(r.value)["type"] for r in spark.read.text(str(tmp_path / "dead")).collect()] == ["bad"]


def test_workers_from_contracts_to_relations_and_resolution(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "state"))
    worker = workers.Worker(store, workers.pipeline.EngineConfig(neighbours=5, least_similarity=0.5))
    msg = "type string, exchange_id long, native_id string, security_id long, event_id long, event_name string, seq long, body string"
    contract = lambda sid, title, label: {"exchange_security_id": sid, "event_title": title, "outcome_label": label, "event_expiry": "2026-05-01", "base_currency": "USDC", "tick_size": 0.01}
    rows = [("new", 1, "n1", None, None, None, 1, json.dumps([contract("a1", "harbour vote", "Yes"), contract("a2", "harbour vote", "No")])), ("new", 2, "n2", None, None, None, 2, json.dumps([contract("b1", "harbour vote today", "No")]))]
    batch = spark.createDataFrame(rows, msg)
    for _ in range(2):  # a replay gives what it gave
        worker.new(batch, 0)
    assert {n: workers.current(store, n).count() for n in ("events", "venue_events", "securities", "listings", "links", "currencies", "specs")} == {"events": 2, "venue_events": 2, "securities": 3, "listings": 3, "links": 3, "currencies": 1, "specs": 3}
    sent = store.changes("messages", workers.TABLES["messages"][0])
    assert sorted(r.event_name for r in sent.collect()) == ["harbour vote", "harbour vote", "harbour vote today"]
    worker.embed_new(sent, 1)
    worker.relate(sent, 2)
    found = workers.current(store, "relations").collect()
    assert {r.relationship_type for r in found} == {"EQUIVALENT"} and len(found) == 2
    reworded = spark.createDataFrame([("new", 2, "n2", None, None, None, 9, json.dumps([contract("b1", "Other words", "No")]))], msg)
    worker.new(reworded, 3)
    assert workers.current(store, "events").count() == 2  # a known native event stays the same event
    worker.resolved(spark.createDataFrame([("resolved", 2, "b1", None, None, None, None, None)], msg), 4)
    worker.stale(spark.createDataFrame([("stale", 1, "n1", None, None, None, None, None)], msg), 5)
    assert workers.current(store, "events").filter("resolved and resolved_at is not null").count() == 2
    assert workers.current(store, "listings").filter("active").count() == 0 and workers.current(store, "embeddings").filter("embedding is not null").count() == 0


def test_ticks_count_absence_once(spark, tmp_path):
    s = TableStore(spark, str(tmp_path))
    keys = lambda *k: spark.createDataFrame([(1, x) for x in k], "exchange_id long, native_id string")
    none = spark.createDataFrame([], "exchange_id long, native_id string")
    assert ingest.tick(s, keys("a", "b"), 1, 2).count() == 0
    assert ingest.tick(s, keys("a"), 2, 2).count() == 0
    assert ingest.tick(s, none, 2, 2).count() == 0  # a replay counts nothing
    assert [r.native_id for r in ingest.tick(s, keys("a"), 3, 2).collect()] == ["b"]


def test_cache_entries_end(spark):
    c = spark.sql("select 1 as k, timestamp'2026-01-01' as at union all select 2, timestamp'2026-02-15'")
    assert [r.k for r in ingest.fresh(c, "at", "2026-03-01", 30).collect()] == [2]


def test_ports(spark):
    t = spark.createDataFrame([(1, "Will it?", ""), (2, "Other", "X")], "key long, title string, category string")
    assert {(r.key, r.title, r.category) for r in identity_canonicalizer(t).collect()} == {(1, "Will it?", "OTHER"), (2, "Other", "X")}
    key = spark.sql("select left(sha2('Will it?', 256), 6) k").first()[0]
    text = "```json\n" + json.dumps([{"key": key, "title": "", "category": "sports", "tags": [str(i) for i in range(12)]}]) + "\n```"
    got = response_canonicalizer(spark.createDataFrame([(text,), ("junk",)], "text string"), ["SPORTS"])(t).collect()
    assert [(r.key, r.title, r.category, len(r.tags)) for r in got] == [(1, "Will it?", "SPORTS", 8)]
    e = hashing_embedder(spark.createDataFrame([(1, "a b"), (2, "a b")], "event_id long, text string")).select(F.size("embedding").alias("n"), "embedding").collect()
    assert e[0].n == 64 and e[0].embedding == e[1].embedding


def test_canonical_forms_come_from_cache_call_and_retry(spark):
    t = spark.createDataFrame([(1, "a", ""), (2, "b", ""), (3, "c", "")], "key long, title string, category string")
    cache = spark.createDataFrame([(1, "cached", "X", ["t"]), (9, "other", "X", [])], "key long, title string, category string, tags array<string>")
    some = lambda df: identity_canonicalizer(df.filter("key < 3"))
    done, new = ports.canonicalize(t, cache, some, identity_canonicalizer)
    assert {(r.key, r.title) for r in done.collect()} == {(1, "cached"), (2, "b"), (3, "c")} and {r.key for r in new.collect()} == {2, 3}
    with pytest.raises(RuntimeError):
        ports.canonicalize(t, cache, some)


def test_judge_prompt_and_cached_pairs(spark):
    p = spark.createDataFrame([("k", "A", None, ["x", "y"], "B", "d", ["z"], 0.98765), ("m", "C", None, ["x"], "D", None, ["z"], 0.9)], "pair_key string, title_a string, description_a string, labels_a array<string>, title_b string, description_b string, labels_b array<string>, sim double")
    text = ports.judge_prompt(p).filter("pair_key = 'k'").first().text
    assert text == "<a> A\nabout \noutcomes 1=x; 2=y\n<b> B\nabout d\noutcomes 1=z\ncosine 0.988"
    hit, left = ports.split_cached(p, spark.createDataFrame([("k", "[]")], "pair_key string, items string"))
    assert [r.pair_key for r in hit.collect()] == ["k"] and [r.pair_key for r in left.collect()] == ["m"]


def test_notification(spark):
    m = spark.createDataFrame([("new_events", i, f"e{i}") for i in range(22)] + [("new_events", 1, "e1"), ("resolved", 5, "e5"), ("security", 7, "x")], "type string, event_id long, event_name string")
    got = {r.type: (r.head, r.body.splitlines()) for r in ports.notification(m).collect()}
    assert got["resolved"] == ("1 event resolved", ["e5"]) and got["new_events"][0] == "22 new events" and got["new_events"][1][-1] == "... and 2 more" and len(got["new_events"][1]) == 21


def test_sports_titles_and_look_back(spark):
    rows = [("", "spreads", "-9.5", None, "E: Spread -9.5"), ("E", "totals", None, None, "E: Total"), ("", "player_points", "20", "Ann", "E: Ann Player_Points 20"), ("", "moneyline", None, None, None), ("own", "spreads", "1", None, None), ("", None, None, None, None)]
    df = spark.createDataFrame([(q, k, ln, g) for q, k, ln, g, _ in rows], "question string, sportsMarketType string, line string, groupItemTitle string")
    m = F.struct(*df.columns)
    assert [r.t for r in df.select(feeds.sports_title(F.lit("E"), m).alias("t")).collect()] == [w for *_, w in rows]
    e = spark.createDataFrame([("2026-01-01T00:00:00Z",), ("2026-02-20",), ("soon",), (None,)], "endDate string")
    assert [r.endDate for r in feeds.closed_since(e, "endDate", "2026-03-01", 30).collect()] == ["2026-02-20"]
