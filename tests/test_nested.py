import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.nested import FEED, Edge, Graph, feed_children, flatten, graph_of, shared_inlining, unwrap_page
from weftline.plans import training


def children(spark, bodies):
    df = spark.createDataFrame([(i, b, 1, "c") for i, b in enumerate(bodies)], "page_id long, body string, event_pos int, child string")
    return sorted(map(tuple, feed_children(df, "page_id", "body").collect()))


EVENT = {"title": "t", "tags": [{"label": "A"}, None, "B", {"label": None}], "markets": [None, {"conditionId": "0x1", "outcomes": '["Yes", "No"]', "clobTokenIds": [17583606980910438250, 2]}]}
WANT = [
    (0, 0, "market", -1, 1, "0x1"), (0, 0, "outcome", 1, 0, "Yes"), (0, 0, "outcome", 1, 1, "No"), (0, 0, "tag", -1, 0, "A"),
    (0, 0, "tag", -1, 2, "B"), (0, 0, "token", 1, 0, "17583606980910438250"), (0, 0, "token", 1, 1, "2"),
]


def test_envelopes(spark):
    for wrap in (lambda e: [e], lambda e: {"events": [e]}, lambda e: {"data": {"events": e}, "meta": {}}, lambda e: e, lambda e: {"events": json.dumps([e])}):
        assert children(spark, [json.dumps(wrap(EVENT))]) == WANT


def test_object_text_and_scalar_in_place_of_a_list(spark):
    e = {"markets": json.dumps({"conditionId": "c", "outcomes": "Win", "clobTokenIds": 5}), "tags": {"label": "T"}}
    assert children(spark, [json.dumps(e)]) == [(0, 0, "market", -1, 0, "c"), (0, 0, "outcome", 0, 0, "Win"), (0, 0, "tag", -1, 0, "T"), (0, 0, "token", 0, 0, "5")]


def test_broken_null_and_empty_bodies_give_nothing(spark):
    assert children(spark, [None, "", "{", "[]", "null", '{"events": null}', '{"events": [null]}', json.dumps({"events": [EVENT]})[:-3]]) == []
    assert children(spark, []) == []


def test_tables_keep_parents(spark):
    df = spark.createDataFrame([(7, json.dumps({"events": [EVENT, EVENT]}))], "page_id long, body string").select("page_id", F.try_parse_json("body").alias("d"))
    t = flatten(df, ["page_id"], "d", FEED, unwrap_page)
    assert set(t) == {"page", "event", "market", "outcome", "token", "tag"}
    assert [tuple(r)[:4] for r in t["market"].orderBy("event_pos").collect()] == [(7, 0, 1, "0x1"), (7, 1, 1, "0x1")]
    assert t["outcome"].columns == ["page_id", "event_pos", "market_pos", "outcome_pos", "value"] and t["outcome"].count() == 4
    assert [r.label for r in t["tag"].filter("event_pos = 0").orderBy("tag_pos").collect()] == ["A", "B", None]


SHARED = Graph("r", [Edge("r", "a", "a"), Edge("r", "b", "b", many=True), Edge("r", "c", "c", many=True), Edge("a", "a.x", "x"), Edge("b", "b.id", "id"), Edge("b", "s", "s"), Edge("c", "s", "s", many=True), Edge("s", "s.y", "y"), Edge("s", "s", "kids", many=True)])


def test_shared_and_recursive_elements_get_one_table():
    rels = {r.element: r for r in shared_inlining(SHARED)}
    assert set(rels) == {"r", "b", "c", "s"} and dict(rels["r"].columns) == {"x": "a.x"}
    assert [(e.parent, e.at) for r in rels.values() for e in r.edges if e.child == "s"] == [("b", "s"), ("c", "s"), ("s", "kids")] and rels["s"].recursive


def test_shared_and_recursive_elements_keep_all_rows_and_parents(spark):
    deep = {"y": "b1", "kids": [{"y": "k0"}, None, {"y": "k2", "kids": [{"y": "g0"}]}]}
    doc = {"a": {"x": "X"}, "b": [{"id": 1, "s": deep}, {"id": 2}], "c": [{"s": [{"y": "c0"}, {"y": "c1"}]}]}
    df = spark.createDataFrame([(7, json.dumps(doc)), (8, "{}"), (9, None)], "id long, body string").select("id", F.try_parse_json("body").alias("d"))
    t = flatten(df, ["id"], "d", SHARED)
    assert [tuple(r) for r in t["r"].orderBy("id").collect()] == [(7, "X"), (8, None)]
    got = sorted((r.y, r.parent, r.b_pos, r.c_pos, r.s_pos, r.node, r.parent_node) for r in t["s"].collect())
    assert got == [
        ("b1", "b", 0, None, 0, "s:0", None), ("c0", "c", None, 0, 0, "s:0", None), ("c1", "c", None, 0, 1, "s:1", None),
        ("g0", "s", 0, None, 0, "s:0/s:2/s:0", "s:0/s:2"), ("k0", "s", 0, None, 0, "s:0/s:0", "s:0"), ("k2", "s", 0, None, 2, "s:0/s:2", "s:0"),
    ]


def test_cycles_of_several_elements(spark):
    g = Graph("r", [Edge("r", "p", "p"), Edge("p", "p.n", "n"), Edge("p", "q", "q", many=True), Edge("q", "q.m", "m"), Edge("q", "p", "p")])
    doc = {"p": {"n": 1, "q": [{"m": 2, "p": {"n": 3, "q": [{"m": 4}, {"m": 5}]}}]}}
    t = flatten(spark.createDataFrame([(json.dumps(doc), 1)], "body string, id int").select("id", F.try_parse_json("body").alias("d")), ["id"], "d", g)
    assert sorted((r.n, r.node, r.parent_node) for r in t["p"].collect()) == [("1", "p:0", None), ("3", "p:0/q:0/p:0", "p:0/q:0")]
    assert sorted((r.m, r.parent_node) for r in t["q"].collect()) == [("2", "p:0"), ("4", "p:0/q:0/p:0"), ("5", "p:0/q:0/p:0")]


def test_graph_of_a_schema():
    s = T.StructType().add("id", "long").add("o", T.StructType().add("p", "string")).add("l", T.ArrayType(T.StructType().add("q", "integer")))
    tables = [(r.element, dict(r.columns)) for r in shared_inlining(graph_of(s, "d"))]
    assert tables == [("d", {"id": "id", "p": "o.p"}), ("d.l", {"q": "q"})]


def page_rows(spark, folder, bodies):
    spark.createDataFrame(list(enumerate(bodies)), "page_id long, body string").write.mode("overwrite").parquet(f"{folder}/polymarket_pages.parquet")
    return sorted(map(tuple, training.p6_found(spark, folder).collect()))


def test_query_takes_its_rows_from_the_inlined_tables(spark, tmp_path, monkeypatch):
    bodies = [json.dumps(x) for x in ([EVENT], {"data": {"events": [None, EVENT]}}, EVENT, {"events": json.dumps([EVENT])}, {"events": [{"markets": ["bare", 5], "tags": [7, ["x"]]}]})]
    bodies += [None, "{", "[]", "null"]
    assert page_rows(spark, tmp_path, bodies) == children(spark, bodies)
    slugs = Graph("page", [Edge("tag", "tag.label", "slug") if e.child == "tag.label" else e for e in FEED.edges if e.child != "tag.slug"])
    monkeypatch.setattr(training, "FEED", slugs)
    event = {"tags": [{"label": "A", "slug": "a"}, "B"]}
    assert page_rows(spark, tmp_path, [json.dumps(event)]) == [(0, 0, "tag", -1, 0, "a")]


def test_bare_labels_may_look_like_json(spark, tmp_path):
    assert page_rows(spark, tmp_path, [json.dumps({"tags": ["{odd", "[odd", {"slug": "s"}]})]) == [(0, 0, "tag", -1, 0, "{odd"), (0, 0, "tag", -1, 1, "[odd")]
