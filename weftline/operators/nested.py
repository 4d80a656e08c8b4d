"""Deeply nested records to flat related tables, by shared inlining of the schema graph.

A schema graph names elements and the edges between them. The analysis inlines every element
that occurs at most once under one parent into that parent's table, and gives a table of its
own to an element that is repeated, shared by several parents or recursive; each element has one table,
with the rows of all its parents. The tables carry the root's key and the position on every level above them as foreign key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import cut


@dataclass(frozen=True)
class Edge:
    """``child`` hangs under ``parent`` at JSON field ``at`` (empty: the value itself). ``bare``: a scalar or list in place of the parent is this child's value."""

    parent: str
    child: str
    at: str
    many: bool = False
    bare: bool = False


@dataclass
class Graph:
    root: str
    edges: list[Edge] = field(default_factory=list)

    def children(self, name: str) -> list[Edge]:
        return [e for e in self.edges if e.parent == name]


def graph_of(schema: T.StructType, root: str) -> Graph:
    """Schema graph of a Spark schema; struct fields are elements, arrays make repeated edges."""
    graph = Graph(root)

    def walk(name: str, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                inner, many = f.dataType, False
                while isinstance(inner, T.ArrayType):
                    inner, many = inner.elementType, True
                graph.edges.append(Edge(name, f"{name}.{f.name}", f.name, many))
                walk(f"{name}.{f.name}", inner)

    walk(root, schema)
    return graph


@dataclass(frozen=True)
class Relation:
    """A table: its element's inlined ``columns`` (name, place), those of them that take a bare value, and the ``edges`` to the tables below."""

    element: str
    columns: tuple[tuple[str, str], ...]
    edges: tuple[Edge, ...]
    bare: frozenset[str] = frozenset()
    recursive: bool = False


def shared_inlining(graph: Graph) -> list[Relation]:
    """Which elements become tables, and what each of them inlines; parents stand before their children, but for those on a cycle.

    Own tables: the root, children of a repeated edge, elements with two or more parents,
    and elements on a cycle. However many parents an element has, it has one table.
    """
    parents: dict[str, set[tuple[str, str]]] = {}
    for e in graph.edges:
        parents.setdefault(e.child, set()).add((e.parent, e.at))
    below: dict[str, set[str]] = {}
    for start in {graph.root, *parents}:
        seen, todo = set(), [start]
        while todo:
            for e in graph.children(todo.pop()):
                if e.child not in seen:
                    seen.add(e.child)
                    todo.append(e.child)
        below[start] = seen
    own = {graph.root} | {e.child for e in graph.edges if e.many or len(parents[e.child]) > 1 or e.child in below[e.child]}
    found: dict[str, Relation] = {}

    def build(name: str) -> None:
        columns: list[tuple[str, str]] = []
        bare: set[str] = set()
        edges: list[Edge] = []

        def inline(at: str, prefix: str) -> None:
            for e in graph.children(at):
                place = f"{prefix}.{e.at}" if prefix and e.at else prefix or e.at
                if e.child in own:
                    edges.append(Edge(name, e.child, place, e.many))
                elif graph.children(e.child):
                    inline(e.child, place)
                else:
                    columns.append((e.child.rsplit(".", 1)[-1], place))
                    if e.bare:
                        bare.add(place)

        inline(name, "")
        found[name] = Relation(name, tuple(columns), tuple(edges), frozenset(bare), name in below[name])
        for e in edges:
            if e.child not in found:
                build(e.child)

    build(graph.root)
    # an element stands behind all that lead to it, elements of one cycle behind each other
    names = sorted(found, key=lambda n: (sum(n in below[m] and m not in below[n] for m in found), list(found).index(n)))
    return [found[n] for n in names]


def get(v: Column, path: str) -> Column:
    """Field of a variant, as variant; null where it is missing."""
    return F.try_variant_get(v, "$" + "".join(f"['{p}']" for p in path.split(".")) if path else "$", "variant")


def text(v: Column) -> Column:
    """Scalar of a variant as text: numbers of any length without loss, JSON null as null."""
    return F.try_variant_get(v, "$", "string")


def as_list(v: Column) -> Column:
    """A variant as an array of variants: a list as it is, JSON text of a list parsed, a single object or scalar as a list of one; null and empty text as null."""
    t = F.trim(text(v))
    parsed = F.try_parse_json(F.when(t.rlike(r"^[\[{]"), t))
    return F.when(v.isNull() | F.is_variant_null(v), F.lit(None)).otherwise(
        F.coalesce(
            F.try_variant_get(v, "$", "array<variant>"),
            F.try_variant_get(parsed, "$", "array<variant>"),
            F.when(parsed.isNotNull(), F.array(parsed)),
            F.when(t != "", F.array(v)),
        )
    )


def occurs(v: Column) -> Column:
    return v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(True))


def flatten(df: DataFrame, keys: Sequence[str], doc: str, graph: Graph, unwrap: Callable[[Column], Column] | None = None) -> dict[str, DataFrame]:
    """One flat DataFrame per table of the inlined graph.

    ``doc`` is a variant column. Each table has ``keys``, one ``<element>_pos`` per level from
    the root (position in its list, from 0; null elements give no row but keep their
    position) and the inlined columns as text; what stands bare in place of an object is the value of the
    column whose edge is marked ``bare``. ``unwrap`` gives the list under the root where envelopes around it differ.
    An element that hangs under several parents, or under itself, has the rows of all of them, with ``parent`` (the
    parent's element) and, where it is recursive, ``node`` and ``parent_node``: the way from where the recursion starts, as text;
    levels that a row's way does not pass are null. A recursive edge is followed until it leads to nothing more, level by
    level. Null or unparsable documents give no rows; other columns of ``df`` are never read.
    """
    relations = {r.element: r for r in shared_inlining(graph)}
    short = {n: n.rsplit(".", 1)[-1] for n in relations}
    into: dict[str, list[Edge]] = {n: [] for n in relations}
    for r in relations.values():
        for e in r.edges:
            into[e.child].append(e)
    several = {n for n, es in into.items() if len(es) > 1 or relations[n].recursive}
    labels = ("parent", "node", "parent_node")
    rows: dict[str, DataFrame | None] = {n: None for n in relations}
    rows[graph.root] = df.select(*keys, F.col(doc).alias("_v")).filter(occurs(F.col("_v")))

    def add(name: str, part: DataFrame) -> None:
        rows[name] = part if rows[name] is None else rows[name].unionByName(part, allowMissingColumns=True)

    def follow(e: Edge, above: DataFrame) -> DataFrame:
        """Rows of the child under the given rows of the parent."""
        pos = f"{short[e.child]}_pos"
        at = [c for c in above.columns if c not in (*keys, *labels, "_v", pos)]
        value = unwrap(F.col("_v")) if unwrap and e.parent == graph.root else as_list(get(F.col("_v"), e.at))
        node = F.col("node") if "node" in above.columns else F.lit(None).cast("string")
        out = above.select(*keys, *at, node.alias("_up"), F.posexplode(value).alias(pos, "_v")).filter(occurs(F.col("_v")))
        own = F.concat(F.lit(f"{short[e.child]}:"), F.col(pos).cast("string"))
        marks = [F.lit(e.parent).alias("parent")] if e.child in several else []
        if relations[e.child].recursive:
            marks += [F.concat_ws("/", "_up", own).alias("node"), F.col("_up").alias("parent_node")]
        return out.select(*keys, *at, pos, *marks, "_v")

    def rounds(group: set[str]) -> None:
        """Elements that reach each other: level by level until no row is left."""
        level = {n: rows[n] for n in group if rows[n] is not None}
        while level:
            below: dict[str, DataFrame] = {}
            for n, above in level.items():
                for e in relations[n].edges:
                    if e.child in group:
                        part = follow(e, above)
                        below[e.child] = part if e.child not in below else below[e.child].unionByName(part, allowMissingColumns=True)
            level = {}
            for n, part in below.items():
                kept, seen = cut(part, rows=F.lit(True))
                if seen["rows"]:
                    level[n] = kept
                    add(n, kept)

    reach: dict[str, set[str]] = {}
    for n in relations:
        seen, todo = set(), [n]
        while todo:
            for e in relations[todo.pop()].edges:
                if e.child not in seen:
                    seen.add(e.child)
                    todo.append(e.child)
        reach[n] = seen
    done: set[str] = set()
    for n in relations:
        if n in done:
            continue
        group = {n} | {m for m in relations if m in reach[n] and n in reach[m]}
        for m in group:
            for e in into[m]:
                if e.parent not in group and rows[e.parent] is not None:
                    add(m, follow(e, rows[e.parent]))
        if relations[n].recursive:
            rounds(group)
        done |= group
    tables: dict[str, DataFrame] = {}
    for n, rel in relations.items():
        if rows[n] is None:
            continue
        at = [c for c in rows[n].columns if c != "_v"]
        bare = F.when(F.try_variant_get(F.col("_v"), "$", "map<string,variant>").isNull(), text(F.col("_v")))
        values = {place: text(get(F.col("_v"), place)) for _, place in rel.columns}
        taken = set(at)
        name = lambda c: c if c not in taken else f"{c}_value"
        tables[n] = rows[n].select(*at, *[(F.coalesce(values[place], bare) if place in rel.bare else values[place]).alias(name(c)) for c, place in rel.columns])
    return tables


#: The event feed: events repeat in a page, markets and tags in an event, outcomes and tokens in a market.
FEED = Graph(
    "page",
    [
        Edge("page", "event", "events", many=True),
        *[Edge("event", f"event.{c}", c) for c in ("title", "slug", "description", "endDate")],
        Edge("event", "market", "markets", many=True),
        *[Edge("market", f"market.{c}", c) for c in ("conditionId", "question", "description", "groupItemTitle", "negRisk", "closed", "sportsMarketType", "line", "endDate", "volumeNum", "orderPriceMinTickSize", "orderMinSize")],
        Edge("market", "outcome", "outcomes", many=True),
        Edge("outcome", "outcome.value", ""),
        Edge("market", "token", "clobTokenIds", many=True),
        Edge("token", "token.value", ""),
        Edge("event", "tag", "tags", many=True),
        Edge("tag", "tag.label", "label", bare=True),
        Edge("tag", "tag.slug", "slug"),
    ],
)


def unwrap_page(v: Column) -> Column:
    """A page's list of events: the page may be the list, an object with ``events``, such an object under ``data``, or one event."""
    inner = F.coalesce(get(v, "events"), get(v, "data.events"), get(v, "data"))
    return as_list(F.coalesce(inner, v))


def child_rows(tables: dict[str, DataFrame], keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Rows ``(*keys, event_pos, child, market_pos, child_pos, child_value)``: tables of ``flatten`` over ``FEED`` in one tall form.

    ``values`` names the column of each child table that gives ``child_value``; null values give no row.
    A child that hangs under no market has ``market_pos`` -1.
    """
    found = None
    for child, value in values.items():
        t = tables[child]
        parent = F.col("market_pos") if child != "market" and "market_pos" in t.columns else F.lit(-1)
        rows = t.select(*keys, "event_pos", F.lit(child).alias("child"), parent.alias("market_pos"), F.col(f"{child}_pos").alias("child_pos"), F.col(value).alias("child_value"))
        found = rows if found is None else found.unionByName(rows)
    return found.filter(F.col("child_value").isNotNull())


def feed_children(pages: DataFrame, key: str, body: str) -> DataFrame:
    """Rows ``(key, event_pos, child, market_pos, child_pos, child_value)`` of every market, tag, outcome and token.

    A plain traversal with fixed paths that the tests hold ``child_rows`` against; no query uses it. A body that is
    null or not valid JSON gives none; a null element or label gives no row but keeps its position.
    """
    page = pages.select(key, F.try_parse_json(F.col(body)).alias("_v")).filter(occurs(F.col("_v")))
    event = page.select(key, F.posexplode(unwrap_page(F.col("_v"))).alias("event_pos", "_e")).filter(occurs(F.col("_e")))
    none = F.array().cast("array<struct<child:string,market_pos:int,child_pos:int,child_value:string>>")

    def rows(values: Column, child: str, market_pos: Column, value) -> Column:
        return F.coalesce(
            F.transform(
                values,
                lambda x, i: F.struct(F.lit(child).alias("child"), market_pos.cast("int").alias("market_pos"), i.cast("int").alias("child_pos"), value(x).alias("child_value")),
            ),
            none,
        )

    label = lambda x: F.coalesce(F.try_variant_get(x, "$.label", "string"), F.when(~text(x).rlike(r"^\s*\{"), text(x)))
    event = event.select(key, "event_pos", as_list(get(F.col("_e"), "markets")).alias("_m"), as_list(get(F.col("_e"), "tags")).alias("_t"))
    of_markets = F.flatten(
        F.transform(
            F.coalesce(F.col("_m"), F.array().cast("array<variant>")),
            lambda m, i: F.concat(
                rows(as_list(get(m, "outcomes")), "outcome", i, text),
                rows(as_list(get(m, "clobTokenIds")), "token", i, text),
            ),
        )
    )
    all_rows = F.concat(
        rows(F.col("_m"), "market", F.lit(-1), lambda m: text(get(m, "conditionId"))),
        rows(F.col("_t"), "tag", F.lit(-1), label),
        of_markets,
    )
    return event.select(key, "event_pos", F.inline(all_rows)).filter(F.col("child_value").isNotNull())
