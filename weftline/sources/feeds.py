"""The venues' nested feeds as flat contract rows, and as resolved ids. Landed JSON in, one schema out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.scalars import key_values, or_default, parse_utc, slug, title_case
from weftline.operators.lookups import EVENT_CONTRACT

MARKET_A = "conditionId string, question string, description string, groupItemTitle string, negRisk boolean, closed boolean, sportsMarketType string, line string, outcomes string, clobTokenIds string, endDate string, volumeNum double, orderPriceMinTickSize double, orderMinSize double"
EVENT_A = f"title string, slug string, endDate string, description string, tags array<struct<label:string,slug:string>>, markets array<struct<{', '.join(f'{a.split()[0]}:{a.split()[1]}' for a in MARKET_A.split(', '))}>>"
EVENT_B = "event_ticker string, series_ticker string, title string, sub_title string, category string, mutually_exclusive boolean, markets array<struct<ticker:string,status:string,yes_sub_title:string,rules_primary:string,rules_secondary:string,close_time:string,expiration_time:string,volume_fp:string>>"
PAGE_C = "outcomes array<struct<outcome:bigint,name:string,description:string,sideSpecs:array<struct<name:string>>>>, questions array<struct<name:string,description:string,namedOutcomes:array<bigint>,fallbackOutcome:bigint,settledNamedOutcomes:array<bigint>>>"

CONTRACT = [
    "exchange_id", "exchange_security_id", "exchange_security_symbol", "base_currency", "quote_currency", "settle_currency", "security_type", "contract_type", "asset_class", "inverse", "is_quanto",
    "tick_size", "lot_size", "min_notional", "contract_multiplier", "event_title", "outcome_label", "exchange_event_native_id", "event_description", "event_category", "event_expiry", "exchange_event_native_url", "event_volume",
]
# Codes of contracts with two outcomes and with several, and of the asset class of events.
BINARY, SEVERAL, PREDICTION = 2, 3, 4


@dataclass(frozen=True)
class Terms:
    """What a venue's contracts have in common; ticks and least sizes of a market come before it."""

    currency: str = "USDC"
    tick: float | None = None
    lot: float = 1.0
    multiplier: float = 1.0
    url: str | None = None


def landed(spark: SparkSession, path: str, venue: str) -> DataFrame:
    """Landed pages of a venue, read with a fixed schema; a broken page fails the read, so that a cut-off fetch is never taken for a complete one."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if venue == "c":
        return reader.schema(PAGE_C).json(path)
    return reader.schema(f"events array<struct<{_as_struct(EVENT_A if venue == 'a' else EVENT_B)}>>").json(path).select(F.inline("events"))


def _as_struct(ddl: str) -> str:
    out, depth = [], 0
    word = True
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if depth == 0 and c == "," or depth == 0 and c == " ":
            if c == ",":
                out.append(",")
                word = True
            elif word and out and out[-1] != ",":
                out.append(":")
                word = False
            continue
        out.append(c)
    return "".join(out)


def exchange_id(exchanges: DataFrame, name: str) -> int:
    """The id of a venue by name, whatever its case; an unknown name is an error."""
    rows = exchanges.filter(F.lower("exchange_name") == name.lower()).select("exchange_id").limit(2).collect()
    if not rows:
        raise ValueError(f"unknown exchange: {name}")
    return rows[0][0]


def _row(exchange: int, terms: Terms, kind: Column | int, **cols: Column) -> list[Column]:
    """The flat contract record; what ``cols`` leaves out is null or follows from the terms."""
    money = {c: F.lit(terms.currency) for c in ("base_currency", "quote_currency", "settle_currency")}
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    codes = {"security_type": F.lit(EVENT_CONTRACT), "contract_type": kind, "asset_class": F.lit(PREDICTION), "inverse": F.lit(False), "is_quanto": F.lit(False)}
    sizes = {"tick_size": F.coalesce(cols.pop("tick_size", F.lit(None)), F.lit(terms.tick)).cast("double"), "lot_size": F.lit(terms.lot), "min_notional": F.coalesce(cols.pop("min_notional", F.lit(None)), F.lit(0.0)).cast("double"), "contract_multiplier": F.lit(terms.multiplier)}
    every = {"exchange_id": F.lit(exchange).cast("long"), **money, **codes, **sizes, **cols}
    texts = ("event_description", "event_category", "event_expiry", "exchange_event_native_url")
    every = {c: F.lit(None).cast("string") for c in texts} | {"event_volume": F.lit(None).cast("double")} | every
    return [every[c].alias(c) for c in CONTRACT]


def _symbol(title: Column, label: Column, most: int | None = 100) -> Column:
    text = F.concat(F.left(F.coalesce(title, F.lit("")), F.lit(60)), F.lit(" -- "), F.coalesce(label, F.lit("")))
    return text if most is None else F.left(text, F.lit(most))


def _set(*columns: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _texts(c: Column) -> Column:
    """A list of texts that is written as JSON text; null where it is none."""
    return F.from_json(c, "array<string>", {"allowSingleQuotes": "false"})


def sports_title(title: Column, m: Column) -> Column:
    """Title of a sports market that its question does not tell apart from its event; null where the question does, or for moneylines."""
    kind = F.coalesce(m["sportsMarketType"], F.lit(""))
    own = F.coalesce(m["question"], F.lit(""))
    player, stat = F.nullif(m["groupItemTitle"], F.lit("")), title_case(kind)
    what = F.when(kind == "spreads", F.concat_ws(" ", F.lit("Spread"), m["line"])).when(kind == "totals", F.concat_ws(" ", F.lit("Total"), m["line"])).otherwise(F.concat_ws(" ", player, stat, m["line"]))
    return F.when(((own == "") | (own == title)) & ~kind.isin("", "moneyline"), F.concat(title, F.lit(": "), what))


def closed_since(events: DataFrame, end: str, as_of: str, days: int) -> DataFrame:
    """Events that ended at most ``days`` before ``as_of``; unreadable ends are no ends."""
    return events.filter(parse_utc(F.col(end)) >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def venue_a(events: DataFrame, exchange: int = 1, terms: Terms = Terms(url="https://venue-a.example/event/")) -> DataFrame:
    """One row per outcome, or, where all open markets of an event exclude each other, one row per market.

    Closed markets are dropped first and decide nothing. A market's own description and expiry come before the event's.
    Markets without condition id or with unreadable lists give no rows; lists of unequal length pair up as far as both go.
    """
    open_ = F.filter("markets", lambda m: m.isNotNull() & ~F.coalesce(m["closed"], F.lit(False)))
    e = events.select("title", "slug", "endDate", "description", F.get("tags", F.lit(0))["label"].alias("category"), open_.alias("ms"))
    e = e.filter(F.size("ms") > 0).select("*", F.forall("ms", lambda m: F.coalesce(m["negRisk"], F.lit(False))).alias("one_of"), F.aggregate("ms", F.lit(0.0), lambda s, m: s + F.coalesce(m["volumeNum"], F.lit(0.0))).alias("sum_volume"))
    m = e.select("*", F.explode("ms").alias("m")).filter(F.coalesce(F.col("m.conditionId"), F.lit("")) != "")
    m = m.select("*", _texts(F.col("m.outcomes")).alias("os"), _texts(F.col("m.clobTokenIds")).alias("ts")).filter("ts is not null")
    group = m.filter("one_of").filter(F.size("ts") > 0)
    first = F.concat_ws(":", "m.conditionId", F.get("ts", F.lit(0)))
    url = F.concat(F.lit(terms.url), _set("slug"))
    sizes = {"tick_size": F.col("m.orderPriceMinTickSize"), "min_notional": F.col("m.orderMinSize")}
    label = F.coalesce(_set("m.groupItemTitle"), "m.question")
    multi = group.select(*_row(exchange, terms, SEVERAL, **sizes, exchange_security_id=first, exchange_security_symbol=_symbol(F.col("title"), label), event_title=F.col("title"), outcome_label=label, exchange_event_native_id=F.col("slug"), event_description=_set("description"), event_category=F.col("category"), event_expiry=_set("m.endDate", "endDate"), exchange_event_native_url=url, event_volume=F.col("sum_volume")))
    pairs = F.slice(F.arrays_zip(F.col("os").alias("o"), F.col("ts").alias("t")), F.lit(1), F.least(F.size("os"), F.size("ts")))
    single = m.filter("not one_of and os is not null").select("*", F.explode(pairs).alias("p"))
    kind = F.when(F.size("os") == 2, BINARY).otherwise(SEVERAL)
    title = F.coalesce(sports_title(F.col("title"), F.col("m")), _set("m.question"), "title")
    binary = single.select(*_row(exchange, terms, kind, **sizes, exchange_security_id=F.concat_ws(":", "m.conditionId", "p.t"), exchange_security_symbol=_symbol(F.col("m.question"), F.col("p.o"), None), event_title=title, outcome_label=F.col("p.o"), exchange_event_native_id=F.col("m.conditionId"), event_description=_set("m.description", "description"), event_category=F.col("category"), event_expiry=_set("m.endDate", "endDate"), exchange_event_native_url=url, event_volume=F.coalesce("m.volumeNum", F.lit(0.0))))
    return multi.unionByName(binary)


def venue_b(events: DataFrame, exchange: int = 2, terms: Terms = Terms(url="https://venue-b.example/event/")) -> DataFrame:
    """Exclusive events with several markets: a row per market; others: Yes and No rows. The shape is decided before inactive markets go.

    Several markets that do not exclude each other are events of their own, with the market's subtitle or ticker in the title; a single market's
    subtitle goes into the title where it is not in it yet. An event without ticker, and a market without one, give no rows.
    """
    n = F.size("markets")
    e = events.filter((n > 0) & (or_default(F.col("event_ticker"), "") != "")).select("*", (F.coalesce("mutually_exclusive", F.lit(False)) & (n > 1)).alias("multi"), n.alias("n"))
    volume = F.aggregate(F.filter(F.transform("markets", lambda x: x["volume_fp"].try_cast("double")), lambda v: v.isNotNull()), F.lit(None).cast("double"), lambda s, v: F.coalesce(s, F.lit(0.0)) + v)
    at = F.get("markets", F.lit(0))
    about = _set("sub_title")
    page = F.trim(F.concat_ws(" ", "title", _set("sub_title")))
    url = F.when(or_default(F.col("series_ticker"), "") != "", F.concat(F.lit(terms.url), F.lower("series_ticker"), F.lit("/"), slug(page)))
    e = e.select("*", volume.alias("volume"), F.when(F.col("multi"), F.coalesce(_set(at["rules_secondary"], at["rules_primary"]), about)).otherwise(about).alias("about"), url.alias("url"))
    m = e.select("*", F.explode("markets").alias("m")).filter((F.coalesce(F.col("m.status"), F.lit("active")) == "active") & (or_default(F.col("m.ticker"), "") != ""))
    expiry, category = _set("m.close_time", "m.expiration_time"), _set("category")
    label = F.coalesce(_set("m.yes_sub_title"), "m.ticker")
    common = {"event_category": category, "event_expiry": expiry, "exchange_event_native_url": F.col("url")}
    multi = m.filter("multi").select(*_row(exchange, terms, SEVERAL, **common, exchange_security_id=F.col("m.ticker"), exchange_security_symbol=_symbol(F.col("title"), label), event_title=F.col("title"), outcome_label=label, exchange_event_native_id=F.col("event_ticker"), event_description=F.col("about"), event_volume=F.col("volume")))
    own = or_default(F.col("m.yes_sub_title"), "")
    joined = F.when((own != "") & ~F.contains(F.lower("title"), F.lower(own)), F.concat("title", F.lit(": "), own)).otherwise(F.col("title"))
    many = F.col("n") > 1
    sides = m.filter("not multi").select("*", F.when(many, F.concat("title", F.lit(": "), label)).otherwise(joined).alias("titled"), F.explode(F.array(F.lit("Yes"), F.lit("No"))).alias("side"))
    native = F.when(many, F.col("m.ticker")).otherwise(F.col("event_ticker"))
    own_volume = F.when(many, F.col("m.volume_fp").try_cast("double")).otherwise(F.col("volume"))
    binary = sides.select(*_row(exchange, terms, BINARY, **common, exchange_security_id=F.concat_ws(":", "m.ticker", F.lower("side")), exchange_security_symbol=_symbol(F.col("titled"), F.col("side")), event_title=F.col("titled"), outcome_label=F.col("side"), exchange_event_native_id=native, event_description=F.coalesce(_set("m.rules_primary"), "about"), event_volume=own_volume))
    return multi.unionByName(binary)


def described(text: Column) -> dict[str, Column]:
    """Category, expiry and words of a description that may be written as ``key:value|key:value``; words only where it is not."""
    of = key_values(text)
    at = F.regexp_extract(F.try_element_at(of, F.lit("expiry")), r"^(\d{8}-\d{4})", 1)
    part = lambda i, n: F.substring(at, i, n)
    expiry = F.when(at != "", F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit("T"), part(10, 2), F.lit(":"), part(12, 2), F.lit(":00Z")))
    return {"event_category": _set(F.try_element_at(of, F.lit("category"))), "event_expiry": expiry, "event_description": F.when((text != "") & ~text.rlike(r"^(?:metadata=|class:)"), text)}


def venue_c(pages: DataFrame, exchange: int = 3, terms: Terms = Terms(lot=0.1)) -> DataFrame:
    """Questions with several live outcomes: a row per outcome under ``q:<first>``; with one, or outcomes of no question: a row per side, two at most, under ``o:<id>``.

    Category and expiry come from the description. Outcomes that name no sides give no rows; sides without name are Yes and No by place.
    """
    o = pages.select(F.inline("outcomes")).select(F.col("outcome").alias("oid"), F.col("name").alias("oname"), F.col("description").alias("odesc"), "sideSpecs")
    q = pages.select(F.inline("questions")).withColumn("live", F.array_except(F.array_except(F.coalesce("namedOutcomes", F.array().cast("array<bigint>")), F.array("fallbackOutcome")), F.coalesce("settledNamedOutcomes", F.array().cast("array<bigint>"))))
    at = q.select("name", "description", "live", F.explode("live").alias("oid")).join(o, "oid")
    several = at.filter(F.size("live") > 1)
    multi = several.select(*_row(exchange, terms, SEVERAL, **described(F.col("description")), exchange_security_id=F.concat(F.lit("@"), F.col("oid")), exchange_security_symbol=_symbol(F.col("name"), F.col("oname")), event_title=F.col("name"), outcome_label=F.col("oname"), exchange_event_native_id=F.concat(F.lit("q:"), F.get("live", F.lit(0)))))
    alone = at.filter(F.size("live") == 1).select("oid", F.col("name").alias("title"), "description", "sideSpecs")
    taken = q.select(F.explode(F.array_append(F.coalesce("namedOutcomes", F.array().cast("array<bigint>")), F.col("fallbackOutcome"))).alias("oid")).filter("oid is not null").distinct()
    orphans = o.join(taken, "oid", "left_anti").select("oid", F.col("oname").alias("title"), F.col("odesc").alias("description"), "sideSpecs")
    two = alone.unionByName(orphans).select("*", F.posexplode(F.slice("sideSpecs", F.lit(1), F.lit(2))).alias("i", "s"))
    side = F.coalesce("s.name", F.when(F.col("i") == 0, "Yes").otherwise("No"))
    binary = two.select(*_row(exchange, terms, BINARY, **described(F.col("description")), exchange_security_id=F.concat(F.lit("@"), F.col("oid"), F.lit(":"), F.col("i")), exchange_security_symbol=_symbol(F.col("title"), side), event_title=F.col("title"), outcome_label=side, exchange_event_native_id=F.concat(F.lit("o:"), F.col("oid"))))
    return multi.unionByName(binary)


def resolved_a(events: DataFrame) -> DataFrame:
    """Security ids of closed markets."""
    m = events.select(F.explode("markets").alias("m")).filter("m.closed and coalesce(m.conditionId, '') <> ''")
    return m.select(F.explode(_texts(F.col("m.clobTokenIds"))).alias("t"), "m.conditionId").select(F.concat_ws(":", "conditionId", "t").alias("native_id")).distinct()


def resolved_b(events: DataFrame) -> DataFrame:
    """Tickers of exclusive events' inactive markets; both sides of others'."""
    e = events.select((F.coalesce("mutually_exclusive", F.lit(False)) & (F.size("markets") > 1)).alias("multi"), F.explode("markets").alias("m")).filter("coalesce(m.status, 'active') <> 'active'")
    ids = F.when(F.col("multi"), F.array("m.ticker")).otherwise(F.array(F.concat("m.ticker", F.lit(":yes")), F.concat("m.ticker", F.lit(":no"))))
    return e.select(F.explode(ids).alias("native_id")).distinct()


def resolved_c(pages: DataFrame) -> DataFrame:
    """All three forms in which a settled outcome's id may have been listed."""
    done = pages.select(F.inline("questions")).select(F.explode("settledNamedOutcomes").alias("o"))
    at = F.concat(F.lit("@"), F.col("o"))
    return done.select(F.explode(F.array(at, F.concat(at, F.lit(":0")), F.concat(at, F.lit(":1")))).alias("native_id")).distinct()


#: Venue adapters by name; a further venue is one more entry.
ADAPTERS = {"venue_a": venue_a, "venue_b": venue_b, "venue_c": venue_c}
RESOLVED = {"venue_a": resolved_a, "venue_b": resolved_b, "venue_c": resolved_c}


@dataclass
class Fetched:
    """Rows of all venues that could be read, and the names of those that could not."""

    rows: DataFrame
    failed: dict[str, str]


def _fetch(feeds: dict[str, DataFrame], exchanges: DataFrame, adapters: dict[str, Callable[[DataFrame, int], DataFrame]]) -> Fetched:
    out, failed = None, {}
    for name, df in feeds.items():
        try:
            number = exchange_id(exchanges, name)
        except ValueError:
            continue
        try:
            rows = adapters[name](df, number)
        except Exception as e:  # noqa: BLE001
            failed[name] = str(e)
            continue
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"no venue could be read: {failed}")
    return Fetched(out, failed)


def fetch_all(feeds: dict[str, DataFrame], exchanges: DataFrame, most: int | None = None) -> Fetched:
    """All registered venues' contracts in one DataFrame; a venue without id is left out, one whose adapter fails is reported; ``most`` caps each venue, in order of id."""

    def capped(adapter: Callable[[DataFrame, int], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
        return adapter if most is None else lambda df, number: adapter(df, number).orderBy("exchange_security_id").limit(most)

    return _fetch(feeds, exchanges, {name: capped(a) for name, a in ADAPTERS.items()})


def fetch_resolved(feeds: dict[str, DataFrame], exchanges: DataFrame) -> Fetched:
    """Distinct (exchange_id, native_id) of what the venues report as resolved; failed ones are reported, so that nothing is taken as missing there."""
    with_id = lambda f: lambda df, number: f(df).select(F.lit(number).cast("long").alias("exchange_id"), "native_id").distinct()
    return _fetch(feeds, exchanges, {name: with_id(f) for name, f in RESOLVED.items()})


def open_or_closed(events: DataFrame, end: str, as_of: str, days: int) -> DataFrame:
    """A scan for resolutions: events with an open market, and those closed within the look-back; others ended too long ago."""
    open_ = F.exists("markets", lambda m: ~F.coalesce(m["closed"], F.lit(False)))
    return events.filter(F.coalesce(open_, F.lit(False)) | F.coalesce(parse_utc(F.col(end)) >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)), F.lit(False)))
