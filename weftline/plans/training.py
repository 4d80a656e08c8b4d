"""The general training-data problems as queries over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import timestamps
from weftline.operators.nested import FEED, child_rows, flatten, unwrap_page
from weftline.operators.packed import split_packed
from weftline.operators.snapshots import snapshot_changes
from weftline.operators.timestamps import normalise_instants
from weftline.session import once, small, table


def _expiries(spark: SparkSession, folder: str) -> DataFrame:
    """Every expiry text of the contracts and of the feed's events and markets with its venue's zone and order of dates."""
    contracts = table(spark, folder, "adapter_contract").select(
        F.lit("adapter_contract").alias("source"), "exchange_id", F.col("ingest_pos").alias("row_id"), F.lit(-1).alias("market_pos"), F.col("event_expiry").alias("text")
    )
    texts = F.concat(
        F.array(F.struct(F.lit(-1).alias("market_pos"), F.col("endDate").alias("text"))),
        F.coalesce(F.transform("markets", lambda m, i: F.struct(i.alias("market_pos"), m["endDate"].alias("text"))), F.array().cast("array<struct<market_pos:int,text:string>>")),
    )
    feed = table(spark, folder, "polymarket_events").select(F.lit("polymarket_events").alias("source"), F.lit(1).cast("long").alias("exchange_id"), F.col("feed_pos").alias("row_id"), F.inline(texts))
    venues = table(spark, folder, "sm_exchange").select("exchange_id", "home_zone", "date_order")
    return contracts.unionByName(feed).filter("text is not null").join(small(venues), "exchange_id", "left")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every expiry text of the contracts and of the feed's events and markets as one instant."""
    found = normalise_instants(_expiries(spark, folder), "text", ["source", "exchange_id"], ["row_id", "market_pos"], "date_order", "home_zone")
    return found.select("source", "row_id", "market_pos", "epoch_us")


def p2_undeclared(spark: SparkSession, folder: str) -> DataFrame:
    """The same where no venue declares its order of day and month: the pass over each source's records decides."""
    rows = _expiries(spark, folder).withColumn("date_order", F.lit(None).cast("string"))
    found = normalise_instants(rows, "text", ["source", "exchange_id"], ["row_id", "market_pos"], "date_order", "home_zone")
    return found.select("source", "row_id", "market_pos", "epoch_us")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts added, removed or changed in title or label, each snapshot against the one before."""
    snapshots = table(spark, folder, "contract_snapshot")
    return snapshot_changes(snapshots, "snapshot_no", ["exchange_id", "exchange_security_id"], ["event_title", "outcome_label"], ["received_at", "ingest_pos"])


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Markets, tags, outcomes and tokens of the raw pages with their parents' positions."""
    pages = once(table(spark, folder, "polymarket_pages").select("page_id", "body"), doc=F.try_parse_json("body"))
    tables = flatten(pages, ["page_id"], "doc", FEED, unwrap_page)
    return child_rows(tables, ["page_id"], {"market": "conditionId", "tag": "label", "outcome": "value", "token": "value"})


def p6_market_table(spark: SparkSession, folder: str) -> DataFrame:
    """The inlined market table of the raw pages."""
    pages = table(spark, folder, "polymarket_pages").select("page_id", F.try_parse_json("body").alias("doc"))
    return flatten(pages, ["page_id"], "doc", FEED, unwrap_page)["market"]


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """The packed outcomes and token ids of the feed's markets, one row per value."""
    markets = table(spark, folder, "polymarket_events").select("feed_pos", F.posexplode("markets").alias("market_pos", "m"))
    packed = markets.select("feed_pos", "market_pos", F.lit("venue_a").alias("source"), "m.outcomes", "m.clobTokenIds")
    return split_packed(packed, ["feed_pos", "market_pos"], "source", ["outcomes", "clobTokenIds"])


def _list_sql(j: str) -> str:
    t = f"({j} ->> '$')"
    inner = f"(CASE WHEN json_valid({t}) THEN json_type({t}) END)"
    return f"""(CASE json_type({j}) WHEN 'ARRAY' THEN {j} WHEN 'OBJECT' THEN json_array({j})
 WHEN 'VARCHAR' THEN CASE WHEN {inner} = 'ARRAY' THEN {t}::JSON WHEN {inner} = 'OBJECT' THEN json_array({t}::JSON) WHEN trim({t}) = '' THEN NULL ELSE json_array({j}) END
 WHEN 'NULL' THEN NULL ELSE json_array({j}) END)"""


def _each_sql(src: str, lst: str, cols: str) -> str:
    return f"SELECT {cols}, i AS pos, json_extract(l, '$[' || i || ']') AS v FROM (SELECT *, unnest(range(coalesce(json_array_length(l), 0)::BIGINT)) AS i FROM (SELECT *, {lst} AS l FROM {src}))"


def _instants_sql() -> str:
    """``p2_found`` in SQL: one reading per text, as what the venues declare decides."""
    groups = ("y", "m", "d", "hh", "mi", "ss", "us", "half", "z")
    parts, shape = {g: [] for g in groups}, []
    for name, (pattern, at) in timestamps.SHAPES.items():
        pattern = pattern.replace(r"(am|pm|a\.m\.|p\.m\.)(?![a-z])", r"(am\b|pm\b|a\.m\.|p\.m\.)")
        when = f"WHEN regexp_matches(s, '{timestamps.GUARDS[name]}') THEN"
        shape.append(f"{when} CASE WHEN regexp_matches(s, '{pattern}') THEN '{name}' END")
        for g, i in zip(groups, at, strict=True):
            parts[g].append(f"{when} " + (f"regexp_extract(s, '{pattern}', {i})" if i else "''"))
    cols = ", ".join(f"CASE {' '.join(v)} END AS {g}" for g, v in parts.items())
    months = "[" + ", ".join(f"'{m}'" for m in timestamps.MONTHS) + "]"
    letters = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in timestamps.ZONE_MINUTES.items()) + "}"
    regions = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in timestamps.ZONE_REGIONS.items()) + "}"

    def local(m: str, d: str) -> str:
        day = f"make_date(CASE WHEN y BETWEEN 1 AND 9999 AND {m} BETWEEN 1 AND 12 THEN y END, {m}, 1)"
        hour = "CASE WHEN half = '' THEN CASE WHEN hh BETWEEN 0 AND 23 OR (hh = 24 AND mi = 0 AND ss = 0) THEN hh END WHEN hh BETWEEN 1 AND 12 THEN hh % 12 + CASE WHEN half = 'p' THEN 12 ELSE 0 END END"
        return f"CASE WHEN y BETWEEN 1 AND 9999 AND {m} BETWEEN 1 AND 12 AND mi BETWEEN 0 AND 59 AND ss BETWEEN 0 AND 59 THEN CASE WHEN {d} BETWEEN 1 AND day(last_day({day})) THEN epoch_us({day}::TIMESTAMP) + ({d} - 1) * 86400000000 + ((({hour}) * 60 + mi) * 60 + ss) * 1000000 + us END END"

    blank = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}\v]+"
    digits = "regexp_replace(z, '[^0-9]', '', 'g')"
    return rf"""
WITH r AS (SELECT 'adapter_contract' AS source, exchange_id, ingest_pos AS row_id, -1 AS market_pos, event_expiry AS t FROM adapter_contract
  UNION ALL SELECT 'polymarket_events', 1, feed_pos, -1, endDate FROM polymarket_events
  UNION ALL SELECT 'polymarket_events', 1, feed_pos, i, markets[i + 1].endDate FROM (SELECT *, unnest(range(len(markets)))::INTEGER AS i FROM polymarket_events)),
s AS (SELECT r.*, home_zone, date_order, regexp_replace(t, '^{blank}|{blank}$', '', 'g') AS s FROM r LEFT JOIN sm_exchange USING (exchange_id) WHERE t IS NOT NULL),
g AS (SELECT source, row_id, market_pos, home_zone, date_order, s, CASE {' '.join(shape)} END AS shape, {cols} FROM s),
n AS (SELECT source, row_id, market_pos, home_zone, date_order, s, shape, try_cast(y AS BIGINT) AS y, coalesce(try_cast(m AS BIGINT), nullif(list_position({months}, lower(left(m, 3))), 0)) AS m, try_cast(d AS BIGINT) AS d,
  coalesce(try_cast(hh AS BIGINT), 0) AS hh, coalesce(try_cast(mi AS BIGINT), 0) AS mi, coalesce(try_cast(ss AS BIGINT), 0) AS ss, coalesce(try_cast(rpad(left(nullif(us, ''), 6), 6, '0') AS BIGINT), 0) AS us, lower(left(half, 1)) AS half,
  upper(regexp_replace(regexp_replace(z, '(\d)\[.*', '\1'), '[\[\]()]', '', 'g')) AS z FROM g),
l AS (SELECT *, CASE WHEN shape IS NOT NULL THEN {local('m', 'd')} END AS a, CASE WHEN shape = 'numeric' THEN {local('d', 'm')} END AS b,
  coalesce({letters}[z], CASE WHEN NOT contains(z, '/') AND regexp_matches(z, '^(?:UTC|GMT)?[-+−]\d') THEN CASE WHEN regexp_matches(z, '^(?:UTC|GMT)?[+]') THEN 1 ELSE -1 END
  * (CASE WHEN length({digits}) <= 2 THEN {digits}::BIGINT * 60 ELSE left({digits}, -2)::BIGINT * 60 + right(z, 2)::BIGINT END) END) AS east FROM n),
w AS (SELECT *, CASE WHEN shape = 'numeric' AND upper(date_order) = 'DMY' THEN coalesce(b, a) ELSE coalesce(a, b) END AS wall,
  CASE WHEN z = '' THEN coalesce(home_zone, 'UTC') WHEN contains(z, '/') THEN p.name ELSE {regions}[z] END AS region FROM l LEFT JOIN (SELECT lower(name) AS low, any_value(name) AS name FROM pg_timezone_names() GROUP BY 1) p ON p.low = lower(z)),
u AS (SELECT *, CASE WHEN east IS NULL AND region IS NOT NULL AND wall IS NOT NULL THEN timezone(region, make_timestamp(wall)) END AS later FROM w),
c AS (SELECT source, row_id, market_pos, CASE WHEN wall IS NOT NULL AND east IS NOT NULL THEN wall - east * 60000000
  WHEN later IS NOT NULL THEN CASE WHEN timezone(region, later - INTERVAL 1 HOUR) = make_timestamp(wall) THEN epoch_us(later) - 3600000000 ELSE epoch_us(later) END END AS instant,
  regexp_extract(s, '^(\d+)(?:\.(\d*))?$', 1) AS number, coalesce(try_cast(rpad(left(nullif(regexp_extract(s, '^(\d+)(?:\.(\d*))?$', 2), ''), 6), 6, '0') AS BIGINT), 0) AS part FROM u),
f AS (SELECT source, row_id, market_pos, coalesce(instant, CASE WHEN length(number) BETWEEN 9 AND 11 THEN try_cast(number AS BIGINT) * 1000000 + part WHEN length(number) BETWEEN 12 AND 14 THEN try_cast(number AS BIGINT) * 1000
  WHEN length(number) BETWEEN 15 AND 17 THEN try_cast(number AS BIGINT) END) AS epoch_us FROM c)
SELECT source, row_id, market_pos, epoch_us FROM f WHERE epoch_us IS NOT NULL"""


QUERIES = {"p2_found": p2_found, "p2_undeclared": p2_undeclared, "p4_found": p4_found, "p6_found": p6_found, "p6_market_table": p6_market_table, "p7_found": p7_found}

_PAGES_SQL = f"""
WITH b AS (SELECT page_id, body::JSON AS j FROM polymarket_pages WHERE json_valid(body)),
w AS (SELECT page_id, coalesce(json_extract(j, '$.events'), json_extract(j, '$.data.events'), json_extract(j, '$.data'), j) AS j FROM b),
e AS (SELECT page_id, pos AS event_pos, v AS e FROM ({_each_sql('w', _list_sql('j'), 'page_id')}) WHERE json_type(v) <> 'NULL'),
m AS (SELECT page_id, event_pos, pos AS market_pos, v AS m FROM ({_each_sql('(SELECT *, json_extract(e, $$$.markets$$) AS q FROM e)', _list_sql('q'), 'page_id, event_pos')}) WHERE json_type(v) <> 'NULL')"""


def _number_sql(c: str) -> str:
    """A field as text, decimals without trailing zeros."""
    return rf"CASE json_type(m, '$.{c}') WHEN 'DOUBLE' THEN regexp_replace(regexp_replace(m ->> '$.{c}', '(\.\d*?)0+$', '\1'), '\.$', '') ELSE m ->> '$.{c}' END AS {c}"


_MARKET_COLUMNS = [e.at for e in FEED.edges if e.parent == "market" and not e.many]

ORACLES = {
    "p2_found": _instants_sql(),
    # what the pass finds alone is held against what the declarations say
    "p2_undeclared": _instants_sql(),
    "p6_market_table": f"{_PAGES_SQL} SELECT page_id, event_pos::INTEGER AS event_pos, market_pos::INTEGER AS market_pos, " + ", ".join(map(_number_sql, _MARKET_COLUMNS)) + " FROM m",
    "p4_found": r"""
WITH c AS (
  SELECT snapshot_no, exchange_id, exchange_security_id,
         nfc_normalize(trim(regexp_replace(event_title, '[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS t,
         nfc_normalize(trim(regexp_replace(outcome_label, '[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS l
  FROM contract_snapshot
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, exchange_id, exchange_security_id
                             ORDER BY received_at DESC NULLS LAST, ingest_pos DESC) = 1),
n AS (SELECT snapshot_no, lead(snapshot_no) OVER (ORDER BY snapshot_no) AS nxt FROM (SELECT DISTINCT snapshot_no FROM contract_snapshot)),
p AS (SELECT n.nxt AS snapshot_no, exchange_id, exchange_security_id, t, l FROM c JOIN n USING (snapshot_no) WHERE n.nxt IS NOT NULL),
x AS (SELECT * FROM c WHERE snapshot_no > (SELECT min(snapshot_no) FROM c)),
added AS (SELECT * FROM x EXCEPT ALL SELECT * FROM p),
gone AS (SELECT * FROM p EXCEPT ALL SELECT * FROM x)
SELECT coalesce(a.snapshot_no, g.snapshot_no) AS snapshot_no,
       CASE WHEN g.snapshot_no IS NULL THEN a.exchange_id ELSE g.exchange_id END AS exchange_id,
       CASE WHEN g.snapshot_no IS NULL THEN a.exchange_security_id ELSE g.exchange_security_id END AS exchange_security_id,
       CASE WHEN g.snapshot_no IS NULL THEN 'added' WHEN a.snapshot_no IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM added a FULL JOIN gone g ON a.snapshot_no = g.snapshot_no
 AND a.exchange_id IS NOT DISTINCT FROM g.exchange_id AND a.exchange_security_id IS NOT DISTINCT FROM g.exchange_security_id
""",
    "p6_found": f"""{_PAGES_SQL},
t AS ({_each_sql('(SELECT *, json_extract(e, $$$.tags$$) AS q FROM e)', _list_sql('q'), 'page_id, event_pos')}),
o AS ({_each_sql('(SELECT *, json_extract(m, $$$.outcomes$$) AS q FROM m)', _list_sql('q'), 'page_id, event_pos, market_pos')}),
k AS ({_each_sql('(SELECT *, json_extract(m, $$$.clobTokenIds$$) AS q FROM m)', _list_sql('q'), 'page_id, event_pos, market_pos')}),
r AS (SELECT page_id, event_pos, 'market' AS child, -1 AS market_pos, market_pos AS child_pos, m ->> '$.conditionId' AS child_value FROM m
UNION ALL SELECT page_id, event_pos, 'tag', -1, pos, CASE json_type(v) WHEN 'OBJECT' THEN v ->> '$.label' ELSE v ->> '$' END FROM t
UNION ALL SELECT page_id, event_pos, 'outcome', market_pos, pos, v ->> '$' FROM o UNION ALL SELECT page_id, event_pos, 'token', market_pos, pos, v ->> '$' FROM k)
SELECT page_id, event_pos::INTEGER AS event_pos, child, market_pos::INTEGER AS market_pos, child_pos::INTEGER AS child_pos, child_value FROM r WHERE child_value IS NOT NULL
""",
}
