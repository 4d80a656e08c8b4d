"""Queries of the contract-resolution operators over the project's tables, with their SQL.

Known state is never made up: snapshot 5 of the weekly full snapshots is what was known, snapshot 6 what came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import scalars as S
from weftline.operators import changes, entities, lifecycle, lookups, relations, reports, vectors
from weftline.plans import pipeline, ports
from weftline.session import table
from weftline.sources import feeds

LAST = "(SELECT max(snapshot_no) FROM contract_snapshot)"


FEED_COLUMNS = ("event_title", "outcome_label", "exchange_event_native_id", "event_volume", "ingest_pos")


def _snap(spark: SparkSession, folder: str, back: int, cols: tuple[str, ...] = FEED_COLUMNS) -> DataFrame:
    """The last snapshot (or one ``back`` before it), one row per contract: its latest copy."""
    rows = table(spark, folder, "contract_snapshot").filter("exchange_id is not null and exchange_security_id is not null")
    now = rows.filter(F.col("snapshot_no") == table(spark, folder, "contract_snapshot").select(F.max("snapshot_no")).scalar() - back)
    best = F.max_by(F.struct(*cols), F.struct("received_at", "ingest_pos")).alias("r")
    return now.groupBy("exchange_id", "exchange_security_id").agg(best).select("exchange_id", "exchange_security_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def _snap_sql(name: str, back: int) -> str:
    return f"""{name} AS (SELECT * FROM contract_snapshot WHERE snapshot_no = {LAST} - {back} AND exchange_id IS NOT NULL AND exchange_security_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY exchange_id, exchange_security_id ORDER BY received_at DESC NULLS LAST, ingest_pos DESC) = 1)"""


def _feed(df: DataFrame) -> DataFrame:
    return df.select("exchange_id", F.col("exchange_event_native_id").alias("native_id"), F.col("exchange_security_id").alias("security_id"), F.col("outcome_label").alias("label"), F.col("event_title").alias("title"), F.col("event_volume").alias("volume"), F.col("ingest_pos").alias("pos"))


_HASH = "left(sha256({0}exchange_id::VARCHAR || chr(0) || {0}exchange_security_id || chr(0) || coalesce({0}outcome_label, '') || chr(0) || coalesce({0}event_title, '') || chr(0) || coalesce({0}exchange_event_native_id, '')), 16)"

QUERIES: dict = {}
ORACLES: dict = {}


def _query(sql: str | None = None):  # noqa: ANN202
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# scalar functions


@_query("""SELECT s.security_id, upper(concat_ws('-', left(regexp_replace(trim(regexp_replace(lower(e.title), '[^a-z0-9\\s]', '', 'g')), '\\s+', '-', 'g'), 80),
  strftime(s.expiry, '%Y%m%dT%H'), regexp_replace(trim(regexp_replace(lower(s.outcome_label), '[^a-z0-9\\s]', '', 'g')), '\\s+', '-', 'g'))) AS symbol FROM sm_security s JOIN sm_event e USING (event_id)""")
def symbol_slug(spark: SparkSession, folder: str) -> DataFrame:
    s, e = table(spark, folder, "sm_security"), table(spark, folder, "sm_event").select("event_id", "title")
    return s.join(e, "event_id").select("security_id", S.security_symbol(F.col("title"), F.col("outcome_label"), F.col("expiry").cast("timestamp")).alias("symbol"))


@_query("""SELECT s.security_id, CASE WHEN s.expiry IS NULL AND e.expiry IS NULL THEN true WHEN s.expiry IS NULL OR e.expiry IS NULL THEN false
  ELSE abs(epoch_us(s.expiry) - epoch_us(e.expiry)) <= 3600000000 END AS near FROM sm_security s JOIN sm_event e USING (event_id)""")
def expiry_near(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "sm_security").select("security_id", "event_id", F.col("expiry").cast("timestamp").alias("a"))
    e = table(spark, folder, "sm_event").select("event_id", F.col("expiry").cast("timestamp").alias("b"))
    return s.join(e, "event_id").select("security_id", S.expiry_close(F.col("a"), F.col("b"), 3600).alias("near"))


@_query("""SELECT ingest_pos, left(sha256(coalesce(exchange_id::VARCHAR,'') || chr(0) || coalesce(exchange_security_id,'') || chr(0) || coalesce(outcome_label,'') || chr(0) ||
  coalesce(event_title,'') || chr(0) || coalesce(exchange_event_native_id,'')), 16) AS hash FROM adapter_contract""")
def contract_hash(spark: SparkSession, folder: str) -> DataFrame:
    cols = ["exchange_id", "exchange_security_id", "outcome_label", "event_title", "exchange_event_native_id"]
    return table(spark, folder, "adapter_contract").select("ingest_pos", S.contract_hash(*[F.col(c) for c in cols]).alias("hash"))


@_query("""WITH l AS (SELECT event_id, list_sort(list(outcome_label)) AS ls FROM sm_security WHERE event_id IS NOT NULL AND outcome_label IS NOT NULL GROUP BY event_id),
t AS (SELECT e.event_id, concat_ws(chr(0), e.title, array_to_string(l.ls, '|')) AS k, e.title FROM sm_event e JOIN l USING (event_id)),
p AS (SELECT DISTINCT least(a.event_id, b.event_id) x, greatest(a.event_id, b.event_id) y FROM (SELECT * FROM contract_relationship) r
  JOIN sm_security a ON a.security_id = r.security_id_a JOIN sm_security b ON b.security_id = r.security_id_b WHERE a.event_id <> b.event_id)
SELECT x AS event_a, y AS event_b, sha256(concat_ws(chr(0), 'judge-1', least(a.k, b.k), greatest(a.k, b.k))) AS pair_key, a.k <= b.k AS a_first FROM p JOIN t a ON a.event_id = x JOIN t b ON b.event_id = y""")
def pair_hash_symmetric(spark: SparkSession, folder: str) -> DataFrame:
    sec, ev = table(spark, folder, "sm_security"), table(spark, folder, "sm_event")
    labels = sec.filter("event_id is not null and outcome_label is not null").groupBy("event_id").agg(F.collect_list("outcome_label").alias("ls"))
    titled = ev.select("event_id", "title").join(labels, "event_id")
    ids = sec.filter("event_id is not null").select("security_id", "event_id")
    rel = table(spark, folder, "contract_relationship").select("security_id_a", "security_id_b")
    a, b = ids.toDF("security_id_a", "ea"), ids.toDF("security_id_b", "eb")
    pairs = rel.join(a, "security_id_a").join(b, "security_id_b").filter("ea <> eb").select(F.least("ea", "eb").alias("event_a"), F.greatest("ea", "eb").alias("event_b")).distinct()
    both = pairs.join(titled.toDF("event_a", "ta", "la"), "event_a").join(titled.toDF("event_b", "tb", "lb"), "event_b")
    return both.select("event_a", "event_b", S.pair_key(F.lit("judge-1"), F.col("ta"), F.col("la"), F.col("tb"), F.col("lb")).alias("pair_key"), S.first_is_a(F.col("ta"), F.col("la"), F.col("tb"), F.col("lb")).alias("a_first"))


@_query("SELECT event_id, left(sha256(title), 6) AS key FROM sm_event WHERE title IS NOT NULL")
def title_key(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sm_event").filter("title is not null").select("event_id", S.title_key(F.col("title")).alias("key"))


@_query("SELECT event_id, trim(props) AS body FROM events")
def strip_fences(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies out of fences with and without a language, with white space around, without an end, and out of none."""
    kind = F.col("event_id") % 5
    at = lambda before, after: F.concat(F.lit(before), F.col("props"), F.lit(after))
    fenced = F.when(kind == 0, at("```json\n", "\n```")).when(kind == 1, at("```\n", "\n```  ")).when(kind == 2, at(" \n```json\n", "```\n")).when(kind == 3, at("```json\n", "")).otherwise(F.col("props"))
    return table(spark, folder, "events").select("event_id", S.strip_code_fences(fenced).alias("body"))


@_query("SELECT event_id, CASE WHEN coalesce(description, '') <> '' THEN title || '. ' || left(description, 200) ELSE title END AS text FROM sm_event")
def embed_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sm_event").select("event_id", S.embedding_text(F.col("title"), F.col("description")).alias("text"))


@_query("""SELECT ingest_pos, exchange_id, exchange_security_id AS native_id, length(exchange_security_id) - length(replace(exchange_security_id, ':', '')) AS n_colons FROM adapter_contract
WHERE exchange_id IS NOT NULL AND exchange_security_id IS NOT NULL""")
def key_pack_split(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of venue and native id apart again; native ids hold colons themselves."""
    rows = table(spark, folder, "adapter_contract").filter("exchange_id is not null and exchange_security_id is not null")
    ex, native = S.split_native_key(F.col("key"))
    return rows.select("ingest_pos", S.native_key(F.col("exchange_id"), F.col("exchange_security_id")).alias("key")).select("ingest_pos", ex.alias("exchange_id"), native.alias("native_id"), (F.size(F.split("key", ":")) - 2).cast("long").alias("n_colons"))


@_query("SELECT event_id, coalesce(nullif(category, ''), 'OTHER') AS category, len(coalesce(tags, [])) AS n_tags FROM sm_event")
def null_defaults(spark: SparkSession, folder: str) -> DataFrame:
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    return table(spark, folder, "sm_event").select("event_id", S.or_default(F.col("category"), "OTHER").alias("category"), F.size(tags).cast("long").alias("n_tags"))


@_query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def props_json(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@_query("""SELECT ingest_pos, exchange_id AS ex, event_title AS title, outcome_label AS label FROM adapter_contract""")
def message_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "adapter_contract").select("ingest_pos", F.to_json(F.struct("exchange_id", "event_title", "outcome_label", "event_volume")).alias("body"))
    back = F.from_json("body", "exchange_id long, event_title string, outcome_label string")
    return rows.select("ingest_pos", back.alias("m")).select("ingest_pos", F.col("m.exchange_id").alias("ex"), F.col("m.event_title").alias("title"), F.col("m.outcome_label").alias("label"))


# filters and joins


@_query("""WITH g AS (SELECT exchange_id, exchange_event_native_id AS native_id, arg_min(struct_pack(v := event_volume), ingest_pos).v AS volume FROM adapter_contract GROUP BY ALL)
SELECT * FROM g WHERE volume IS NULL OR volume >= 500""")
def volume_filter(spark: SparkSession, folder: str) -> DataFrame:
    feed = _feed(table(spark, folder, "adapter_contract"))
    return changes.volume_filter(changes.first_of_group(feed, changes.NATIVE, "pos", "volume"), "volume", 500.0)


@_query("""SELECT r.relationship_id FROM contract_relationship r JOIN sm_security a ON a.security_id = r.security_id_a JOIN sm_security b ON b.security_id = r.security_id_b
JOIN sm_event x ON x.event_id = a.event_id JOIN sm_event y ON y.event_id = b.event_id
WHERE (x.category IS NULL OR x.category IN ('Politics', 'Sports')) OR (y.category IS NULL OR y.category IN ('Politics', 'Sports'))""")
def category_filter(spark: SparkSession, folder: str) -> DataFrame:
    cats = table(spark, folder, "sm_security").join(table(spark, folder, "sm_event").select("event_id", "category"), "event_id").select("security_id", "category")
    rel = table(spark, folder, "contract_relationship").select("relationship_id", "security_id_a", "security_id_b")
    both = rel.join(cats.toDF("security_id_a", "category_a"), "security_id_a").join(cats.toDF("security_id_b", "category_b"), "security_id_b")
    return relations.allowed_pairs(both, ["Politics", "Sports"]).select("relationship_id")


@_query("SELECT security_id, event_id FROM sm_security WHERE event_id IN (SELECT event_id FROM sm_event WHERE resolved)")
def in_list_semi(spark: SparkSession, folder: str) -> DataFrame:
    over = table(spark, folder, "sm_event").filter("resolved").select("event_id")
    return table(spark, folder, "sm_security").select("security_id", "event_id").join(over, "event_id", "left_semi")


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)}, k AS (SELECT exchange_id, exchange_event_native_id AS native_id, min(ingest_pos) AS event_id FROM p GROUP BY ALL)
SELECT c.exchange_id, c.exchange_security_id, k.event_id FROM c JOIN k ON k.exchange_id = c.exchange_id AND k.native_id = c.exchange_event_native_id""")
def native_lookup(spark: SparkSession, folder: str) -> DataFrame:
    known = _feed(_snap(spark, folder, 1)).groupBy(*changes.NATIVE).agg(F.min("pos").alias("event_id"))
    rows = _feed(_snap(spark, folder, 0))
    return entities.split_known(rows, known, changes.NATIVE)[0].select("exchange_id", F.col("security_id").alias("exchange_security_id"), "event_id")


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)} SELECT c.exchange_id, c.exchange_security_id FROM c ANTI JOIN p USING (exchange_id, exchange_security_id)""")
def listing_anti(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["exchange_id", "exchange_security_id"]
    return entities.split_known(_snap(spark, folder, 0).select(*keys), _snap(spark, folder, 1).select(*keys), keys)[1]


@_query("SELECT event_id FROM sm_event e WHERE NOT coalesce(resolved, false) AND NOT EXISTS (SELECT 1 FROM event_embedding v WHERE v.event_id = e.event_id AND v.embedding IS NOT NULL)")
def events_without_embedding(spark: SparkSession, folder: str) -> DataFrame:
    open_ = table(spark, folder, "sm_event").filter(~F.coalesce("resolved", F.lit(False))).select("event_id")
    return open_.join(table(spark, folder, "event_embedding").filter("embedding is not null").select("event_id"), "event_id", "left_anti")


@_query("""WITH g AS (SELECT security_id_a AS s FROM contract_relationship WHERE upper(trim(relationship_type)) = 'IMPLIES')
SELECT event_id, security_id FROM sm_security WHERE event_id IN (SELECT event_id FROM sm_security WHERE security_id IN (SELECT s FROM g))""")
def sibling_expansion(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "contract_relationship").filter("upper(trim(relationship_type)) = 'IMPLIES'").select(F.col("security_id_a").alias("security_id"))
    return relations.siblings(table(spark, folder, "sm_security").select("event_id", "security_id"), given)


@_query("""SELECT relationship_id FROM contract_relationship WHERE security_id_a IN (SELECT security_id FROM sm_security WHERE active) OR security_id_b IN (SELECT security_id FROM sm_security WHERE active)""")
def or_join_relationships(spark: SparkSession, folder: str) -> DataFrame:
    rel = table(spark, folder, "contract_relationship").select("relationship_id", "security_id_a", "security_id_b")
    return relations.touching(rel, table(spark, folder, "sm_security").filter("active")).select("relationship_id")


@_query("""WITH k AS (SELECT * FROM (VALUES ('harbour', 1), ('mayor', 2), ('vaccine', 3), ('union', 4), ('satellite phone', 5)) t(keyword, keyword_security_id))
SELECT DISTINCT k.keyword_security_id, s.security_id, k.keyword FROM k JOIN (SELECT s.security_id, e.title || ' ' || coalesce(s.outcome_label, '') AS text FROM sm_security s JOIN sm_event e USING (event_id)) s
ON regexp_matches(lower(s.text), '\\b' || k.keyword || '\\b')""")
def hedgeable_pairs(spark: SparkSession, folder: str) -> DataFrame:
    words = spark.createDataFrame([("harbour", 1), ("mayor", 2), ("vaccine", 3), ("union", 4), ("satellite phone", 5)], "keyword string, keyword_security_id long")
    s = table(spark, folder, "sm_security").join(table(spark, folder, "sm_event").select("event_id", "title"), "event_id")
    return relations.keyword_pairs(s.select("security_id", F.concat_ws(" ", "title", "outcome_label").alias("text")), words)


@_query("""SELECT a.event_id AS key, min(b.event_id) AS event_id FROM sm_event a JOIN sm_event b ON lower(a.category) = lower(b.category) AND b.event_id < a.event_id
AND CASE WHEN a.expiry IS NULL AND b.expiry IS NULL THEN true WHEN a.expiry IS NULL OR b.expiry IS NULL THEN false ELSE abs(epoch_us(a.expiry) - epoch_us(b.expiry)) <= 86400000000 END GROUP BY ALL""")
def tolerance_join(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "sm_event").filter("category is not null").select("event_id", F.lower("category").alias("title"), F.col("expiry").cast("timestamp").alias("expiry"))
    new = e.select(F.col("event_id").alias("key"), "title", "expiry")
    return entities.tolerance_join(new, e, 86_400).filter("event_id < key")


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)} SELECT DISTINCT p.exchange_id, p.exchange_event_native_id AS native_id FROM p
WHERE p.exchange_id IN (SELECT exchange_id FROM c) AND NOT EXISTS (SELECT 1 FROM c WHERE c.exchange_id = p.exchange_id AND c.exchange_event_native_id = p.exchange_event_native_id)""")
def missing_actives(spark: SparkSession, folder: str) -> DataFrame:
    old, now = changes.active_sets(_feed(_snap(spark, folder, 1))), changes.active_sets(_feed(_snap(spark, folder, 0)))
    return old.join(now.select("exchange_id").distinct(), "exchange_id", "left_semi").join(now, changes.NATIVE, "left_anti")


_COMPLEMENT = """g AS (SELECT event_id, count(*) n, min(security_id) a, max(security_id) b FROM sm_security WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) = 2),
comp AS (SELECT security_id, arg_max(other_id, event_id) AS other_id FROM (SELECT event_id, a AS security_id, b AS other_id FROM g UNION ALL SELECT event_id, b, a FROM g) GROUP BY 1)"""


@_query(f"WITH {_COMPLEMENT} SELECT * FROM comp")
def complement_map(spark: SparkSession, folder: str) -> DataFrame:
    return relations.complement_map(table(spark, folder, "sm_security").filter("event_id is not null").select("event_id", "security_id"))


@_query("""WITH c AS (SELECT *, count(*) OVER (PARTITION BY event_id) n, row_number() OVER (PARTITION BY event_id ORDER BY security_id) rk FROM sm_security WHERE event_id IS NOT NULL)
SELECT event_id, security_id FROM c WHERE n <> 2 OR rk = 1""")
def primary_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return relations.primary_contracts(table(spark, folder, "sm_security").filter("event_id is not null").select("event_id", "security_id"))


@_query("""WITH p AS (SELECT a.vec_id q, b.vec_id c, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) sim FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, c) rk FROM p)
SELECT least(q, c) a, greatest(q, c) b, round(max(sim), 6) sim FROM r WHERE rk <= 10 AND sim >= 0.4 GROUP BY ALL""")
def knn_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = vectors.exact_neighbours(table(spark, folder, "embeddings"), "vec_id", "embedding", 10, 0.4)
    return pairs.select("a", "b", F.round("sim", 6).alias("sim"))


# aggregation and state


@_query("""SELECT exchange_id, exchange_event_native_id AS native_id, arg_min(event_title, ingest_pos) AS title, min(ingest_pos) AS pos FROM adapter_contract WHERE event_title IS NOT NULL GROUP BY ALL""")
def group_first(spark: SparkSession, folder: str) -> DataFrame:
    feed = _feed(table(spark, folder, "adapter_contract")).filter("title is not null")
    return changes.first_of_group(feed, changes.NATIVE, "pos", "title", "pos")


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)},
g AS (SELECT c.exchange_id, c.exchange_event_native_id AS native_id, arg_min(struct_pack(v := c.event_volume), c.ingest_pos).v AS volume, count(*) AS n_contracts,
  count(*) FILTER (WHERE p.exchange_id IS NULL OR {_HASH.format('p.')} <> {_HASH.format('c.')}) AS n_changed
  FROM c LEFT JOIN p USING (exchange_id, exchange_security_id) GROUP BY 1, 2)
SELECT * FROM g WHERE n_changed > 0 AND (volume IS NULL OR volume >= 100)""")
def diff_contracts(spark: SparkSession, folder: str) -> DataFrame:
    old, now = _feed(_snap(spark, folder, 1)), _feed(_snap(spark, folder, 0))
    known = old.select("exchange_id", "security_id", S.contract_hash(*[F.col(c) for c in ("exchange_id", "security_id", "label", "title", "native_id")]).alias("hash"))
    return changes.diff_contracts(now, known, least_volume=100.0).messages


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)}, x AS (SELECT c.exchange_id, c.exchange_event_native_id AS native_id, c.exchange_security_id AS security_id, c.ingest_pos, {_HASH.format('c.')} AS hash,
  CASE WHEN p.exchange_id IS NOT NULL THEN {_HASH.format('p.')} END AS known FROM c LEFT JOIN p USING (exchange_id, exchange_security_id)),
g AS (SELECT exchange_id, native_id FROM x GROUP BY ALL HAVING bool_or(known IS DISTINCT FROM hash) ORDER BY min(ingest_pos) LIMIT 20)
SELECT DISTINCT exchange_id, security_id, CASE WHEN EXISTS (SELECT 1 FROM g WHERE g.exchange_id = x.exchange_id AND g.native_id = x.native_id) THEN hash ELSE known END AS hash FROM x
WHERE native_id IS NOT NULL AND (known IS NOT NULL OR EXISTS (SELECT 1 FROM g WHERE g.exchange_id = x.exchange_id AND g.native_id = x.native_id))""")
def known_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """What is known after a run that sends twenty groups at most (the cap is the feature): new hashes of what was sent, old ones of what waits."""
    old, now = _feed(_snap(spark, folder, 1)), _feed(_snap(spark, folder, 0))
    known = old.select("exchange_id", "security_id", S.contract_hash(*[F.col(c) for c in ("exchange_id", "security_id", "label", "title", "native_id")]).alias("hash"))
    return changes.diff_contracts(now.filter("native_id is not null"), known, most=20).hashes


@_query("SELECT DISTINCT exchange_id, exchange_event_native_id AS native_id FROM adapter_contract")
def active_sets(spark: SparkSession, folder: str) -> DataFrame:
    return changes.active_sets(_feed(table(spark, folder, "adapter_contract")))


@_query("SELECT event_id, count(*) FILTER (WHERE active) AS n_active FROM sm_security WHERE event_id IS NOT NULL GROUP BY event_id")
def active_count_per_event(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "sm_security").filter("event_id is not null")
    return lifecycle.active_count(s.select("event_id", "security_id"), s.select("security_id", "active"))


_SPECS = ["tick_size", "lot_size", "min_notional", "contract_multiplier"]


@_query("""SELECT exchange_id, exchange_security_id, tick_size, lot_size, min_notional, contract_multiplier FROM contract_snapshot
QUALIFY row_number() OVER (PARTITION BY exchange_id, exchange_security_id ORDER BY received_at DESC NULLS LAST, ingest_pos DESC) = 1""")
def latest_spec(spark: SparkSession, folder: str) -> DataFrame:
    return entities.latest_spec(table(spark, folder, "contract_snapshot"), ["exchange_id", "exchange_security_id"], _SPECS, ["received_at", "ingest_pos"])


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)} SELECT c.exchange_id, c.exchange_security_id, c.tick_size, c.lot_size, c.min_notional, c.contract_multiplier,
  CASE WHEN p.exchange_id IS NULL THEN 'new' ELSE 'update' END AS action FROM c LEFT JOIN p USING (exchange_id, exchange_security_id)
WHERE p.exchange_id IS NULL OR trunc(c.tick_size*1e9)::BIGINT IS DISTINCT FROM trunc(p.tick_size*1e9)::BIGINT OR trunc(c.lot_size*1e9)::BIGINT IS DISTINCT FROM trunc(p.lot_size*1e9)::BIGINT
  OR trunc(c.min_notional*1e9)::BIGINT IS DISTINCT FROM trunc(p.min_notional*1e9)::BIGINT OR trunc(c.contract_multiplier*1e9)::BIGINT IS DISTINCT FROM trunc(p.contract_multiplier*1e9)::BIGINT""")
def spec_sync(spark: SparkSession, folder: str) -> DataFrame:
    return entities.spec_changes(_snap(spark, folder, 0, tuple(_SPECS)), _snap(spark, folder, 1, tuple(_SPECS)), ["exchange_id", "exchange_security_id"], _SPECS)


@_query("""SELECT security_id_a, security_id_b, arg_max(relationship_type, struct_pack(c := confidence, i := -relationship_id)) AS relationship_type, max(confidence) AS confidence,
-max(struct_pack(c := confidence, i := -relationship_id)).i AS relationship_id FROM contract_relationship WHERE security_id_a IS NOT NULL AND security_id_b IS NOT NULL AND confidence IS NOT NULL GROUP BY ALL""")
def best_pair(spark: SparkSession, folder: str) -> DataFrame:
    rel = table(spark, folder, "contract_relationship").filter("security_id_a is not null and security_id_b is not null and confidence is not null")
    return relations.best_per_pair(rel, "relationship_id")


@_query("""WITH s AS (SELECT least(security_id_a, security_id_b) a, greatest(security_id_a, security_id_b) b, confidence FROM contract_relationship WHERE security_id_a IS NOT NULL AND security_id_b IS NOT NULL)
SELECT a, b, max(confidence) AS sim FROM s GROUP BY ALL""")
def max_similarity(spark: SparkSession, folder: str) -> DataFrame:
    rel = table(spark, folder, "contract_relationship").filter("security_id_a is not null and security_id_b is not null")
    return vectors.max_similarity(rel.select(F.col("security_id_a").alias("q"), F.col("security_id_b").alias("c"), F.col("confidence").alias("sim")))


@_query("""WITH RECURSIVE d AS (SELECT event_title AS k, epoch_us(received_at) // 86400000000 AS v, min(ingest_pos) AS p FROM contract_snapshot WHERE event_title IS NOT NULL GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p) rn FROM d),
r AS (SELECT k, rn, [{'p': p, 'v': v}] AS ldr FROM o WHERE rn = 1 UNION ALL
  SELECT o.k, o.rn, CASE WHEN len(list_filter(r.ldr, lambda x: (x.v IS NULL AND o.v IS NULL) OR coalesce(abs(x.v - o.v) <= 10, false))) > 0 THEN r.ldr ELSE list_append(r.ldr, {'p': o.p, 'v': o.v}) END
  FROM r JOIN o ON o.k = r.k AND o.rn = r.rn + 1),
f AS (SELECT k, arg_max(ldr, rn) AS ldr FROM r GROUP BY k)
SELECT o.k AS title, o.v AS day, list_filter(f.ldr, lambda x: (x.v IS NULL AND o.v IS NULL) OR coalesce(abs(x.v - o.v) <= 10, false))[1].p AS leader_pos FROM o JOIN f ON f.k = o.k""")
def leader_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "contract_snapshot").filter("event_title is not null")
    day = F.floor(F.unix_micros(F.col("received_at").cast("timestamp")) / F.lit(86_400_000_000)).cast("long")
    return entities.leaders(rows.select(F.col("event_title").alias("title"), day.alias("day"), "ingest_pos"), "title", "day", "ingest_pos", 10)


@_query(f"""WITH {_snap_sql('c', 0)} SELECT DISTINCT c.exchange_id, c.exchange_event_native_id AS native_id FROM c ANTI JOIN (SELECT DISTINCT exchange_id, exchange_event_native_id FROM adapter_contract) a
ON a.exchange_id = c.exchange_id AND a.exchange_event_native_id = c.exchange_event_native_id""")
def resolved_minus_sent(spark: SparkSession, folder: str) -> DataFrame:
    return changes.send_once(_feed(_snap(spark, folder, 0)), changes.active_sets(_feed(table(spark, folder, "adapter_contract"))), changes.NATIVE)[0]


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)}, s AS (SELECT DISTINCT exchange_id, exchange_event_native_id AS native_id FROM p), n AS (SELECT DISTINCT exchange_id, exchange_event_native_id AS native_id FROM c WHERE exchange_event_native_id IS NOT NULL)
SELECT * FROM n SEMI JOIN s USING (exchange_id, native_id) UNION ALL SELECT * FROM (SELECT * FROM n ANTI JOIN s USING (exchange_id, native_id) ORDER BY exchange_id, native_id LIMIT 5)""")
def sent_state_update(spark: SparkSession, folder: str) -> DataFrame:
    """What is remembered as sent where a tick sends five at most (the cap is the feature)."""
    sent = changes.active_sets(_feed(_snap(spark, folder, 1)))
    return changes.send_once(_feed(_snap(spark, folder, 0)).filter("native_id is not null"), sent, changes.NATIVE, 5)[1]


_TICKS = f"""t AS (SELECT exchange_id, exchange_event_native_id AS native_id, max(snapshot_no) AS seen FROM contract_snapshot WHERE snapshot_no < {LAST} AND exchange_event_native_id IS NOT NULL AND exchange_id IS NOT NULL GROUP BY ALL),
tr AS (SELECT exchange_id, native_id, ({LAST} - 1 - seen)::INTEGER AS misses FROM t),
a AS (SELECT DISTINCT exchange_id, exchange_event_native_id AS native_id, true AS here FROM contract_snapshot WHERE snapshot_no = {LAST} AND exchange_event_native_id IS NOT NULL AND exchange_id IS NOT NULL),
u AS (SELECT exchange_id, native_id, CASE WHEN here THEN 0 ELSE misses + 1 END AS misses FROM tr FULL JOIN a USING (exchange_id, native_id))"""


def _tracked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = table(spark, folder, "contract_snapshot").filter("exchange_event_native_id is not null and exchange_id is not null")
    top = table(spark, folder, "contract_snapshot").select(F.max("snapshot_no")).scalar()
    ticks = raw.select("exchange_id", F.col("exchange_event_native_id").alias("native_id"), "snapshot_no", top.alias("top"))
    tracker = ticks.filter("snapshot_no < top").groupBy(*changes.NATIVE, "top").agg(F.max("snapshot_no").alias("seen")).select(*changes.NATIVE, (F.col("top") - 1 - F.col("seen")).alias("misses"))
    return changes.update_tracker(tracker, ticks.filter("snapshot_no = top"), 2)


@_query(f"WITH {_TICKS} SELECT exchange_id, native_id, misses::INTEGER AS misses FROM u WHERE misses < 2")
def stale_tracker(spark: SparkSession, folder: str) -> DataFrame:
    return _tracked(spark, folder)[0]


@_query(f"WITH {_TICKS} SELECT exchange_id, native_id, misses::INTEGER AS misses FROM u WHERE misses >= 2")
def stale_events(spark: SparkSession, folder: str) -> DataFrame:
    return _tracked(spark, folder)[1]


_STATE = f"""{_snap_sql('p', 1)}, {_snap_sql('c', 0)},
l AS (SELECT exchange_id, exchange_security_id, lower(event_title) || '|' || lower(outcome_label) AS security_id, lower(event_title) AS event_id FROM p WHERE event_title IS NOT NULL AND outcome_label IS NOT NULL),
offl AS (SELECT l.* FROM l ANTI JOIN c USING (exchange_id, exchange_security_id)), leftl AS (SELECT l.* FROM l SEMI JOIN c USING (exchange_id, exchange_security_id)),
offs AS (SELECT DISTINCT security_id, event_id FROM offl WHERE security_id NOT IN (SELECT security_id FROM leftl)),
offe AS (SELECT DISTINCT event_id FROM offs WHERE event_id NOT IN (SELECT event_id FROM leftl))"""


@_query(f"""WITH {_STATE} SELECT 'listing' AS kind, exchange_id::VARCHAR || ':' || exchange_security_id AS id FROM offl UNION ALL SELECT 'security', security_id FROM offs UNION ALL SELECT 'event', event_id FROM offe""")
def deactivation_cascade(spark: SparkSession, folder: str) -> DataFrame:
    key = ["exchange_id", "exchange_security_id"]
    old = _snap(spark, folder, 1).filter("event_title is not null and outcome_label is not null").select(*key, F.concat_ws("|", F.lower("event_title"), F.lower("outcome_label")).alias("security_id"), F.lower("event_title").alias("event_id"))
    listings = old.select(*key, "security_id", F.lit(True).alias("active"))
    securities = old.select("security_id", F.lit(True).alias("active")).distinct()
    links = old.select("event_id", "security_id").distinct()
    events = old.select("event_id", F.lit(False).alias("resolved")).distinct()
    hit = old.select(*key).join(_snap(spark, folder, 0).select(*key), key, "left_anti")
    out = lifecycle.cascade(listings, securities, links, events, hit, key)
    return (
        out.listings.select(F.lit("listing").alias("kind"), F.concat_ws(":", F.col("exchange_id").cast("string"), "exchange_security_id").alias("id"))
        .unionByName(out.securities.select(F.lit("security").alias("kind"), F.col("security_id").alias("id")))
        .unionByName(out.events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id")))
    )


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)} SELECT p.exchange_id, p.exchange_security_id FROM p
WHERE EXISTS (SELECT 1 FROM c WHERE c.exchange_id = p.exchange_id AND c.exchange_event_native_id = p.exchange_event_native_id)
AND NOT EXISTS (SELECT 1 FROM c WHERE c.exchange_id = p.exchange_id AND c.exchange_security_id = p.exchange_security_id)""")
def reconcile_stale(spark: SparkSession, folder: str) -> DataFrame:
    old = _snap(spark, folder, 1).withColumn("active", F.lit(True))
    return lifecycle.reconcile(old, _snap(spark, folder, 0), ["exchange_id", "exchange_event_native_id"], ["exchange_id", "exchange_security_id"])


_JUDGED = """j AS (SELECT DISTINCT security_id_a a, security_id_b b, upper(trim(relationship_type)) t, confidence FROM contract_relationship
WHERE security_id_a IS NOT NULL AND security_id_b IS NOT NULL AND security_id_a <> security_id_b AND confidence IS NOT NULL AND upper(trim(relationship_type)) IN ('EQUIVALENT','IMPLIES','MUTUALLY_EXCLUSIVE','HEDGEABLE_WITH'))"""


@_query(f"""WITH {_COMPLEMENT}, {_JUDGED}, x AS (SELECT j.*, ca.other_id na, cb.other_id nb FROM j LEFT JOIN comp ca ON ca.security_id = a LEFT JOIN comp cb ON cb.security_id = b),
e AS (SELECT a, b, t, confidence FROM x UNION ALL SELECT nb, na, 'IMPLIES', confidence FROM x WHERE t = 'IMPLIES'
UNION ALL SELECT na, nb, t, confidence FROM x WHERE t = 'EQUIVALENT' UNION ALL SELECT nb, na, t, confidence FROM x WHERE t = 'EQUIVALENT'
UNION ALL SELECT a, nb, 'IMPLIES', confidence FROM x WHERE t = 'MUTUALLY_EXCLUSIVE' UNION ALL SELECT b, na, 'IMPLIES', confidence FROM x WHERE t = 'MUTUALLY_EXCLUSIVE')
SELECT a AS security_id_a, b AS security_id_b, t AS relationship_type, confidence FROM e WHERE a IS NOT NULL AND b IS NOT NULL""")
def derive_relationships(spark: SparkSession, folder: str) -> DataFrame:
    rel = table(spark, folder, "contract_relationship").select("security_id_a", "security_id_b", F.upper(F.trim("relationship_type")).alias("relationship_type"), "confidence")
    judged = rel.filter("security_id_a is not null and security_id_b is not null and security_id_a <> security_id_b and confidence is not null").filter(F.col("relationship_type").isin(*relations.TYPES)).distinct()
    return relations.derive(judged, relations.complement_map(table(spark, folder, "sm_security").filter("event_id is not null").select("event_id", "security_id")))


@_query("""WITH m AS (SELECT * FROM contract_relationship WHERE method = 'embedding' AND security_id_a IS NOT NULL AND security_id_b IS NOT NULL AND confidence IS NOT NULL),
b AS (SELECT security_id_a, security_id_b, relationship_type, confidence, relationship_id FROM m QUALIFY row_number() OVER (PARTITION BY security_id_a, security_id_b ORDER BY confidence DESC, relationship_id) = 1),
x AS (SELECT security_id_a p, security_id_b q FROM contract_relationship WHERE method = 'rule'), k AS (SELECT p, q FROM x UNION SELECT q, p FROM x)
SELECT * FROM b WHERE confidence >= 0.7 AND NOT EXISTS (SELECT 1 FROM k WHERE k.p = b.security_id_a AND k.q = b.security_id_b)""")
def dedup_relationships(spark: SparkSession, folder: str) -> DataFrame:
    rel = table(spark, folder, "contract_relationship")
    new = rel.filter("method = 'embedding' and security_id_a is not null and security_id_b is not null and confidence is not null")
    return relations.to_write(new.select("security_id_a", "security_id_b", "relationship_type", "confidence", "relationship_id"), rel.filter("method = 'rule'"), "relationship_id", 0.7)


@_query("""SELECT DISTINCT security_id_a, security_id_b FROM (SELECT security_id_a, security_id_b FROM contract_relationship UNION ALL SELECT security_id_b, security_id_a FROM contract_relationship)""")
def symmetric_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return relations.both_ways(table(spark, folder, "contract_relationship"))


@_query(f"""WITH {_JUDGED}, f AS (SELECT a, b, t, confidence, row_number() OVER (PARTITION BY a, b ORDER BY confidence DESC, t) rk FROM j)
SELECT a AS security_id_a, b AS security_id_b, t AS relationship_type, confidence FROM f WHERE rk = 1 AND confidence >= 0.7
UNION ALL SELECT b, a, t, confidence FROM f WHERE rk = 1 AND confidence >= 0.7 AND t <> 'IMPLIES'""")
def judge_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Judgements sent through their JSON response form and back: one fenced response per pair of securities."""
    rel = table(spark, folder, "contract_relationship").select("security_id_a", "security_id_b", F.upper(F.trim("relationship_type")).alias("t"), "confidence").filter("security_id_a <> security_id_b and confidence is not null").distinct()
    rel = rel.filter(F.col("t").isin(*relations.TYPES)).withColumn("pair_id", F.concat_ws("-", "security_id_a", "security_id_b"))
    item = F.struct("t", F.to_json(F.struct(F.lit("1").alias("a"), F.lit("1").alias("b"), F.col("t").alias("type"), F.col("confidence").cast("string").alias("confidence"))).alias("j"))
    text = F.concat(F.lit("```json\n["), F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["j"]), ","), F.lit("]\n```"))
    responses = rel.groupBy("pair_id").agg(text.alias("text"))
    ends = rel.select("pair_id", "security_id_a", "security_id_b").distinct()
    sides = ends.select("pair_id", F.inline(F.array(F.struct(F.lit("a").alias("side"), F.lit(1).alias("place"), F.col("security_id_a").alias("security_id")), F.struct(F.lit("b").alias("side"), F.lit(1).alias("place"), F.col("security_id_b").alias("security_id")))))
    return relations.judged_pairs(responses, sides)


@_query("""SELECT v.event_id, len(v.embedding) AS n FROM event_embedding v WHERE NOT EXISTS (SELECT 1 FROM sm_event e WHERE e.event_id = v.event_id AND e.resolved)""")
def embedding_delete(spark: SparkSession, folder: str) -> DataFrame:
    kept = entities.delete(table(spark, folder, "event_embedding"), table(spark, folder, "sm_event").filter("resolved"), ["event_id"])
    return kept.select("event_id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("long").alias("n"))


@_query("""WITH n AS (SELECT event_id, max(embedded_at) AS at FROM event_embedding GROUP BY event_id) SELECT e.event_id, coalesce(epoch_us(n.at), -1) AS at FROM sm_event e LEFT JOIN n USING (event_id)""")
def embedding_upsert(spark: SparkSession, folder: str) -> DataFrame:
    blank = table(spark, folder, "sm_event").select("event_id", F.lit(-1).cast("long").alias("at"))
    new = table(spark, folder, "event_embedding").groupBy("event_id").agg(F.unix_micros(F.max("embedded_at").cast("timestamp")).alias("at")).filter("at is not null")
    return entities.upsert(blank, new, ["event_id"])


@_query("""SELECT e.event_id, coalesce(x.c, e.category) AS category FROM sm_event e LEFT JOIN (SELECT event_id, arg_max(description, security_id) c FROM sm_security WHERE description IS NOT NULL AND event_id IS NOT NULL GROUP BY 1) x USING (event_id)""")
def bulk_patch(spark: SparkSession, folder: str) -> DataFrame:
    patches = table(spark, folder, "sm_security").filter("description is not null and event_id is not null").groupBy("event_id").agg(F.max_by("description", "security_id").alias("category"))
    return entities.patch(table(spark, folder, "sm_event").select("event_id", "category"), patches, ["event_id"])


@_query("""SELECT row_number() OVER (ORDER BY title) + (SELECT max(event_id) FROM sm_event) AS event_id, title FROM (SELECT DISTINCT event_title AS title FROM adapter_contract WHERE event_title IS NOT NULL AND event_title NOT IN (SELECT title FROM sm_event WHERE title IS NOT NULL))""")
def created_events(spark: SparkSession, folder: str) -> DataFrame:
    ev = table(spark, folder, "sm_event")
    new = entities.new_first(table(spark, folder, "adapter_contract").filter("event_title is not null").withColumn("title", F.col("event_title")), ev.select("title"), ["title"], "ingest_pos", ["event_title"]).select("title")
    return entities.with_ids(new, ev, "event_id", ["title"]).select("event_id", "title")


@_query("""SELECT DISTINCT s AS symbol FROM (SELECT base_currency s FROM adapter_contract UNION ALL SELECT quote_currency FROM adapter_contract UNION ALL SELECT settle_currency FROM adapter_contract) WHERE s IS NOT NULL AND s NOT IN ('USD')""")
def currencies_to_create(spark: SparkSession, folder: str) -> DataFrame:
    return entities.new_currencies(table(spark, folder, "adapter_contract"), spark.createDataFrame([("USD",)], "symbol string"))


@_query("""SELECT event_id, ((row_number() OVER (PARTITION BY category ORDER BY event_id) - 1) // 15)::BIGINT AS chunk, row_number() OVER (PARTITION BY category ORDER BY event_id)::INTEGER AS place FROM sm_event""")
def prompt_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return changes.chunk_ids(table(spark, folder, "sm_event").select("event_id", "category"), ["event_id"], 15, ["category"]).select("event_id", "chunk", "place")


@_query("""SELECT ingest_pos, exchange_id FROM (SELECT *, row_number() OVER (ORDER BY ingest_pos) rn FROM adapter_contract) WHERE rn <= 500""")
def cap_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """The per-run message cap: the limit is the feature."""
    return changes.cap_in_order(table(spark, folder, "adapter_contract").select("ingest_pos", "exchange_id"), "ingest_pos", 500)[0]


# reports


@_query("""SELECT lower(trim(outcome_label)) AS title, count(DISTINCT exchange_id) AS n_venues, count(*) AS n_contracts FROM adapter_contract WHERE outcome_label IS NOT NULL GROUP BY 1 HAVING count(DISTINCT outcome_label) > 1""")
def collision_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.collisions(table(spark, folder, "adapter_contract").filter("outcome_label is not null"), F.lower(F.trim("outcome_label")), "outcome_label", "exchange_id")


@_query("""SELECT exchange_id, count(DISTINCT exchange_event_native_id) AS n_events, count(*) AS n_contracts, round(min(event_volume), 2) AS min_volume, round(max(event_volume), 2) AS max_volume,
round(sum(event_volume)::DECIMAL(38,2), 2)::DOUBLE AS total_volume, count(*) FILTER (WHERE event_volume IS NULL) AS n_unknown FROM adapter_contract GROUP BY exchange_id""".replace("sum(event_volume)::DECIMAL(38,2)", "sum(event_volume::DECIMAL(20,2))"))
def fetch_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.fetch_summary(table(spark, folder, "adapter_contract"))


@_query("""SELECT upper(trim(relationship_type)) AS relationship_type, method, count(*) AS n, count(DISTINCT security_id_a) AS n_a FROM contract_relationship GROUP BY ALL""")
def relationship_counts(spark: SparkSession, folder: str) -> DataFrame:
    rel = table(spark, folder, "contract_relationship").withColumn("relationship_type", F.upper(F.trim("relationship_type")))
    return rel.groupBy("relationship_type", "method").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("security_id_a").alias("n_a"))


@_query("""WITH c AS (SELECT category, event_id, title, row_number() OVER (PARTITION BY category ORDER BY event_id) rk, count(*) OVER (PARTITION BY category) n FROM sm_event)
SELECT category, string_agg(coalesce(title, '?'), chr(10) ORDER BY rk) FILTER (WHERE rk <= 20) || CASE WHEN max(n) > 20 THEN chr(10) || '... and ' || (max(n) - 20)::VARCHAR || ' more' ELSE '' END AS body, max(n) AS n FROM c GROUP BY category""")
def top20_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sections(table(spark, folder, "sm_event"), "category", "event_id", "title", 20)


@_query("""WITH m AS (SELECT feed_pos, title, slug, endDate AS e_end, description AS e_desc, tags[1].label AS category, list_filter(markets, lambda x: x IS NOT NULL AND NOT coalesce(x.closed, false)) AS ms FROM polymarket_events),
x AS (SELECT *, list_bool_and(list_transform(ms, lambda y: coalesce(y.negRisk, false))) AS one_of FROM m WHERE len(ms) > 0),
u AS (SELECT * EXCLUDE (ms), unnest(ms) AS k FROM x),
j AS (SELECT *, CASE WHEN json_valid(k.clobTokenIds) AND json_type(k.clobTokenIds) = 'ARRAY' THEN from_json(k.clobTokenIds, '["VARCHAR"]') END AS ts,
  CASE WHEN json_valid(k.outcomes) AND json_type(k.outcomes) = 'ARRAY' THEN from_json(k.outcomes, '["VARCHAR"]') END AS os FROM u WHERE coalesce(k.conditionId, '') <> '')
SELECT k.conditionId || ':' || ts[1] AS exchange_security_id, coalesce(nullif(k.groupItemTitle, ''), k.question) AS outcome_label, slug AS exchange_event_native_id, coalesce(k.endDate, e_end) AS event_expiry, category AS event_category
FROM j WHERE one_of AND len(ts) > 0
UNION ALL SELECT k.conditionId || ':' || ts[i], os[i], k.conditionId, coalesce(nullif(k.endDate, ''), e_end), category
FROM j, range(1, 1 + least(len(os), len(ts))) r(i) WHERE NOT one_of AND os IS NOT NULL AND ts IS NOT NULL""")
def venue_a_contracts(spark: SparkSession, folder: str) -> DataFrame:
    rows = feeds.venue_a(table(spark, folder, "polymarket_events"))
    return rows.select("exchange_security_id", "outcome_label", "exchange_event_native_id", "event_expiry", "event_category")


# the pipeline, from the state that the snapshot before implies

_ISO = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}Z)?$"
_SLUG = "regexp_replace(trim(regexp_replace(lower({0}), '[^a-z0-9\\s]', '', 'g')), '\\s+', '-', 'g')"
_SYMBOL = f"upper(concat_ws('-', left({_SLUG.format('{0}')}, 80), strftime({{1}}, '%Y%m%dT%H'), {_SLUG.format('{2}')}))"


def _batch(spark: SparkSession, folder: str, back: int) -> DataFrame:
    """A snapshot's contracts; expiries only where they are plain instants or days in UTC."""
    cols = ("event_title", "outcome_label", "exchange_event_native_id", "event_category", "event_description", "event_expiry", "ingest_pos", "base_currency", "quote_currency", "settle_currency", *_SPECS)
    return _snap(spark, folder, back, cols).withColumn("event_expiry", F.when(F.col("event_expiry").rlike(_ISO), F.col("event_expiry")))


def _state(spark: SparkSession, folder: str) -> pipeline.State:
    """What would be stored after the snapshot before the last: every native event an event of its own, its first contract in order standing for it."""
    rows, _, groups = pipeline.prepare(_batch(spark, folder, 1), spark.createDataFrame([], "exchange_id long, native_id string, event_id long"))
    events = groups.select(F.col("pos").alias("event_id"), F.col("event_title").alias("title"), F.col("event_description").alias("description"), F.col("event_category").alias("category"), "expiry", F.lit(False).alias("resolved"), *changes.NATIVE)
    named = rows.join(events.select(*changes.NATIVE, "event_id", "title"), changes.NATIVE).withColumn("symbol", S.security_symbol(F.col("title"), F.col("outcome_label"), F.col("expiry")))
    securities = named.groupBy("symbol").agg(F.min("pos").alias("security_id"))
    owned = named.join(securities, "symbol")
    links = owned.groupBy("event_id", "security_id").agg(F.min_by("outcome_label", "pos").alias("outcome_label"))
    listings = owned.select(*pipeline.LISTING, "native_id", "security_id", F.lit(True).alias("active"))
    currencies = rows.select(F.explode(F.array("base_currency", "quote_currency", "settle_currency")).alias("symbol")).filter("symbol is not null").distinct()
    return pipeline.State(events.drop(*changes.NATIVE), events.select(*changes.NATIVE, "event_id"), securities, listings, links, currencies, rows.select(*pipeline.LISTING, *_SPECS))


def _batch_sql(name: str, snap: str) -> str:
    expiry = f"CASE WHEN regexp_matches(event_expiry, '{_ISO}') THEN try_cast(replace(event_expiry, 'Z', '') AS TIMESTAMP) END"
    return f"{name} AS (SELECT * EXCLUDE (event_expiry), exchange_event_native_id AS native_id, {expiry} AS expiry FROM {snap} WHERE exchange_event_native_id IS NOT NULL AND event_title IS NOT NULL)"


_SAME = "{0}.title = {1}.title AND CASE WHEN {0}.expiry IS NULL AND {1}.expiry IS NULL THEN true WHEN {0}.expiry IS NULL OR {1}.expiry IS NULL THEN false ELSE abs(epoch_us({0}.expiry) - epoch_us({1}.expiry)) <= 3600000000 END"
_FIRST = "(SELECT exchange_id, native_id, min(ingest_pos) AS pos, arg_min(struct_pack(a := event_title, b := expiry), ingest_pos) AS f FROM {0} GROUP BY ALL)"
_NEAR = "list_filter(ldr, lambda x: (x.v IS NULL AND {0}.v IS NULL) OR coalesce(abs(x.v - {0}.v) <= 3600000000, false))"
_PIPELINE = f"""WITH RECURSIVE {_snap_sql('p0', 1)}, {_snap_sql('c0', 0)}, {_batch_sql('p', 'p0')}, {_batch_sql('c', 'c0')},
ev AS (SELECT exchange_id, native_id, pos AS event_id, f.a AS title, f.b AS expiry FROM {_FIRST.format('p')}),
ps AS (SELECT p.*, ev.event_id, ev.title, {_SYMBOL.format('ev.title', 'p.expiry', 'p.outcome_label')} AS symbol FROM p JOIN ev USING (exchange_id, native_id)),
sec AS (SELECT symbol, min(ingest_pos) AS security_id FROM ps GROUP BY symbol),
lk AS (SELECT DISTINCT event_id, security_id FROM ps JOIN sec USING (symbol)),
g AS (SELECT exchange_id, native_id, pos, f.a AS title, f.b AS expiry FROM {_FIRST.format('c')}),
n AS (SELECT g.* FROM g ANTI JOIN ev USING (exchange_id, native_id)),
same AS (SELECT n.pos, min(ev.event_id) AS event_id FROM n JOIN ev ON {_SAME.format('n', 'ev')} GROUP BY n.pos),
fr AS (SELECT n.*, epoch_us(n.expiry) AS t FROM n ANTI JOIN same USING (pos)),
o AS (SELECT k, v, p, row_number() OVER (PARTITION BY k ORDER BY p) rn FROM (SELECT title AS k, t AS v, min(pos) AS p FROM fr GROUP BY ALL)),
r AS (SELECT k, rn, [{{'p': p, 'v': v}}] AS ldr FROM o WHERE rn = 1 UNION ALL
  SELECT o.k, o.rn, CASE WHEN len({_NEAR.format('o')}) > 0 THEN r.ldr ELSE list_append(r.ldr, {{'p': o.p, 'v': o.v}}) END FROM r JOIN o ON o.k = r.k AND o.rn = r.rn + 1),
f AS (SELECT k, arg_max(ldr, rn) AS ldr FROM r GROUP BY k),
led AS (SELECT o.k, o.v, ({_NEAR.format('o')})[1].p AS leader FROM o JOIN f ON f.k = o.k),
nev AS (SELECT leader, row_number() OVER (ORDER BY leader) + (SELECT max(event_id) FROM ev) AS event_id FROM (SELECT DISTINCT leader FROM led)),
addd AS (SELECT fr.exchange_id, fr.native_id, fr.title, nev.event_id FROM fr JOIN led ON led.k = fr.title AND led.v IS NOT DISTINCT FROM fr.t JOIN nev ON nev.leader = led.leader
  UNION ALL SELECT n.exchange_id, n.native_id, n.title, same.event_id FROM n JOIN same USING (pos)),
ww AS (SELECT * FROM addd UNION ALL SELECT g.exchange_id, g.native_id, ev.title, ev.event_id FROM g JOIN ev USING (exchange_id, native_id)),
fu AS (SELECT c.*, ww.event_id, ww.title, {_SYMBOL.format('ww.title', 'c.expiry', 'c.outcome_label')} AS symbol FROM c JOIN ww USING (exchange_id, native_id)),
ns AS (SELECT symbol, row_number() OVER (ORDER BY symbol) + (SELECT max(security_id) FROM sec) AS security_id FROM (SELECT DISTINCT symbol FROM fu) x ANTI JOIN sec USING (symbol)),
ow AS (SELECT fu.*, a.security_id FROM fu JOIN (SELECT symbol, security_id FROM sec UNION ALL SELECT * FROM ns) a USING (symbol)),
spec AS (SELECT c.exchange_id, c.exchange_security_id, CASE WHEN p.exchange_id IS NULL THEN 'new' ELSE 'update' END AS action FROM c LEFT JOIN p USING (exchange_id, exchange_security_id)
  WHERE p.exchange_id IS NULL OR """ + " OR ".join(f"trunc(c.{x} * 1e9)::BIGINT IS DISTINCT FROM trunc(p.{x} * 1e9)::BIGINT" for x in _SPECS) + ")"


@_query(f"""{_PIPELINE}
SELECT 'event' AS kind, event_id::VARCHAR AS id, leader::VARCHAR AS key FROM nev
UNION ALL SELECT 'venue_event', event_id::VARCHAR, exchange_id::VARCHAR || ':' || native_id FROM addd
UNION ALL SELECT 'security', security_id::VARCHAR, symbol FROM ns
UNION ALL SELECT 'listing', security_id::VARCHAR, exchange_id::VARCHAR || ':' || exchange_security_id FROM ow ANTI JOIN p USING (exchange_id, exchange_security_id)
UNION ALL SELECT DISTINCT 'link', security_id::VARCHAR, event_id::VARCHAR FROM ow ANTI JOIN lk USING (event_id, security_id)
UNION ALL SELECT DISTINCT 'currency', '', s FROM (SELECT unnest([base_currency, quote_currency, settle_currency]) AS s FROM c) WHERE s IS NOT NULL AND s NOT IN (SELECT unnest([base_currency, quote_currency, settle_currency]) FROM p)
UNION ALL SELECT 'spec', action, exchange_id::VARCHAR || ':' || exchange_security_id FROM spec
UNION ALL SELECT 'stale', '', exchange_id::VARCHAR || ':' || exchange_security_id FROM p WHERE EXISTS (SELECT 1 FROM c WHERE c.exchange_id = p.exchange_id AND c.native_id = p.native_id)
  AND NOT EXISTS (SELECT 1 FROM c WHERE c.exchange_id = p.exchange_id AND c.exchange_security_id = p.exchange_security_id)""")
def entity_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that the last snapshot adds to the state after the one before: (kind, id, key)."""
    out = pipeline.resolve_contracts(_batch(spark, folder, 0), _state(spark, folder), pipeline.EngineConfig())
    listing = F.concat_ws(":", F.col("exchange_id").cast("string"), "exchange_security_id")
    rows = lambda df, kind, id_, key: df.select(F.lit(kind).alias("kind"), id_.cast("string").alias("id"), key.cast("string").alias("key"))
    parts = [
        rows(out.events.join(out.venue_events.join(_batch(spark, folder, 0).groupBy("exchange_id", F.col("exchange_event_native_id").alias("native_id")).agg(F.min(F.when(F.col("event_title").isNotNull(), F.col("ingest_pos"))).alias("first")), changes.NATIVE).groupBy("event_id").agg(F.min("first").alias("first")), "event_id"), "event", F.col("event_id"), F.col("first")),
        rows(out.venue_events, "venue_event", F.col("event_id"), F.concat_ws(":", F.col("exchange_id").cast("string"), "native_id")),
        rows(out.securities, "security", F.col("security_id"), F.col("symbol")),
        rows(out.listings, "listing", F.col("security_id"), listing),
        rows(out.links, "link", F.col("security_id"), F.col("event_id")),
        rows(out.currencies, "currency", F.lit(""), F.col("symbol")),
        rows(out.specs, "spec", F.col("action"), listing),
        rows(out.stale_listings, "stale", F.lit(""), listing),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


_VECTORS = """v AS (SELECT event_id, embedding::DOUBLE[] AS e FROM event_embedding WHERE event_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY embedded_at DESC NULLS LAST) = 1),
u AS (SELECT event_id, e FROM v WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0 AND event_id NOT IN (SELECT event_id FROM sm_event WHERE resolved)),
np AS (SELECT a.event_id AS q, b.event_id AS c, list_cosine_similarity(a.e, b.e) AS sim FROM u a JOIN u b ON a.event_id <> b.event_id),
nr AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, c) AS rk FROM np),
lc AS (SELECT event_id, security_id, coalesce(outcome_label, '') AS outcome_label FROM sm_security WHERE event_id IS NOT NULL AND event_id NOT IN (SELECT event_id FROM sm_event WHERE resolved)),
cand AS (SELECT least(q, c) AS a, greatest(q, c) AS b, max(sim) AS sim FROM nr WHERE rk <= 10 AND sim >= 0.85 AND q IN (SELECT event_id FROM lc) AND c IN (SELECT event_id FROM lc) GROUP BY ALL)"""


def _sound_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The latest sound vector of every unresolved event."""
    v = table(spark, folder, "event_embedding").filter("event_id is not null").groupBy("event_id").agg(F.max_by("embedding", F.struct(F.col("embedded_at").isNotNull(), "embedded_at")).alias("embedding"))
    sound = (F.size("embedding") == 64) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return v.filter(F.coalesce(sound, F.lit(False))).join(lookups.unresolved(table(spark, folder, "sm_event")).select("event_id"), "event_id", "left_semi")


def _links(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sm_security").filter("event_id is not null").select("event_id", "security_id", "outcome_label")


_NEIGHBOURS = pipeline.EngineConfig(neighbours=10, allowed_categories=("Politics", "Sports"))


@_query(f"""WITH {_VECTORS} SELECT cand.a, cand.b, round(sim, 6) AS sim FROM cand JOIN sm_event x ON x.event_id = a JOIN sm_event y ON y.event_id = b
WHERE (coalesce(x.category, '') IN ('', 'Politics', 'Sports')) OR (coalesce(y.category, '') IN ('', 'Politics', 'Sports'))""")
def semantic_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of unresolved events with close vectors of which a side's category is allowed."""
    events = table(spark, folder, "sm_event")
    open_links = lookups.open_contracts(_links(spark, folder), events)
    return pipeline.candidate_pairs(_sound_vectors(spark, folder), events, open_links, _NEIGHBOURS).withColumn("sim", F.round("sim", 6))


@_query(f"""WITH {_VECTORS}, nw AS (SELECT event_id FROM sm_event WHERE expiry IS NULL AND coalesce(category, '') IN ('', 'Politics', 'Sports'))
SELECT a, b, round(sim, 6) AS sim FROM cand WHERE a IN (SELECT event_id FROM nw) OR b IN (SELECT event_id FROM nw)""")
def semantic_candidates_of_new(spark: SparkSession, folder: str) -> DataFrame:
    """The same, started from given events only: those without expiry."""
    events = table(spark, folder, "sm_event")
    open_links = lookups.open_contracts(_links(spark, folder), events)
    return pipeline.candidate_pairs(_sound_vectors(spark, folder), events, open_links, _NEIGHBOURS, events.filter("expiry is null")).withColumn("sim", F.round("sim", 6))


_SEMANTIC = f"""{_VECTORS}, {_COMPLEMENT},
pc AS (SELECT event_id, security_id, coalesce(outcome_label, '') AS label FROM (SELECT *, count(*) OVER (PARTITION BY event_id) n, row_number() OVER (PARTITION BY event_id ORDER BY security_id) rk FROM lc) WHERE n <> 2 OR rk = 1),
jd AS (SELECT x.security_id AS a, y.security_id AS b, round(sim, 4) AS conf FROM cand JOIN pc x ON x.event_id = cand.a JOIN pc y ON y.event_id = cand.b AND lower(y.label) = lower(x.label) WHERE x.label <> ''),
j2 AS (SELECT a, b, conf FROM jd UNION ALL SELECT b, a, conf FROM jd),
de AS (SELECT a, b, conf FROM j2 UNION ALL SELECT ca.other_id, cb.other_id, conf FROM j2 JOIN comp ca ON ca.security_id = a JOIN comp cb ON cb.security_id = b UNION ALL SELECT cb.other_id, ca.other_id, conf FROM j2 JOIN comp ca ON ca.security_id = a JOIN comp cb ON cb.security_id = b),
ex AS (SELECT security_id_a x, security_id_b y FROM contract_relationship WHERE method IS NULL OR method <> 'manual'), bl AS (SELECT x, y FROM ex UNION SELECT y, x FROM ex),
wr AS (SELECT a, b, max(conf) AS conf FROM de WHERE NOT EXISTS (SELECT 1 FROM bl WHERE bl.x = a AND bl.y = b) GROUP BY ALL)"""


@_query(f"""WITH {_SEMANTIC} SELECT a AS security_id_a, b AS security_id_b, 'EQUIVALENT' AS relationship_type, conf AS confidence, 'embedding' AS method FROM wr WHERE conf >= 0.9""")
def classified_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates judged offline (equal labels mean the same, at the pair's similarity), what follows by complements, without what is stored."""
    return _classified(spark, folder).relations


@_query(f"""WITH {_SEMANTIC} SELECT count(*) FILTER (WHERE conf >= 0.9) AS written, count(*) FILTER (WHERE conf < 0.9) AS skipped_low_confidence FROM wr""")
def classified_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(spark, folder).counts


def _classified(spark: SparkSession, folder: str) -> pipeline.Classified:
    events, rel = table(spark, folder, "sm_event"), table(spark, folder, "contract_relationship")
    open_links = lookups.open_contracts(_links(spark, folder), events)
    config = pipeline.EngineConfig(neighbours=10, least_confidence=0.9)
    pairs = pipeline.candidate_pairs(_sound_vectors(spark, folder), events, open_links, config)
    return pipeline.classify_semantic(pairs, events, open_links, rel, config, lambda asked: pipeline.label_judge(asked))


# lookups of stored state


@_query("SELECT security_id, symbol FROM sm_security WHERE active AND type <> 5 UNION ALL SELECT -security_id, symbol FROM sm_security WHERE active AND contract_type <> 3")
def tradeable_securities(spark: SparkSession, folder: str) -> DataFrame:
    """Active securities of other types than event contracts (the table holds none), and by the same filter those that are not of several outcomes."""
    s = table(spark, folder, "sm_security")
    by_contract = lookups.tradeable(s.withColumn("type", F.col("contract_type")), 3)
    return lookups.tradeable(s).select("security_id", "symbol").unionByName(by_contract.select((-F.col("security_id")).alias("security_id"), "symbol"))


_OPEN = "(SELECT event_id FROM sm_event WHERE NOT coalesce(resolved, false))"


@_query(f"SELECT event_id, security_id FROM sm_security WHERE event_id IN {_OPEN}")
def open_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.open_contracts(_links(spark, folder), table(spark, folder, "sm_event")).select("event_id", "security_id")


_INACTIVE = "(SELECT security_id FROM sm_security WHERE NOT active)"


@_query(f"SELECT DISTINCT event_id, event_id IN {_OPEN} AS open FROM sm_security WHERE event_id IS NOT NULL AND security_id IN {_INACTIVE}")
def events_of_securities(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the inactive securities, and which of them are unresolved."""
    events, off = table(spark, folder, "sm_event"), table(spark, folder, "sm_security").filter("not active")
    open_ = lookups.open_events_of(_links(spark, folder), events, off).withColumn("_o", F.lit(True))
    return lookups.events_of(_links(spark, folder), off).join(open_, "event_id", "left").select("event_id", F.coalesce("_o", F.lit(False)).alias("open"))


@_query("SELECT DISTINCT security_id FROM sm_security WHERE event_id IN (SELECT event_id FROM sm_event WHERE resolved)")
def securities_of_events(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.securities_of(_links(spark, folder), table(spark, folder, "sm_event").filter("resolved"))


@_query("""SELECT event_id, title, coalesce(nullif(category, ''), 'OTHER') AS category, coalesce(array_to_string(list_filter(tags, lambda x: x IS NOT NULL), '|'), '') AS tags FROM sm_event
WHERE event_id IN (SELECT event_id FROM event_embedding)""")
def event_info(spark: SparkSession, folder: str) -> DataFrame:
    info = lookups.event_info(table(spark, folder, "sm_event"), table(spark, folder, "event_embedding"))
    return info.withColumn("tags", F.array_join("tags", "|"))


@_query("SELECT event_id, title, description, resolved, date_created FROM sm_event WHERE event_id IN (SELECT event_id FROM event_embedding WHERE embedding IS NULL)")
def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.event_rows(table(spark, folder, "sm_event"), table(spark, folder, "event_embedding").filter("embedding is null")).select("event_id", "title", "description", "resolved", "date_created")


@_query(f"""WITH {_snap_sql('p', 1)}, {_snap_sql('c', 0)}, s AS (SELECT exchange_id, exchange_event_native_id AS native_id, max(ingest_pos) AS event_id FROM p GROUP BY ALL),
a AS (SELECT exchange_id, exchange_event_native_id AS native_id, max(CASE WHEN ingest_pos % 2 = 0 THEN 0 ELSE -ingest_pos END) AS event_id FROM adapter_contract GROUP BY ALL)
SELECT DISTINCT c.exchange_id, c.exchange_event_native_id AS native_id, coalesce(nullif(a.event_id, 0), s.event_id) AS event_id FROM c
LEFT JOIN a ON a.exchange_id = c.exchange_id AND a.native_id = c.exchange_event_native_id LEFT JOIN s ON s.exchange_id = c.exchange_id AND s.native_id = c.exchange_event_native_id""")
def cached_or_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Events of native keys from a cache (half of whose entries say nothing), else from the snapshot before."""
    at = F.col("pos")
    cache = _feed(table(spark, folder, "adapter_contract")).select(*changes.NATIVE, F.when(at % 2 == 0, 0).otherwise(-at).alias("event_id"))
    stored = _feed(_snap(spark, folder, 1)).select(*changes.NATIVE, at.alias("event_id"))
    return lookups.cached_or_stored(_feed(_snap(spark, folder, 0)), cache, stored, changes.NATIVE, "event_id")


@_query(f"""WITH {_snap_sql('p', 1)}, v AS (SELECT DISTINCT exchange_id, exchange_event_native_id AS native_id, 1 + abs(ingest_pos) % 600 AS event_id FROM p) SELECT * FROM v WHERE event_id IN {_OPEN}""")
def open_venue_events(spark: SparkSession, folder: str) -> DataFrame:
    """Native events of the snapshot before, hung under the stored events by number, whose event is unresolved."""
    v = _snap(spark, folder, 1).select("exchange_id", F.col("exchange_event_native_id").alias("native_id"), (1 + F.abs("ingest_pos") % 600).alias("event_id")).distinct()
    return lookups.open_venue_events(v, table(spark, folder, "sm_event"))


@_query("""WITH l AS (SELECT DISTINCT a.event_id, r.security_id_b AS security_id FROM contract_relationship r JOIN sm_security a ON a.security_id = r.security_id_a WHERE a.event_id IS NOT NULL AND r.security_id_b IS NOT NULL)
SELECT * FROM l ANTI JOIN sm_security USING (event_id, security_id)""")
def new_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links that relations would add: the other end under the first one's event."""
    ev = _links(spark, folder).select("event_id", F.col("security_id").alias("security_id_a"))
    links = table(spark, folder, "contract_relationship").filter("security_id_b is not null").select("security_id_a", F.col("security_id_b").alias("security_id")).join(ev, "security_id_a").select("event_id", "security_id").distinct()
    return lookups.new_links(links, _links(spark, folder))


@_query("SELECT security_id_a AS security_id FROM contract_relationship WHERE security_id_a IS NOT NULL UNION SELECT security_id_b FROM contract_relationship WHERE security_id_b IS NOT NULL")
def united_ids(spark: SparkSession, folder: str) -> DataFrame:
    rel = table(spark, folder, "contract_relationship")
    side = lambda c: rel.filter(F.col(c).isNotNull()).select(F.col(c).alias("security_id"))
    return lookups.united_ids(side("security_id_a"), side("security_id_b"))


@_query("""WITH m AS (SELECT relationship_id, security_id_a AS id, upper(trim(relationship_type)) AS name FROM contract_relationship WHERE security_id_a IS NOT NULL), l AS (SELECT id, arg_max(name, relationship_id) AS name FROM m WHERE name IS NOT NULL GROUP BY id)
SELECT m.relationship_id, m.id, l.name FROM m LEFT JOIN l USING (id)""")
def message_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of messages in order, repeated ones as often as they come, with the name that the last message gives them."""
    rel = table(spark, folder, "contract_relationship").select("relationship_id", F.col("security_id_a").alias("id"), F.upper(F.trim("relationship_type")).alias("name"))
    names = lookups.latest_names(rel.filter("id is not null and name is not null"), "id", "name", "relationship_id")
    return lookups.ids_in_order(rel, "id", "relationship_id").join(names, "id", "left").select("relationship_id", "id", "name")


@_query("""SELECT s.security_id, e.event_id AS created_event_id, e.title AS created_event_name FROM sm_security s LEFT JOIN (SELECT * FROM sm_event WHERE expiry IS NULL) e ON e.event_id = s.event_id""")
def enriched_securities(spark: SparkSession, folder: str) -> DataFrame:
    """Securities with the created event they belong to (taken as created: events without expiry)."""
    created = table(spark, folder, "sm_event").filter("expiry is null").select("event_id", "title")
    return lookups.enrich_new(table(spark, folder, "sm_security").select("security_id"), _links(spark, folder), created)


@_query("""WITH l AS (SELECT event_id, outcome_label, max(security_id) AS s FROM sm_security WHERE event_id IS NOT NULL GROUP BY ALL), e AS (SELECT security_id, event_id, outcome_label FROM sm_security WHERE event_id IS NOT NULL),
j AS (SELECT r.*, a.event_id AS ea, b.event_id AS eb, a.outcome_label AS la, b.outcome_label AS lb, upper(trim(relationship_type)) AS t FROM contract_relationship r JOIN e a ON a.security_id = r.security_id_a JOIN e b ON b.security_id = r.security_id_b),
k AS (SELECT x.s AS a, y.s AS b, t, confidence, relationship_id % 3 AS d FROM j JOIN l x ON x.event_id = ea AND x.outcome_label = la JOIN l y ON y.event_id = eb AND y.outcome_label = lb WHERE t IN ('EQUIVALENT','IMPLIES','MUTUALLY_EXCLUSIVE','HEDGEABLE_WITH'))
SELECT a AS security_id_a, b AS security_id_b, t AS relationship_type, confidence FROM k WHERE t <> 'IMPLIES' OR d <> 1 UNION ALL SELECT b, a, t, confidence FROM k WHERE t <> 'IMPLIES' OR d = 1""")
def cached_relations(spark: SparkSession, folder: str) -> DataFrame:
    """Stored relations as a cache would hold them, by labels in either orientation, back to securities."""
    ends = _links(spark, folder)
    rel = table(spark, folder, "contract_relationship").join(ends.toDF("event_a", "security_id_a", "la"), "security_id_a").join(ends.toDF("event_b", "security_id_b", "lb"), "security_id_b")
    first = F.col("relationship_id") % 2 == 0
    rel = rel.withColumns({"pair_id": F.col("relationship_id").cast("string"), "a_first": first, "direction": F.when(F.col("relationship_id") % 3 == 1, "B_IMPLIES_A").when(F.col("relationship_id") % 3 == 0, "A_IMPLIES_B")})
    items = rel.select("pair_id", F.when(first, F.col("la")).otherwise(F.col("lb")).alias("first_label"), F.when(first, F.col("lb")).otherwise(F.col("la")).alias("second_label"), F.col("relationship_type").alias("type"), "confidence", "direction")
    return relations.cached_relations(items, ends, rel.select("pair_id", "event_a", "event_b", "a_first"))


_KEYS = """k AS (SELECT * FROM (VALUES ('harbour', 1), ('mayor', 2), ('vaccine', 3)) t(keyword, keyword_security_id)),
h AS (SELECT DISTINCT s.security_id AS a, k.keyword_security_id AS b FROM k JOIN (SELECT s.security_id, e.title || ' ' || coalesce(s.outcome_label, '') AS text FROM sm_security s JOIN sm_event e USING (event_id)) s ON regexp_matches(lower(s.text), '\\b' || k.keyword || '\\b')),
ex AS (SELECT security_id_a x, security_id_b y FROM contract_relationship WHERE method IS NULL OR method <> 'manual'), bl AS (SELECT x, y FROM ex UNION SELECT y, x FROM ex)"""


@_query(f"""WITH {_KEYS} SELECT a AS security_id_a, b AS security_id_b, 'HEDGEABLE_WITH' AS relationship_type, 1.0::DOUBLE AS confidence, 'rule' AS method FROM h WHERE NOT EXISTS (SELECT 1 FROM bl WHERE bl.x = a AND bl.y = b) AND a IN (SELECT security_id FROM sm_security WHERE active)""")
def structural_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword relations of the active securities (taken as new) that are not stored."""
    words = spark.createDataFrame([("harbour", 1), ("mayor", 2), ("vaccine", 3)], "keyword string, keyword_security_id long")
    s = table(spark, folder, "sm_security")
    texts = s.join(table(spark, folder, "sm_event").select("event_id", "title"), "event_id").select("security_id", F.concat_ws(" ", "title", "outcome_label").alias("text"))
    new = s.filter("active").select("security_id")
    # a keyword's own security is new too, so the contract's side decides alone
    return pipeline.classify_structural(texts.join(new, "security_id", "left_semi"), words, table(spark, folder, "contract_relationship"), pipeline.EngineConfig()).relations


@_query("""WITH m AS (SELECT security_id_a, security_id_b, max(confidence) AS c FROM contract_relationship WHERE method = 'embedding' AND security_id_a IS NOT NULL AND security_id_b IS NOT NULL AND confidence IS NOT NULL
  AND (security_id_a IN (SELECT security_id FROM sm_security WHERE NOT active) OR security_id_b IN (SELECT security_id FROM sm_security WHERE NOT active)) GROUP BY ALL),
x AS (SELECT security_id_a p, security_id_b q FROM contract_relationship WHERE method = 'rule'), k AS (SELECT p, q FROM x UNION SELECT q, p FROM x)
SELECT count(*) FILTER (WHERE c >= 0.8) AS written, count(*) FILTER (WHERE c < 0.8) AS skipped_low_confidence FROM m WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.p = m.security_id_a AND k.q = m.security_id_b)""")
def write_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many relations of the inactive securities would be written and how many are too uncertain."""
    rel = table(spark, folder, "contract_relationship")
    new = rel.filter("method = 'embedding' and security_id_a is not null and security_id_b is not null and confidence is not null")
    side = table(spark, folder, "sm_security").filter("not active")
    return relations.write_counts(new.select("security_id_a", "security_id_b", "relationship_type", "confidence", "relationship_id"), rel.filter("method = 'rule'"), "relationship_id", 0.8, side)


@_query("""SELECT event_id, 'k' || event_id || ': v ' || coalesce(category, '?') AS text, trim('v ' || coalesce(category, '?')) AS value FROM sm_event""")
def described_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values out of ``key:value`` descriptions."""
    e = table(spark, folder, "sm_event").select("event_id", F.concat(F.lit("k"), F.col("event_id").cast("string"), F.lit(": v "), F.coalesce("category", F.lit("?"))).alias("text"))
    return e.select("event_id", "text", F.try_element_at(S.key_values(F.concat(F.lit("class:x|"), "text")), F.concat(F.lit("k"), F.col("event_id").cast("string"))).alias("value"))


@_query("""SELECT upper(trim(relationship_type)) AS kind, count(DISTINCT security_id_a) AS n, array_to_string(list_sort(list(DISTINCT security_id_a))[1:1000], ', ') AS "values" FROM contract_relationship WHERE security_id_a IS NOT NULL AND relationship_type IS NOT NULL GROUP BY 1""")
def listed_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids in order by type of relation, a thousand at most (the display's limit)."""
    rel = table(spark, folder, "contract_relationship").filter("relationship_type is not null")
    return reports.listed(rel.withColumn("kind", F.upper(F.trim("relationship_type"))), "kind", "security_id_a")


@_query("""WITH e AS (SELECT event_id, resolved FROM sm_event), s AS (SELECT security_id, event_id, active FROM sm_security WHERE event_id IS NOT NULL), off AS (SELECT security_id FROM sm_security WHERE active AND security_id IN (SELECT security_id_a FROM contract_relationship WHERE method = 'rule')),
dead AS (SELECT DISTINCT event_id FROM s JOIN off USING (security_id) WHERE event_id NOT IN (SELECT event_id FROM s WHERE active AND security_id NOT IN (SELECT security_id FROM off)) AND event_id IN (SELECT event_id FROM e WHERE NOT resolved))
SELECT 'security' AS kind, security_id AS id, active AND security_id NOT IN (SELECT security_id FROM off) AS state FROM sm_security UNION ALL SELECT 'event', event_id, coalesce(resolved, false) OR event_id IN (SELECT event_id FROM dead) FROM sm_event
UNION ALL SELECT 'resolved now', event_id, true FROM sm_event WHERE resolved_at IS NULL AND event_id IN (SELECT event_id FROM dead) UNION ALL SELECT 'vector', event_id, true FROM event_embedding WHERE event_id NOT IN (SELECT event_id FROM dead)""")
def resolved_state(spark: SparkSession, folder: str) -> DataFrame:
    """Securities, events and vectors after what a venue reports as resolved: the securities that rules relate to others, each its own listing."""
    s, e = table(spark, folder, "sm_security"), table(spark, folder, "sm_event")
    listings = s.filter("active").select(F.lit(1).cast("long").alias("exchange_id"), F.col("security_id").cast("string").alias("exchange_security_id"), "security_id", F.lit(True).alias("active"))
    hit = table(spark, folder, "contract_relationship").filter("method = 'rule' and security_id_a is not null").select(F.lit(1).cast("long").alias("exchange_id"), F.col("security_id_a").cast("string").alias("native_id"))
    links = s.filter("event_id is not null").select("event_id", "security_id")
    out = lifecycle.resolve_ids(listings, s, links, e, hit)
    at = F.lit("2026-06-01 00:00:00").cast("timestamp_ntz")
    off, done, vectors_ = lifecycle.apply_cascade(out, s, e, table(spark, folder, "event_embedding"), at)
    rows = lambda df, kind, id_, state: df.select(F.lit(kind).alias("kind"), F.col(id_).alias("id"), state.alias("state"))
    return (
        rows(off, "security", "security_id", F.col("active")).unionByName(rows(done, "event", "event_id", F.col("resolved")))
        .unionByName(rows(done.filter(F.col("resolved_at") == at), "resolved now", "event_id", F.lit(True))).unionByName(rows(vectors_, "vector", "event_id", F.lit(True)))
    )


@_query("""SELECT 'relations' AS name, count(*) AS n FROM contract_relationship UNION ALL SELECT 'relations_set', count(*) FILTER (WHERE security_id_a IS NOT NULL) FROM contract_relationship UNION ALL SELECT 'events', count(*) FROM sm_event""")
def counters(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.counters({"relations": table(spark, folder, "contract_relationship"), "events": table(spark, folder, "sm_event")}, {"relations": {"set": F.col("security_id_a").isNotNull()}})


@_query("""WITH c AS (SELECT event_id, title, description, category, (row_number() OVER (PARTITION BY 1 ORDER BY event_id) - 1) // 15 AS chunk, (row_number() OVER (ORDER BY event_id) - 1) % 15 + 1 AS place FROM sm_event WHERE title IS NOT NULL)
SELECT chunk, string_agg(concat_ws(chr(9), place::VARCHAR, left(sha256(title), 6), coalesce(category, ''), title, left(coalesce(description, ''), 200)), chr(10) ORDER BY place) AS text FROM c GROUP BY chunk""")
def canonical_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of 15 titles each; places come from ids counted per partition, so no task sees all titles."""
    ev = table(spark, folder, "sm_event").filter("title is not null").select("event_id", "title", "description", "category")
    numbered = entities.with_ids(ev, spark.createDataFrame([(0,)], "nr long"), "nr", ["event_id"])
    return ports.canonical_prompt(numbered.select("title", "description", "category", F.floor((F.col("nr") - 1) / 15).alias("chunk"), ((F.col("nr") - 1) % 15 + 1).alias("place")))


@_query(r"""WITH n AS (SELECT event_id, CASE WHEN coalesce(description, '') <> '' THEN title || '. ' || left(description, 200) ELSE title END AS text FROM sm_event WHERE NOT coalesce(resolved, false) AND title IS NOT NULL
  AND event_id NOT IN (SELECT event_id FROM event_embedding WHERE embedding IS NOT NULL)),
w AS (SELECT event_id, md5(w) AS h FROM (SELECT event_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS w FROM n) WHERE w <> ''),
c AS (SELECT event_id, ('0x' || left(h, 8))::BIGINT % 64 AS i, CASE WHEN ('0x' || substr(h, 9, 1))::BIGINT < 8 THEN 1.0 ELSE -1.0 END AS s FROM w)
SELECT event_id, 64::BIGINT AS n, sum(s)::DOUBLE AS total, sum(s * (i + 1))::DOUBLE AS weighted FROM c GROUP BY event_id
UNION ALL SELECT event_id, len(embedding), NULL, NULL FROM event_embedding x WHERE x.event_id NOT IN (SELECT event_id FROM c)""")
def embeddings_completed(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors table with those of events that had none: length, and for the new ones two sums over the vector."""
    stored = table(spark, folder, "event_embedding")
    done = ports.embed_missing(table(spark, folder, "sm_event"), stored)
    had = stored.filter("embedding is not null").select("event_id", F.lit(True).alias("_had")).distinct()
    resolved = table(spark, folder, "sm_event").filter("resolved").select("event_id", F.lit(True).alias("_over"))
    both = done.join(had, "event_id", "left").join(resolved, "event_id", "left")
    made = F.col("_had").isNull() & F.col("_over").isNull() & F.col("embedding").isNotNull()
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double"))
    weighted = F.transform("embedding", lambda x, i: x * (i + 1))
    n = F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("long")
    return both.select("event_id", n.alias("n"), F.when(made, total(F.col("embedding"))).alias("total"), F.when(made, total(weighted)).alias("weighted"))


# stages of the command line: a folder of tables in, tables of what would be written out


def _stage_entities(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    out = pipeline.resolve_contracts(_batch(spark, folder, 0), _state(spark, folder), pipeline.EngineConfig())
    return {name: getattr(out, name) for name in ("events", "venue_events", "securities", "listings", "links", "currencies", "specs", "stale_listings")}


def _stage_classify(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    out = _classified(spark, folder)
    return {"relations": out.relations, "counts": out.counts, "cache": out.cache}


STAGES = {
    "entities": _stage_entities,
    "classify": _stage_classify,
    "resolve": lambda spark, folder: {"cascade": deactivation_cascade(spark, folder)},
    "stale": lambda spark, folder: dict(zip(("tracker", "stale"), _tracked(spark, folder), strict=True)),
}
