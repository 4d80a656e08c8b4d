"""Queries of the training-data operators over the project's tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions.text import strip_all
from weftline.llm.ann import exact_similar, most_similar
from weftline.llm.components import groups_of_pairs
from weftline.llm.leakage import leaked_items
from weftline.llm.linkage import copies, match_contracts
from weftline.llm.packing import pack_texts
from weftline.llm.sentences import sentence_units
from weftline.operators.snapshots import latest_copy
from weftline.session import cut, table, written


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Securities linked by EQUIVALENT judgements, each with its group's smallest security."""
    judged = table(spark, folder, "contract_relationship").select("security_id_a", "security_id_b", "relationship_type")
    same = judged.filter(F.upper(strip_all(F.col("relationship_type"))) == "EQUIVALENT")
    return groups_of_pairs(same, "security_id_a", "security_id_b").select(F.col("node").alias("security_id"), "group_id")


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The latest vector of every event."""
    return latest_copy(table(spark, folder, "event_embedding").filter("event_id is not null"), ["event_id"], ["embedding"], ["embedded_at"])


def _neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return most_similar(_vectors(spark, folder), "event_id", "embedding")


def p3_recall(spark: SparkSession, folder: str) -> DataFrame:
    """The graphs' answers for every event whose id is divisible by 50, held against all vectors by brute force: queries, exact neighbours, whether nine in ten of
    them were found, and whether 99 in 100 of those at 0.8 or more were."""
    vectors = _vectors(spark, folder)
    exact = exact_similar(vectors, "event_id", "embedding", vectors.filter("event_id % 50 = 0").select("event_id"))
    found = most_similar(vectors, "event_id", "embedding").select("q", "c", F.lit(1).alias("hit"))
    both = exact.join(found, ["q", "c"], "left")
    share = lambda c: F.sum(F.when(c, F.coalesce("hit", F.lit(0)))) / F.nullif(F.count_if(c), F.lit(0))
    near = F.col("sim") >= 0.8
    return both.agg(F.countDistinct("q").alias("n_queries"), F.count(F.lit(1)).alias("n_exact"), (share(F.lit(True)) >= 0.9).alias("enough"), (share(near) >= 0.99).alias("enough_near"))


def p3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten most similar other events of every event."""
    return _neighbours(spark, folder).select(F.col("q").alias("event_id"), F.col("c").alias("neighbour_id"), F.round("sim", 6).alias("sim"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of events with cosine 0.80 or more of which one is among the ten most similar of the other."""
    near = _neighbours(spark, folder).filter("sim >= 0.8")
    return near.select(F.least("q", "c").alias("event_id_a"), F.greatest("q", "c").alias("event_id_b")).distinct()


def _contracts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per contract of a venue: its latest delivery."""
    rows = table(spark, folder, "adapter_contract").filter("exchange_id is not null and exchange_security_id is not null")
    latest = latest_copy(rows, ["exchange_id", "exchange_security_id"], ["event_title", "outcome_label", "event_description", "event_expiry"], ["received_at", "ingest_pos"])
    return latest.select("exchange_id", F.col("exchange_security_id").alias("sid"), F.col("event_title").alias("title"), F.col("outcome_label").alias("label"), F.col("event_description").alias("description"), F.col("event_expiry").alias("expiry"))


def p5_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts of different venues that mean the same outcome, with a confidence; copies of a text at one venue through one of them."""
    return match_contracts(_contracts(spark, folder))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The matched contracts' ids, each pair once with the lower id first."""
    contracts = written(_contracts(spark, folder))
    pairs = match_contracts(contracts)
    member = copies(contracts)
    for side in ("a", "b"):
        own = member.select(F.col("exchange_id").alias(f"exchange_id_{side}"), F.col("head").alias(f"sid_{side}"), F.col("sid").alias(f"own_{side}"))
        pairs = pairs.join(own, [f"exchange_id_{side}", f"sid_{side}"])
    pairs = pairs.filter("own_a <> own_b")
    return pairs.select(F.least("own_a", "own_b").alias("exchange_security_id_a"), F.greatest("own_a", "own_b").alias("exchange_security_id_b")).distinct()


def p8_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in containers of every kind."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    packed = pack_texts(docs, "doc_id", "text", table(spark, folder, "container_size"), "container_kind", "capacity_tokens")
    return packed.drop("capacity").withColumnRenamed("item", "doc_id")


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Containers used and room left, by kind."""
    sizes = table(spark, folder, "container_size")
    used = p8_pack(spark, folder).filter("container_no > 0").groupBy("container_kind").agg(F.max("container_no").alias("containers"), F.sum("tokens").alias("tokens"))
    return used.join(sizes, "container_kind").select("container_kind", "containers", "tokens", (F.col("containers") * F.col("capacity_tokens") - F.col("tokens")).alias("slack"))


def p8_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What a packing must keep, by kind: documents packed, containers filled beyond their capacity, documents cut although they fit, tokens in other places than
    the pieces of a document say, and whether no two containers would fit into one."""
    sizes = table(spark, folder, "container_size")
    packed = cut(p8_pack(spark, folder))
    loads = packed.filter("container_no > 0").groupBy("container_kind", "container_no").agg(F.sum("tokens").alias("load")).join(sizes, "container_kind")
    full = loads.groupBy("container_kind").agg(F.count_if(F.col("load") > F.col("capacity_tokens")).alias("n_over"))
    least = loads.withColumn("rank", F.row_number().over(Window.partitionBy("container_kind").orderBy("load", "container_no"))).filter("rank <= 2")
    least = least.groupBy("container_kind").agg(((F.count(F.lit(1)) < 2) | (F.sum("load") > F.max("capacity_tokens"))).alias("tight"))
    docs = packed.groupBy("container_kind", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.max("piece_no").alias("last"), F.sum("tokens").alias("tokens")).join(sizes, "container_kind")
    whole = docs.groupBy("container_kind").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))).alias("n_cut_in_vain"), F.count_if(F.col("last") + 1 != F.col("pieces")).alias("n_odd")
    )
    return whole.join(full, "container_kind").join(least, "container_kind")


def p9_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the evaluation items they hold, and how much of each."""
    docs, items = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "eval_item").select("item_id", "text")
    return leaked_items(docs, "doc_id", "text", items, "item_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the evaluation items that they hold at least half of."""
    return p9_scores(spark, folder).select("doc_id", "item_id").distinct()


def p9_whole(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the items that stand in them word for word."""
    return p9_scores(spark, folder).filter("score > 1 - 1e-9").select("doc_id", "item_id").distinct()


def p10_cover(spark: SparkSession, folder: str) -> DataFrame:
    """Characters other than white space that the units of each document hold, and units that overlap the one before."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    units = p10_found(spark, folder).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sent_start", "sent_end"))).alias("u"))
    joined = docs.join(units, "doc_id")
    held = F.aggregate("u", F.lit(0), lambda s, x: s + F.length(F.regexp_replace(F.substring("text", x["sent_start"] + 1, x["sent_end"] - x["sent_start"]), r"(?U)\s|\ufeff", "")))
    overlaps = F.size(F.filter("u", lambda x, i: (i > 0) & (x["sent_start"] < F.get("u", i - 1)["sent_end"])))
    return joined.select("doc_id", held.alias("n_held"), overlaps.alias("n_overlaps"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sentence units of all documents by code point offsets."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    units = sentence_units(docs, ["doc_id"], "text", F.lower(F.trim("source")).isin("scan", "bulletin"), F.col("lang"))
    return units.select("doc_id", "sent_start", "sent_end")


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p3_neighbours": p3_neighbours, "p3_recall": p3_recall, "p5_found": p5_found, "p5_pairs": p5_pairs, "p8_pack": p8_pack, "p8_fill": p8_fill, "p8_checks": p8_checks, "p9_found": p9_found, "p9_scores": p9_scores, "p9_whole": p9_whole, "p10_found": p10_found, "p10_cover": p10_cover}

_NEAREST = """
WITH v AS (SELECT event_id, embedding::DOUBLE[] AS e FROM event_embedding WHERE event_id IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY embedded_at DESC NULLS LAST) = 1),
u AS (SELECT event_id, e FROM v WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.event_id AS q, b.event_id AS c, list_cosine_similarity(a.e, b.e) AS sim FROM u a JOIN u b ON a.event_id <> b.event_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, c) AS rk FROM p)"""

ORACLES = {
    "p1_found": r"""
WITH RECURSIVE e AS (
  SELECT DISTINCT security_id_a AS a, security_id_b AS b FROM contract_relationship
  WHERE upper(regexp_replace(relationship_type, '^\s+|\s+$', '', 'g')) = 'EQUIVALENT'
    AND security_id_a IS NOT NULL AND security_id_b IS NOT NULL AND security_id_a <> security_id_b),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS seen FROM s UNION SELECT r.node, s.b FROM r JOIN s ON r.seen = s.a)
SELECT node AS security_id, min(seen) AS group_id FROM r GROUP BY node
""",
    "p3_found": f"""{_NEAREST}
SELECT DISTINCT least(q, c) AS event_id_a, greatest(q, c) AS event_id_b FROM r WHERE rk <= 10 AND sim >= 0.8
""",
    "p3_recall": f"""{_NEAREST}
SELECT count(DISTINCT q) AS n_queries, count(*) AS n_exact, true AS enough, true AS enough_near FROM r WHERE q % 50 = 0 AND rk <= 10
""",
    "p8_checks": """
SELECT container_kind, (SELECT count(*) FROM documents) AS n_docs, 0::BIGINT AS n_cut_in_vain, 0::BIGINT AS n_odd, 0::BIGINT AS n_over, true AS tight FROM container_size
""",
    "p9_whole": r"""
WITH w AS (SELECT doc_id, ' ' || trim(regexp_replace(regexp_replace(lower(regexp_replace(text, '-\n[ \t]*', '', 'g')), '([぀-ヿ㐀-鿿豈-﫿])', ' \1 ', 'g'), '[^\p{L}\p{N}\p{M}]+', ' ', 'g')) || ' ' AS t FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, ' ' || trim(regexp_replace(regexp_replace(lower(text), '([぀-ヿ㐀-鿿豈-﫿])', ' \1 ', 'g'), '[^\p{L}\p{N}\p{M}]+', ' ', 'g')) || ' ' AS t FROM eval_item WHERE text IS NOT NULL)
SELECT DISTINCT doc_id, item_id FROM w JOIN i ON contains(w.t, i.t)
""",
    "p10_cover": r"""
SELECT doc_id, length(regexp_replace(text, '[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}\v]', '', 'g'))::INTEGER AS n_held, 0 AS n_overlaps FROM documents
WHERE length(regexp_replace(text, '[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}\v]', '', 'g')) > 0
""",
}
