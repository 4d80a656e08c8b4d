"""The relationship graph: candidates, judgements, derived edges, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions.scalars import strip_code_fences

TYPES = ("MUTUALLY_EXCLUSIVE", "EQUIVALENT", "IMPLIES", "HEDGEABLE_WITH")
SYMMETRIC = ("MUTUALLY_EXCLUSIVE", "EQUIVALENT", "HEDGEABLE_WITH")
JUDGE_SCHEMA = "array<struct<a:string,b:string,type:string,confidence:string,direction:string>>"


def siblings(links: DataFrame, securities: DataFrame) -> DataFrame:
    """Links of every event that holds any of the given securities."""
    events = links.join(securities.select("security_id").distinct(), "security_id", "left_semi").select("event_id").distinct()
    return links.join(events, "event_id", "left_semi")


def touching(relations: DataFrame, securities: DataFrame) -> DataFrame:
    """Relations with a given security on either side: two semi joins, not one OR join."""
    ids = securities.select("security_id").distinct()
    a = relations.join(ids.withColumnRenamed("security_id", "security_id_a"), "security_id_a", "left_semi")
    b = relations.join(ids.withColumnRenamed("security_id", "security_id_b"), "security_id_b", "left_semi")
    return a.unionByName(b).dropDuplicates(["relationship_id"])


def complement_map(links: DataFrame) -> DataFrame:
    """(security_id, other_id) of events with exactly two contracts; a security in several takes the highest event."""
    pairs = links.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.min("security_id").alias("a"), F.max("security_id").alias("b")).filter("n = 2 and a <> b")
    both = pairs.select("event_id", F.inline(F.array(F.struct(F.col("a").alias("security_id"), F.col("b").alias("other_id")), F.struct(F.col("b").alias("security_id"), F.col("a").alias("other_id")))))
    return both.groupBy("security_id").agg(F.max_by("other_id", "event_id").alias("other_id"))


def primary_contracts(links: DataFrame) -> DataFrame:
    """Of events with exactly two contracts the lower one; all of the others'."""
    w = Window.partitionBy("event_id")
    ranked = links.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("rk", F.row_number().over(w.orderBy("security_id")))
    return ranked.filter("n <> 2 or rk = 1").select("event_id", "security_id")


def keyword_pairs(contracts: DataFrame, keywords: DataFrame) -> DataFrame:
    """Contracts whose text holds a keyword or phrase as whole words.

    ``contracts``: security_id, text; ``keywords``: keyword, keyword_security_id. Case does not matter. The words of the texts meet the
    first words of the keywords by equality and phrases are then checked on the text, so no theta join is left.
    """
    word = r"(?U)(\w+)"
    texts = contracts.select("security_id", F.lower("text").alias("text"))
    words = texts.select("security_id", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(word), F.lit(1)))).alias("first"))
    keys = keywords.select(F.lower("keyword").alias("keyword"), "keyword_security_id").distinct().withColumn("first", F.regexp_extract("keyword", word, 1)).filter("first <> ''")
    holds = F.expr(r"text rlike concat('(?U)\\b\\Q', keyword, '\\E\\b')")
    return words.join(keys, "first").filter(holds).select("security_id", "keyword_security_id", "keyword").distinct()


def hedge_relations(contracts: DataFrame, keywords: DataFrame, confidence: float) -> DataFrame:
    """Keyword pairs as relations of the rules: each contract with the security that a keyword in its text stands for."""
    pairs = keyword_pairs(contracts, keywords)
    return pairs.select(
        F.col("security_id").alias("security_id_a"), F.col("keyword_security_id").alias("security_id_b"), F.lit("HEDGEABLE_WITH").alias("relationship_type"), F.lit(confidence).alias("confidence"), F.lit("rule").alias("method")
    ).distinct()


def parse_judgement(text: Column) -> Column:
    """Valid items of a response; null where it is no list, or an item's confidence is no number (one bad item voids all)."""
    items = F.from_json(strip_code_fences(text), JUDGE_SCHEMA)
    bad = F.exists(items, lambda x: x["confidence"].isNotNull() & x["confidence"].try_cast("double").isNull())
    return F.when(~bad, items)


def judged_pairs(responses: DataFrame, contracts: DataFrame, least: float = 0.7) -> DataFrame:
    """Judged relations of securities. ``responses``: pair_id, text; ``contracts``: pair_id, side ('a' or 'b'), place (from 1), security_id.

    Per (a, b) the most confident item counts, the first of equals (one without confidence ranks last); an unknown type, a place that
    does not exist or a confidence below ``least`` gives none. All types but IMPLIES are given in both directions.
    """
    items = responses.select("pair_id", F.posexplode(parse_judgement(F.col("text"))).alias("no", "x")).select(
        "pair_id", "no", F.col("x.a").try_cast("int").alias("pa"), F.col("x.b").try_cast("int").alias("pb"), F.upper(F.trim("x.type")).alias("relationship_type"), F.coalesce(F.col("x.confidence").try_cast("double"), F.lit(least)).alias("confidence"), F.coalesce(F.col("x.confidence").try_cast("double"), F.lit(0.0)).alias("rank"), F.upper("x.direction").alias("direction")
    )
    sound = items.filter(F.col("relationship_type").isin(*TYPES) & (F.col("confidence") >= least))
    best = sound.withColumn("rk", F.row_number().over(Window.partitionBy("pair_id", "pa", "pb").orderBy(F.desc("rank"), F.when(F.col("rank") == 0, -F.col("no")).otherwise(F.col("no"))))).filter("rk = 1")
    a = contracts.filter("side = 'a'").select("pair_id", F.col("place").alias("pa"), F.col("security_id").alias("security_id_a"))
    b = contracts.filter("side = 'b'").select("pair_id", F.col("place").alias("pb"), F.col("security_id").alias("security_id_b"))
    found = best.join(a, ["pair_id", "pa"]).join(b, ["pair_id", "pb"])
    return found.select(F.inline(_directed(F.coalesce(F.col("direction"), F.lit("A_IMPLIES_B")))), "relationship_type", "confidence")


def cached_relations(items: DataFrame, contracts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Relations of securities from cached judgements, which name outcomes by label.

    ``items``: pair_id, first_label, second_label, type, confidence, direction; ``pairs``: pair_id, event_a, event_b, a_first (whether the
    cache has event a in first place); ``contracts``: event_id, security_id, outcome_label; of equal labels in an event the highest security
    counts. Labels no contract has and unknown types give none; an unset direction is that from a to b.
    """
    labels = contracts.groupBy("event_id", "outcome_label").agg(F.max("security_id").alias("security_id"))
    at = items.join(pairs, "pair_id")
    swap = ~F.col("a_first")
    at = at.select("type", "confidence", "direction", "event_a", "event_b", F.when(swap, F.col("second_label")).otherwise(F.col("first_label")).alias("la"), F.when(swap, F.col("first_label")).otherwise(F.col("second_label")).alias("lb"))
    a, b = labels.toDF("event_a", "la", "security_id_a"), labels.toDF("event_b", "lb", "security_id_b")
    found = at.join(a, ["event_a", "la"]).join(b, ["event_b", "lb"]).withColumn("relationship_type", F.upper(F.trim("type"))).filter(F.col("relationship_type").isin(*TYPES))
    return found.select(F.inline(_directed(F.coalesce(F.upper("direction"), F.lit("A_IMPLIES_B")))), "relationship_type", "confidence")


def _directed(direction: Column) -> Column:
    """Both directions, for IMPLIES the one it states."""
    there = F.struct(F.col("security_id_a").alias("security_id_a"), F.col("security_id_b").alias("security_id_b"))
    back = F.struct(F.col("security_id_b").alias("security_id_a"), F.col("security_id_a").alias("security_id_b"))
    implies = F.col("relationship_type") == "IMPLIES"
    return F.when(implies & (direction == "B_IMPLIES_A"), F.array(back)).when(implies, F.array(there)).otherwise(F.array(there, back))


def derive(judged: DataFrame, complements: DataFrame) -> DataFrame:
    """Judged edges and what complements add to them.

    a IMPLIES b: not-b IMPLIES not-a; a EQUIVALENT b: not-a and not-b are, in both directions;
    a excludes b: a IMPLIES not-b and b IMPLIES not-a. Where a complement is missing nothing is added.
    """
    ca = complements.select(F.col("security_id").alias("security_id_a"), F.col("other_id").alias("not_a"))
    cb = complements.select(F.col("security_id").alias("security_id_b"), F.col("other_id").alias("not_b"))
    j = judged.join(ca, "security_id_a", "left").join(cb, "security_id_b", "left")
    a, b, na, nb, t = (F.col(c) for c in ("security_id_a", "security_id_b", "not_a", "not_b", "relationship_type"))
    edge = lambda x, y, kind, when: F.when(when, F.struct(x.alias("security_id_a"), y.alias("security_id_b"), kind.alias("relationship_type")))
    imp = F.lit("IMPLIES")
    made = F.array(
        edge(a, b, t, F.lit(True)),
        edge(nb, na, imp, t == "IMPLIES"),
        edge(na, nb, t, t == "EQUIVALENT"),
        edge(nb, na, t, t == "EQUIVALENT"),
        edge(a, nb, imp, t == "MUTUALLY_EXCLUSIVE"),
        edge(b, na, imp, t == "MUTUALLY_EXCLUSIVE"),
    )
    return j.select(F.inline(F.filter(made, lambda x: x.isNotNull() & x["security_id_a"].isNotNull() & x["security_id_b"].isNotNull())), "confidence")


def best_per_pair(matches: DataFrame, order: str) -> DataFrame:
    """Per ordered pair the most confident match, the first of equals. One combined aggregation, no window."""
    top = F.max_by(F.struct("relationship_type", "confidence", order), F.struct(F.col("confidence"), -F.col(order))).alias("_m")
    return matches.groupBy("security_id_a", "security_id_b").agg(top).select("security_id_a", "security_id_b", "_m.*")


def both_ways(pairs: DataFrame) -> DataFrame:
    """Pairs in both directions, once each."""
    return pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("security_id_a").alias("security_id_a"), F.col("security_id_b").alias("security_id_b")),
                F.struct(F.col("security_id_b").alias("security_id_a"), F.col("security_id_a").alias("security_id_b")),
            )
        )
    ).distinct()


def to_write(matches: DataFrame, existing: DataFrame, order: str, least: float, new_side: DataFrame | None = None) -> DataFrame:
    """Matches to append: the best of each ordered pair, confident enough, touching a new security, and of a pair not yet there in either direction (manual rows do not block)."""
    m = matches
    if new_side is not None:
        ids = new_side.select("security_id").distinct()
        m = m.join(ids.select(F.col("security_id").alias("security_id_a"), F.lit(True).alias("_na")), "security_id_a", "left").join(ids.select(F.col("security_id").alias("security_id_b"), F.lit(True).alias("_nb")), "security_id_b", "left").filter(F.coalesce("_na", "_nb", F.lit(False)))
    best = best_per_pair(m, order).filter(F.col("confidence") >= least)
    blocked = both_ways(existing.filter("method is null or method <> 'manual'"))
    return best.join(blocked, ["security_id_a", "security_id_b"], "left_anti")


def write_counts(matches: DataFrame, existing: DataFrame, order: str, least: float, new_side: DataFrame | None = None) -> DataFrame:
    """(written, skipped_low_confidence) of ``to_write``: pairs not there yet whose best match is confident enough, or is not."""
    every = to_write(matches, existing, order, float("-inf"), new_side)
    return every.agg(F.count_if(F.col("confidence") >= least).alias("written"), F.count_if(F.col("confidence") < least).alias("skipped_low_confidence"))


def allowed_pairs(pairs: DataFrame, allowed: list[str]) -> DataFrame:
    """Pairs of which at least one side's category is allowed or unset."""
    ok = lambda c: F.col(c).isNull() | F.col(c).isin(*allowed)
    return pairs.filter(ok("category_a") | ok("category_b"))


def allowed_sources(events: DataFrame, allowed: list[str]) -> DataFrame:
    """New events that may start a search: of an allowed category or of none; no list allows all."""
    return events if not allowed else events.filter(F.col("category").isNull() | (F.col("category") == "") | F.col("category").isin(*allowed))
