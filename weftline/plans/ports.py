"""What calls out to models, as ports with deterministic offline forms."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import embedding_text, strip_code_fences, title_key
from weftline.operators.entities import upsert
from weftline.operators.reports import section_head, sections
from weftline.session import cut


class Canonicalizer(Protocol):
    def __call__(self, titles: DataFrame) -> DataFrame:
        """(key, title, category, tags) for every (key, title, category)."""


def identity_canonicalizer(titles: DataFrame) -> DataFrame:
    """The raw title, its category or OTHER, no tags."""
    return titles.select("key", "title", F.coalesce(F.nullif("category", F.lit("")), F.lit("OTHER")).alias("category"), F.array().cast("array<string>").alias("tags"))


def response_canonicalizer(responses: DataFrame, categories: list[str]):  # noqa: ANN201
    """Canonical forms from a table of responses (text, one JSON list each): an unknown category is OTHER, at most 8 tags, an empty title is the raw one; a title whose key no response names is asked for again by the caller."""
    item = "array<struct<key:string,title:string,category:string,tags:array<string>>>"
    items = responses.select(F.inline(F.from_json(strip_code_fences(F.col("text")), item))).groupBy("key").agg(F.first(F.struct("title", "category", "tags"), ignorenulls=True).alias("c"))

    def call(titles: DataFrame) -> DataFrame:
        asked = titles.withColumn("_k", title_key(F.col("title")))
        joined = asked.join(items.withColumnRenamed("key", "_k"), "_k")
        category = F.when(F.upper("c.category").isin(*categories), F.upper("c.category")).otherwise("OTHER")
        return joined.select("key", F.coalesce(F.nullif("c.title", F.lit("")), "title").alias("title"), category.alias("category"), F.slice(F.coalesce("c.tags", F.array().cast("array<string>")), F.lit(1), F.lit(8)).alias("tags"))

    return call


def hashing_embedder(texts: DataFrame, size: int = 64) -> DataFrame:
    """(event_id, embedding): signed counts of word hashes; equal texts have equal vectors in every process and engine."""
    words = texts.select("event_id", F.explode(F.split(F.lower("text"), r"\W+")).alias("w")).filter("w <> ''").withColumn("w", F.md5("w"))
    number = lambda at, n: F.conv(F.substring("w", at, n), 16, 10).cast("long")
    cells = words.select("event_id", (number(1, 8) % size).cast("int").alias("i"), F.when(number(9, 1) < 8, 1.0).otherwise(-1.0).alias("s"))
    summed = cells.groupBy("event_id", "i").agg(F.sum("s").alias("s")).groupBy("event_id").agg(F.map_from_entries(F.collect_list(F.struct("i", "s"))).alias("m"))
    return summed.select("event_id", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)).cast("float")).alias("embedding"))


def canonicalize(titles: DataFrame, cache: DataFrame, call: Canonicalizer, retry: Canonicalizer | None = None) -> tuple[DataFrame, DataFrame]:
    """(canonical forms of all titles, rows to add to the cache): what the cache has is not asked for; what a call leaves out is asked once more; anything still missing is an error.

    ``titles``: key, title, category; ``cache``: key, title, category, tags.
    """
    known = cache.select("key", "title", "category", "tags").join(titles.select("key"), "key", "left_semi")
    asked = titles.join(known.select("key"), "key", "left_anti")
    first = cut(call(asked))
    left = asked.join(first.select("key"), "key", "left_anti")
    new = first.unionByName(cut(retry(left))) if retry else first
    missing = asked.join(new.select("key"), "key", "left_anti").count()
    if missing:
        raise RuntimeError(f"{missing} titles without canonical form")
    return known.unionByName(new), new


def embed_missing(events: DataFrame, vectors: DataFrame, embed=hashing_embedder) -> DataFrame:  # noqa: ANN001
    """The vectors table with vectors of the open events that had none."""
    open_ = events.filter(~F.coalesce("resolved", F.lit(False))).join(vectors.filter("embedding is not null").select("event_id"), "event_id", "left_anti")
    new = embed(open_.select("event_id", embedding_text(F.col("title"), F.col("description")).alias("text")))
    return upsert(vectors.select("event_id", "embedding"), new, ["event_id"])


def canonical_prompt(rows: DataFrame) -> DataFrame:
    """One text per chunk of (chunk, place, title, description, category): a line each, in order, its fields set apart by tabs: place, key, category, title, description's start."""
    line = F.concat_ws("\t", F.col("place").cast("string"), title_key(F.col("title")), F.coalesce("category", F.lit("")), F.col("title"), F.left(F.coalesce("description", F.lit("")), F.lit(200)))
    return rows.groupBy("chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))


def judge_prompt(pairs: DataFrame) -> DataFrame:
    """Texts of pairs to be judged: title_a, description_a, labels_a and the same of b, sim."""

    def side(name: str) -> Column:
        labels = F.array_join(F.transform(F.col(f"labels_{name}"), lambda x, i: F.concat((i + 1).cast("string"), F.lit("="), x)), "; ")
        return F.concat_ws("\n", F.concat(F.lit(f"<{name}> "), f"title_{name}"), F.concat(F.lit("about "), F.left(F.coalesce(f"description_{name}", F.lit("")), F.lit(200))), F.concat(F.lit("outcomes "), labels))

    return pairs.withColumn("text", F.concat_ws("\n", side("a"), side("b"), F.format_string("cosine %.3f", F.col("sim"))))


def split_cached(pairs: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs whose judgement is cached, with it; pairs still to be judged), by their symmetric key."""
    return pairs.join(cache, "pair_key"), pairs.join(cache.select("pair_key"), "pair_key", "left_anti")


def notification(messages: DataFrame, most: int = 20) -> DataFrame:
    """Sections of new and resolved events from messages (type, event_id, event_name), each event once, at most ``most`` lines."""
    unique = messages.filter(F.col("type").isin("new_events", "resolved")).groupBy("type", "event_id").agg(F.max("event_name").alias("event_name"))
    body = sections(unique, "type", "event_id", "event_name", most)
    head = F.when(F.col("type") == "resolved", F.concat_ws(" ", F.col("n").cast("string"), F.when(F.col("n") == 1, "event").otherwise("events"), F.lit("resolved"))).otherwise(section_head(F.lit("new"), F.col("n")))
    return body.select("type", head.alias("head"), "body")
