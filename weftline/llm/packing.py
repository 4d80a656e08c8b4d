"""Filling containers of fixed capacity: minimum bin slack over the histogram of item lengths.

Items of one length are interchangeable, so the state of the packing is how many items of each
length are left: at most capacity + 1 numbers, however many items there are. For each bin the largest
length left is set, and a subset-sum over the lengths left (a bit set of the sums that can be
reached, one whole number) finds the fullest feasible combination; it is used for as many bins as
the counts allow, then removed. Which item goes where follows from ranks within a length.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import cut, once

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE vocabularies of this family part a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Groups in which the items of one length are ranked, so that a length that very many share is no single task.
RANK_GROUPS = 64
#: Steps of the binary search among the places where a length is used.
SEARCH = [1 << k for k in range(20, -1, -1)]


@lru_cache(maxsize=2)
def _encoding(path: str):  # noqa: ANN202
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Rows ``(item, tokens)``: whole texts counted with a public tokenizer; null and empty texts have 0."""

    # the vocabulary goes with the job, so no executor needs the path
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = tokenizer.rsplit("/", 1)[-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(SparkFiles.get(name)).encode_ordinary
        for batch in batches:
            tokens = pa.array([len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item"), tokens], names=["item", "tokens"])

    return df.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text")).mapInArrow(count, "item bigint, tokens bigint")


def fullest(capacity: int, lengths: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """The combination of available lengths whose sum is the greatest within ``capacity``: pairs (place, times).

    ``lengths`` fall; longer ones are tried first, so ties prefer few long items.
    """
    mask = (1 << capacity + 1) - 1
    reach, trail = 1, []
    for i, (n, c) in enumerate(zip(lengths, counts, strict=True)):
        if n > capacity:
            continue
        left = min(c, capacity // n)
        part = 1
        before = reach
        # a count is taken as the sum of powers of two and a rest, so each length costs a logarithm of its count
        steps = []
        while left > 0:
            take = min(part, left)
            grown = (reach | reach << n * take) & mask
            steps.append((take, reach))
            reach = grown
            left -= take
            part *= 2
        if reach != before:
            trail.append((i, n, steps))
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    chosen: list[tuple[int, int]] = []
    for i, n, steps in reversed(trail):
        times = 0
        for take, earlier in reversed(steps):
            if not earlier >> total & 1:
                total -= n * take
                times += take
        if times:
            chosen.append((i, times))
    return chosen


def min_bin_slack(capacity: int, histogram: dict[int, int]) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (bins, [(length, times)]) that use up ``histogram`` (lengths from 1 to capacity)."""
    lengths = sorted((n for n, c in histogram.items() if n > 0 and c > 0), reverse=True)
    counts = [histogram[n] for n in lengths]
    patterns = []
    while lengths:
        first, rest = lengths[0], counts[:]
        rest[0] -= 1
        chosen = dict(fullest(capacity - first, lengths, rest))
        chosen[0] = chosen.get(0, 0) + 1
        bins = min(counts[i] // t for i, t in chosen.items())
        patterns.append((bins, [(lengths[i], t) for i, t in sorted(chosen.items())]))
        for i, t in chosen.items():
            counts[i] -= bins * t
        if any(counts[i] == 0 for i in chosen):
            kept = [k for k, c in enumerate(counts) if c]
            lengths, counts = [lengths[k] for k in kept], [counts[k] for k in kept]
    return patterns


def pack(items: DataFrame, sizes: DataFrame, kind: str, capacity: str) -> DataFrame:
    """Rows ``(kind, capacity, container_no, item, piece_no, tokens)``: every item in a container of every kind and capacity.

    ``items`` has item and tokens, ``sizes`` one row per kind of container (few rows). An item
    longer than the capacity, and only such a one, is cut: whole containers first, the rest like an item of its own. Items of
    0 tokens take no room and lie in container 0, which holds nothing else. Null capacities and
    capacities below 1 hold nothing and give no rows; a kind given with two capacities is packed for each of them, repeated rows once.
    Repeated item keys are separate items; an empty table gives no rows.
    """
    counted = items.select("item", "tokens")
    kinds = sizes.select(F.col(kind).alias("kind"), F.col(capacity).cast("long").alias("cap")).filter("cap >= 1").distinct()
    every = kinds.select(F.collect_list(F.struct("kind", "cap"))).scalar()
    pieces = counted.withColumn("every", every).select("item", "tokens", F.inline("every")).select(
        "kind",
        "cap",
        "item",
        F.inline(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("tokens") / F.col("cap")) - 1, F.lit(0))),
                lambda p: F.struct(p.cast("int").alias("piece_no"), F.least(F.col("cap"), F.col("tokens") - p * F.col("cap")).cast("int").alias("n")),
            )
        ),
    )
    salt = F.pmod(F.xxhash64("item", "piece_no"), F.lit(RANK_GROUPS)).cast("int")
    salted = pieces.withColumn("salt", salt)
    # items per length and salt; the sum over salts is the histogram, its running sum gives each salt's first rank
    part = salted.groupBy("kind", "cap", "n", "salt").agg(F.count(F.lit(1)).alias("c"))
    base = part.withColumn("base", F.sum("c").over(Window.partitionBy("kind", "cap", "n").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).na.fill(0, ["base"])
    histogram = part.groupBy("kind", "cap", "n").agg(F.sum("c").alias("c")).filter("n > 0")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, at, used = [], 1, {}
        cap = int(pdf["cap"].iloc[0])
        for bins, combination in min_bin_slack(cap, dict(zip(pdf["n"].astype(int), pdf["c"].astype(int), strict=True))):
            for n, times in combination:
                start = used.get(n, 0)
                rows.append((n, start, times, at))
                used[n] = start + bins * times
            at += bins
        return pd.DataFrame(rows, columns=["n", "first", "times", "bin"]).assign(kind=pdf["kind"].iloc[0], cap=cap)

    # at most capacity + 1 rows per kind and capacity reach one task
    of = ["kind", "cap"]
    patterns = histogram.groupBy(*of).applyInPandas(plan, "kind string, cap bigint, n int, first bigint, times int, bin bigint")
    slots = patterns.groupBy(*of, "n").agg(F.array_sort(F.collect_list(F.struct("first", "times", "bin"))).alias("slots"))
    order = Window.partitionBy(*of, "n", "salt").orderBy("item", "piece_no")
    same = lambda left, right, *cols: functools.reduce(lambda x, y: x & y, [left[c].eqNullSafe(right[c]) for c in cols])
    ranked = salted.withColumn("rank", F.row_number().over(order) - 1)
    starts = base.select(*of, "n", "salt", "base")
    ranked = ranked.join(starts, same(ranked, starts, *of, "n", "salt")).select(*[ranked[c] for c in (*of, "item", "piece_no", "n")], (F.col("rank") + F.col("base")).alias("rank"))
    placed = ranked.join(slots, same(ranked, slots, *of, "n"), "left").select(*[ranked[c] for c in (*of, "item", "piece_no", "n", "rank")], "slots")
    # the last of the places that begins at or before the rank, by binary search
    steps = F.array(*[F.lit(k) for k in SEARCH])
    at = F.aggregate(steps, F.lit(0), lambda at, k: F.when(F.coalesce(F.get("slots", at + k)["first"] <= F.col("rank"), F.lit(False)), at + k).otherwise(at))
    slot = F.get("slots", at)
    placed = once(placed, slot=slot)
    number = F.when(F.col("n") == 0, F.lit(0).cast("long")).otherwise(F.col("slot.bin") + F.floor((F.col("rank") - F.col("slot.first")) / F.col("slot.times")))
    return placed.select(F.col("kind").alias(kind), F.col("cap").alias("capacity"), number.alias("container_no"), "item", "piece_no", F.col("n").alias("tokens"))


def pack_texts(docs: DataFrame, key: str, text: str, sizes: DataFrame, kind: str, capacity: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``pack`` over the token counts of texts; the texts are counted once."""
    return pack(cut(count_tokens(docs, key, text, tokenizer)), sizes, kind, capacity)
