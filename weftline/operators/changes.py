"""Change detection and tick state: what is new, what was already sent, what has gone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import contract_hash

NATIVE = ["exchange_id", "native_id"]


def first_of_group(df: DataFrame, keys: list[str], order: str, *columns: str) -> DataFrame:
    """The row that came first stands for its group; one aggregation, combined before the shuffle."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_f")).select(*keys, *[F.col(f"_f.{c}").alias(c) for c in columns])


def active_sets(df: DataFrame) -> DataFrame:
    """The native ids present, one row each (a set as rows does not grow one cell)."""
    return df.select(*NATIVE).distinct()


def volume_filter(groups: DataFrame, volume: str, least: float | None) -> DataFrame:
    """Groups whose volume is unknown or at least ``least``; no limit keeps all."""
    return groups if least is None else groups.filter(F.col(volume).isNull() | (F.col(volume) >= least))


def cap_in_order(df: DataFrame, order: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The first ``most`` rows in order, and the rest. ``order`` is unique, so both sides are exact."""
    taken = df.orderBy(order).limit(most)
    return taken, df.join(taken.select(order), order, "left_anti")


@dataclass
class Diff:
    """Groups to send, and the hashes to know next time."""

    messages: DataFrame
    hashes: DataFrame


def diff_contracts(contracts: DataFrame, known: DataFrame, failed: DataFrame | None = None, least_volume: float | None = None, most: int | None = None) -> Diff:
    """Event groups of which at least one contract is new or changed.

    ``contracts``: exchange_id, native_id, security_id, label, title, volume, pos; ``known``: exchange_id,
    security_id, hash. Sent groups get their new hashes; groups over the cap keep what was known and
    come again; what is absent is forgotten, unless its exchange is in ``failed``.
    """
    rows = contracts.withColumn("hash", contract_hash(*[F.col(c) for c in ("exchange_id", "security_id", "label", "title", "native_id")]))
    seen = rows.join(known.withColumnRenamed("hash", "known"), ["exchange_id", "security_id"], "left")
    groups = seen.groupBy(*NATIVE).agg(
        F.min("pos").alias("pos"),
        F.min_by("volume", "pos").alias("volume"),
        F.count(F.lit(1)).alias("n_contracts"),
        F.count_if(~F.col("known").eqNullSafe(F.col("hash"))).alias("n_changed"),
    )
    wanted = volume_filter(groups, "volume", least_volume)
    changed = wanted.filter("n_changed > 0")
    sent = changed if most is None else cap_in_order(changed, "pos", most)[0]
    marked = seen.join(wanted.select(*NATIVE), NATIVE, "left_semi").join(sent.select(*NATIVE, F.lit(True).alias("sent")), NATIVE, "left")
    hashes = marked.select("exchange_id", "security_id", F.when(F.col("sent"), F.col("hash")).otherwise(F.col("known")).alias("hash")).filter("hash is not null").distinct()
    if failed is not None:
        kept = known.join(failed.select("exchange_id").distinct(), "exchange_id", "left_semi").join(hashes.select("exchange_id", "security_id"), ["exchange_id", "security_id"], "left_anti")
        hashes = hashes.unionByName(kept.select("exchange_id", "security_id", "hash"))
    return Diff(sent.select(*NATIVE, "volume", "n_contracts", "n_changed"), hashes)


def send_once(resolved: DataFrame, sent: DataFrame, keys: list[str], most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(to send now, memory for the next time): what is resolved and not yet sent; memory holds only what is still resolved and was sent. Beyond ``most``, in order of key, the rest is not sent, not remembered and comes again."""
    now = resolved.select(*keys).distinct()
    new = now.join(sent.select(*keys), keys, "left_anti")
    new = new if most is None else new.orderBy(*keys).limit(most)
    memory = now.join(sent.select(*keys), keys, "left_semi").unionByName(new)
    return new, memory


def update_tracker(tracker: DataFrame, active: DataFrame, threshold: int, failed: Column | None = None, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(tracker, stale): absences in a row per key. Present or new: 0; absent: one more; at the threshold stale and dropped; failed exchanges stay.

    Beyond ``most`` stale keys (in order of key) the rest stays in the tracker at the threshold and comes again.
    """
    both = tracker.select(*NATIVE, "misses").join(active.select(*NATIVE).distinct().withColumn("here", F.lit(True)), NATIVE, "full_outer")
    skipped = F.lit(False) if failed is None else failed
    misses = F.when(F.col("here") & F.col("misses").isNull(), 0).when(skipped, F.col("misses")).when(F.col("here"), 0).otherwise(F.col("misses") + 1)
    counted = both.select(*NATIVE, misses.cast("int").alias("misses"), (skipped & F.col("misses").isNotNull()).alias("_s"))
    stale = counted.filter((F.col("misses") >= threshold) & ~F.col("_s")).drop("_s")
    kept = counted.filter((F.col("misses") < threshold) | F.col("_s")).drop("_s")
    if most is not None:
        sent = stale.orderBy(*NATIVE).limit(most)
        rest = stale.join(sent.select(*NATIVE), NATIVE, "left_anti").withColumn("misses", F.lit(threshold))
        return kept.unionByName(rest), sent
    return kept, stale


def chunk_ids(df: DataFrame, order: list[str], size: int, groups: list[str]) -> DataFrame:
    """Fixed-size chunks within each group of rows, in order, with the place (from 1) in the group.

    Rows are numbered across range partitions of (group, order) and a group's first number is taken off, so no task sees a whole group.
    """
    from weftline.operators.entities import with_ids

    numbered = with_ids(df, df.sparkSession.createDataFrame([(0,)], "_nr long"), "_nr", [*groups, *order])
    key = F.to_json(F.struct(*groups), {"ignoreNullFields": "false"})
    numbered = numbered.withColumn("_g", key)
    first = numbered.groupBy("_g").agg(F.min("_nr").alias("_first"))
    place = (F.col("_nr") - F.col("_first") + 1).cast("int")
    return numbered.join(first, "_g").withColumn("chunk", F.floor((place - 1) / size)).withColumn("place", place).select(*df.columns, "chunk", "place")
