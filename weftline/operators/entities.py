"""Resolving contracts to canonical events, securities and listings; append-only specs; table writes as algebra."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions.scalars import expiry_close
from weftline.session import cut


def split_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is known, with what is known of it; rows whose key is new)."""
    return rows.join(known, keys, "inner"), rows.join(known.select(*keys), keys, "left_anti")


def tolerance_join(new: DataFrame, existing: DataFrame, tolerance_s: int) -> DataFrame:
    """Each new (key, title, expiry) with the lowest existing event of its title and an expiry close to it; no expiry is close to no expiry.

    Expiries are cut into steps as wide as the tolerance, so that an existing event meets those new ones only whose step is its own or a neighbour's,
    however many events share a title.
    """
    step = lambda c: F.floor(F.unix_micros(c) / F.lit(max(1, tolerance_s) * 1_000_000))
    # of all events of one title and instant only the lowest can win
    e = existing.groupBy("title", F.col("expiry").alias("_e")).agg(F.min("event_id").alias("event_id")).withColumn("_s", F.coalesce(step(F.col("_e")), F.lit(-(1 << 62))))
    mine = step(F.col("expiry"))
    near = F.when(mine.isNull(), F.array(F.lit(-(1 << 62)))).otherwise(F.array(mine - 1, mine, mine + 1))
    close = new.withColumn("_s", F.explode(near)).join(e, ["title", "_s"]).filter(expiry_close(F.col("expiry"), F.col("_e"), tolerance_s))
    return close.groupBy("key").agg(F.min("event_id").alias("event_id"))


def leaders(rows: DataFrame, title: str, value: str, pos: str, tolerance: int) -> DataFrame:
    """Leader clustering: a row joins the first earlier leader of its title within the tolerance, else it leads.

    ``value`` is a number or null (nulls only match nulls). Rows of one title and value always share
    a leader, so only distinct values in the order of their first place are walked through; that also
    keeps a hot title as small as its number of values. Result: (title, value, leader_pos).
    """
    firsts = rows.groupBy(title, value).agg(F.min(pos).alias("_p"))
    lists = firsts.groupBy(title).agg(F.array_sort(F.collect_list(F.struct(F.col("_p").alias("p"), F.col(value).alias("v")))).alias("_l"))
    kind = dict(rows.dtypes)
    close = lambda a, b: F.coalesce((a.isNull() & b.isNull()) | (F.abs(a - b) <= tolerance), F.lit(False))
    none = F.array().cast(f"array<struct<p:{kind[pos]},v:{kind[value]}>>")
    found = F.aggregate("_l", none, lambda acc, x: F.when(F.exists(acc, lambda y: close(y["v"], x["v"])), acc).otherwise(F.array_append(acc, x)))
    led = lists.select(title, F.explode("_l").alias("_x"), found.alias("_f"))
    leader = F.get(F.filter("_f", lambda y: close(y["v"], F.col("_x.v"))), F.lit(0))["p"]
    return led.select(title, F.col("_x.v").alias(value), leader.alias("leader_pos"))


def with_ids(rows: DataFrame, taken: DataFrame, id_column: str, order: list[str]) -> DataFrame:
    """Ids after the highest taken one, in order. Rows are counted per range partition, so no task sees all of them; the partitions are
    written before they are counted, so a lost executor cannot number them anew."""
    spread = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    counts = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_low"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), "_low")
    top = taken.select(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    return spread.join(starts, "_part").withColumn(id_column, top + F.col("_before") + F.col("_row") - F.col("_low") + 1).drop("_part", "_row", "_before", "_low")


def new_first(rows: DataFrame, existing: DataFrame, keys: list[str], pos: str, columns: list[str]) -> DataFrame:
    """Rows to insert: of every key not yet there the first in order."""
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*columns), pos).alias("_f"), F.min(pos).alias(pos))
    return first.select(*keys, pos, *[F.col(f"_f.{c}").alias(c) for c in columns]).join(existing.select(*keys), keys, "left_anti")


def new_currencies(contracts: DataFrame, existing: DataFrame) -> DataFrame:
    """Base, quote and settle currencies that have no row yet."""
    every = contracts.select(F.explode(F.array("base_currency", "quote_currency", "settle_currency")).alias("symbol")).filter("symbol is not null").distinct()
    return every.join(existing, "symbol", "left_anti")


def latest_spec(specs: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """The last recorded spec per listing."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_s")
    return specs.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_s.{v}").alias(v) for v in values])


def spec_changes(current: DataFrame, recorded: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Specs to append: listings without one ('new') or whose last one differs ('update'); values compare as whole numbers of billionths, cut toward zero, null-safe."""
    last = recorded.select(*keys, *[F.col(v).alias(f"_l_{v}") for v in values], F.lit(True).alias("_has"))
    scaled = lambda c: (F.col(c) * 1e9).cast("long")
    same = F.lit(True)
    for v in values:
        same = same & scaled(v).eqNullSafe(scaled(f"_l_{v}"))
    joined = current.join(last, keys, "left")
    kind = F.when(F.col("_has").isNull(), "new").when(~same, "update")
    return joined.select(*keys, *values, kind.alias("action")).filter("action is not null")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` in place of those with the same key."""
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)


def delete(existing: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return existing.join(gone.select(*keys), keys, "left_anti")


def patch(existing: DataFrame, patches: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of ``patches`` that are set replace those of the rows with the same key; unknown keys change nothing."""
    names = [c for c in patches.columns if c not in keys]
    new = patches.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in names])
    joined = existing.join(new, keys, "left")
    return joined.select(*[F.coalesce(f"_n_{c}", c).alias(c) if c in names else F.col(c) for c in existing.columns])
