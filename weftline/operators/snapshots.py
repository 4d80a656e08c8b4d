"""What changed between full snapshots: EXCEPT ALL both ways, then a full join of the residues by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions.text import nfc, squeeze


def latest_copy(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` (nulls lowest). Aggregates before it shuffles, so a hot key does no harm."""
    best = F.max(F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in values]).alias("_v"))).alias("_m")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_m._v.{c}").alias(c) for c in values])


def snapshot_changes(
    df: DataFrame,
    snapshot: str,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    text_values: bool = True,
) -> DataFrame:
    """Rows ``(snapshot, *keys, change)`` with change 'added', 'removed' or 'changed', each snapshot against the one before.

    Per snapshot and key the copy with the greatest ``order`` counts. Text values are compared
    in canonical composition and with white space squeezed; null differs from any text.
    "Before" is the next lower snapshot that occurs, so a missing number is no empty snapshot.
    Null keys are keys like others; rows with a null snapshot belong to none. An empty table
    gives no rows; columns beyond those named are never read.
    The identical rows of neighbouring snapshots are removed as EXCEPT ALL would in both
    directions, in one signed multiset count (+1 the later, -1 the earlier), so the residue is
    all that reaches the full join.
    """
    df = df.select(snapshot, *keys, *order, *values)
    rows = latest_copy(df.filter(F.col(snapshot).isNotNull()), [snapshot, *keys], values, order)
    if text_values:
        rows = rows.select(snapshot, *keys, *[nfc(squeeze(F.col(v))).alias(v) for v in values])
    # the snapshots themselves are few: one row per delivery, whatever the table's size
    numbers = df.select(snapshot).distinct().filter(F.col(snapshot).isNotNull())
    follow = numbers.select(F.col(snapshot).alias("_s"), F.lead(snapshot).over(Window.orderBy(snapshot)).alias("_next"), F.lag(snapshot).over(Window.orderBy(snapshot)).alias("_prev"))
    both = rows.join(follow, F.col(snapshot) == F.col("_s")).select(
        F.inline(
            F.filter(
                F.array(
                    F.struct(F.when(F.col("_prev").isNotNull(), F.col(snapshot)).alias("_at"), F.lit(1).alias("_sign")),
                    F.struct(F.col("_next").alias("_at"), F.lit(-1).alias("_sign")),
                ),
                lambda x: x["_at"].isNotNull(),
            )
        ),
        *keys,
        *values,
    )
    residue = both.groupBy("_at", *keys, *values).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    # full join of the two residues by key: both sides are one table, so the join is the grouping of their union
    sides = residue.groupBy("_at", *keys).agg(F.max(F.col("_net") > 0).alias("_later"), F.max(F.col("_net") < 0).alias("_earlier"))
    change = F.when(F.col("_later") & F.col("_earlier"), "changed").when(F.col("_later"), "added").otherwise("removed")
    return sides.select(F.col("_at").alias(snapshot), *keys, change.alias("change"))
