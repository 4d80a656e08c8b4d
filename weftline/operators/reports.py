"""Reports: summaries of a fetch, title collisions, sections of a notification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def fetch_summary(contracts: DataFrame) -> DataFrame:
    """Events, contracts and volumes per venue; sums in decimals, so they do not depend on the order of rows."""
    v = F.col("event_volume")
    return contracts.groupBy("exchange_id").agg(
        F.countDistinct("exchange_event_native_id").alias("n_events"),
        F.count(F.lit(1)).alias("n_contracts"),
        F.round(F.min(v), 2).alias("min_volume"),
        F.round(F.max(v), 2).alias("max_volume"),
        F.sum(v.cast("decimal(20,2)")).cast("double").alias("total_volume"),
        F.count_if(v.isNull()).alias("n_unknown"),
    )


def collisions(rows: DataFrame, title: Column, raw: str, source: str) -> DataFrame:
    """Titles under which more than one raw title falls."""
    grouped = rows.groupBy(title.alias("title")).agg(F.countDistinct(raw).alias("n_raw"), F.countDistinct(source).alias("n_venues"), F.count(F.lit(1)).alias("n_contracts"))
    return grouped.filter("n_raw > 1").drop("n_raw")


def sections(rows: DataFrame, section: str, order: str, text: str, most: int) -> DataFrame:
    """Per section the first ``most`` lines and how many more there are; the ranking drops the rest before it is shuffled."""
    top = rows.withColumn("_rk", F.row_number().over(Window.partitionBy(section).orderBy(order))).filter(F.col("_rk") <= most)
    lines = top.groupBy(section).agg(F.array_sort(F.collect_list(F.struct("_rk", F.coalesce(text, F.lit("?")).alias("t")))).alias("_l"))
    counts = rows.groupBy(F.col(section).alias("_s")).agg(F.count(F.lit(1)).alias("n"))
    joined = lines.join(counts, F.col(section).eqNullSafe(F.col("_s")))
    more = F.when(F.col("n") > most, F.concat(F.lit("\n... and "), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise("")
    return joined.select(section, F.concat(F.array_join(F.transform("_l", lambda x: x["t"]), "\n"), more).alias("body"), "n")


def listed(rows: DataFrame, group: str, value: str, most: int = 1000) -> DataFrame:
    """(group, n, values): distinct values in order as one text, the first ``most`` of them, and how many there are."""
    unique = rows.filter(F.col(value).isNotNull()).select(group, value).distinct()
    top = unique.withColumn("_rk", F.row_number().over(Window.partitionBy(group).orderBy(value))).filter(F.col("_rk") <= most)
    texts = top.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rk", F.col(value).cast("string").alias("v")))), lambda x: x["v"]), ", ").alias("values"))
    return unique.groupBy(group).agg(F.count(F.lit(1)).alias("n")).join(texts, group)


def section_head(kind: Column, n: Column) -> Column:
    """``3 new events``; one is singular."""
    return F.concat_ws(" ", n.cast("string"), kind, F.when(n == 1, "event").otherwise("events"))


def unwrap(envelope: Column) -> Column:
    """The inner message of a wrapped notification, or the message itself."""
    kind, inner = F.get_json_object(envelope, "$.Type"), F.get_json_object(envelope, "$.Message")
    return F.when((kind == "Notification") & inner.isNotNull(), inner).otherwise(envelope)
