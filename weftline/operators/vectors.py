"""Exact cosine neighbours by blocks of matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors per block; a task holds two blocks, whatever the table's size.
BLOCK_ROWS = 8192


def exact_neighbours(vectors: DataFrame, key: str, vec: str, k: int, least: float) -> DataFrame:
    """Pairs ``(a, b, sim)``, a < b, with cosine at least ``least``, of which one is among the ``k`` nearest of the other.

    Self is left out before the ranking, ties go by key, zero vectors are similar to nothing. Blocks of
    queries meet blocks of candidates by a join on the pair of block numbers; each task holds two blocks, and
    only its k best per query leave it. This is the exact operator, quadratic in work; use it up to some 10^5 vectors.
    """
    n = vectors.count()
    blocks = max(1, -(-n // BLOCK_ROWS))
    rows = vectors.select(F.col(key).alias("id"), F.col(vec).alias("v"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("blk"))
    packed = rows.groupBy("blk").agg(F.collect_list(F.struct("id", "v")).alias("rows"))  # at most about BLOCK_ROWS each
    other = packed.select(F.col("blk").alias("cblk"), F.col("rows").alias("crows"))
    numbers = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda x: x)
    tasks = packed.select("blk", "rows", F.explode(numbers).alias("cblk")).join(other, "cblk")

    def matrix(items: list) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array([r["id"] for r in items], dtype=np.int64)
        x = np.array([r["v"] for r in items], dtype=np.float64)
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return ids, np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for q_rows, c_rows in zip(pdf["rows"], pdf["crows"], strict=True):
                (qi, qx), (ci, cx) = matrix(q_rows), matrix(c_rows)
                order = np.argsort(ci, kind="stable")
                ci, cx = ci[order], cx[order]
                for s in range(0, len(qi), 1024):
                    sims = qx[s : s + 1024] @ cx.T
                    sims[qi[s : s + 1024, None] == ci[None, :]] = -np.inf
                    sims = np.round(sims, 12)
                    top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                    val = np.take_along_axis(sims, top, 1)
                    good = val >= min(least, 1.0)
                    yield pd.DataFrame({"q": np.repeat(qi[s : s + 1024], good.sum(axis=1)), "c": ci[top][good], "sim": val[good]})

    best = tasks.mapInPandas(run, "q bigint, c bigint, sim double")
    ranked = best.withColumn("rk", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "c"))).filter(F.col("rk") <= k)
    return max_similarity(ranked)


def max_similarity(pairs: DataFrame) -> DataFrame:
    """The highest similarity of every unordered pair of (q, c, sim)."""
    return pairs.groupBy(F.least("q", "c").alias("a"), F.greatest("q", "c").alias("b")).agg(F.max("sim").alias("sim"))
