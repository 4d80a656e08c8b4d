"""Session helpers: sessions for tests, the shared checkpoint folder, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when Spark's own estimate of it is below this.
BROADCAST_BYTES = 8 << 20


def local_session(cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session as tests and the bench use it; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WEFTLINE_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where neither that setting nor the context names one (a local test session) one is made here."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="weftline-"))
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """Cuts lineage with a table in the shared folder: narrower than a checkpoint where columns repeat, and Catalyst knows its size."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]] | DataFrame:
    """Cuts lineage with a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    With ``counts`` (conditions by name) also how many rows fulfil each, observed as the
    checkpoint is written, so that no job of its own counts them.
    """
    shared_folder(df.sparkSession)
    if not counts:
        return df.checkpoint(eager=True)
    seen = Observation()
    done = df.observe(seen, *[F.count_if(c).alias(n) for n, c in counts.items()]).checkpoint(eager=True)
    return done, seen.get


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` added (or replaced), each worked out once per row.

    A generator of one row stands between: filters on the new columns are not pushed below it, which
    would put the whole expression into every one of them.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Marks ``df`` for broadcast when Catalyst's size estimate is under ``limit``; else leaves the join to Catalyst."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= limit else df


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever folder either was started in.

    On a cluster without that folder it changes nothing; there the package is installed or sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
