"""Tables of state as Parquet versions and logs of changes: what counts is written whole, so readers and replays are safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class TableStore:
    """``root/<table>/v<n>``; the highest version with its success marker is the table. ``root`` is a folder all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):  # noqa: ANN202
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def version(self, name: str) -> int:
        """The current version, 0 where there is none."""
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return 0
        numbers = [int(s.getPath().getName()[1:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v") and s.getPath().getName()[1:].isdigit()]
        whole = [n for n in numbers if fs.exists(self._fs(f"{self.root}/{name}/v{n}/_SUCCESS")[1])]
        return max(whole, default=0)

    def read(self, name: str, schema: str) -> DataFrame:
        """The table, or an empty one of ``schema`` where nothing is stored yet."""
        n = self.version(name)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/v{n}") if n else self.spark.createDataFrame([], schema)

    def write(self, name: str, df: DataFrame, keep: int = 2) -> int:
        """The next version; older ones than the last ``keep`` go, so a failed write never harms what is there."""
        n = self.version(name) + 1
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/v{n}")
        for old in range(max(1, n - keep - 3), n - keep + 1):
            fs, p = self._fs(f"{self.root}/{name}/v{old}")
            if fs.exists(p):
                fs.delete(p, True)
        return n

    def log(self, name: str, df: DataFrame, number: int) -> None:
        """The changes of micro-batch ``number``; written again they replace themselves, and nothing else is rewritten."""
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/log/batch={number}")

    def logged(self, name: str, number: int) -> bool:
        fs, p = self._fs(f"{self.root}/{name}/log/batch={number}/_SUCCESS")
        return fs.exists(p)

    def changes(self, name: str, schema: str, before: int | None = None) -> DataFrame:
        """All changes with their ``batch``, those of batches below ``before`` only where given: what a batch saw when it first ran, it sees again."""
        fs, p = self._fs(f"{self.root}/{name}/log")
        parts = []
        if fs.exists(p):
            numbers = [int(s.getPath().getName()[6:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("batch=")]
            parts = [f"{self.root}/{name}/log/batch={n}" for n in sorted(numbers) if (before is None or n < before) and self.logged(name, n)]
        base = self.read(name, f"{schema}, batch bigint")
        if not parts:
            return base
        # the batch column is the folder's name
        rows = self.spark.read.schema(f"{schema}, batch bigint").option("basePath", f"{self.root}/{name}/log").parquet(*parts)
        return base.unionByName(rows.select(*base.columns))

    def state(self, name: str, schema: str, keys: list[str], before: int | None = None) -> DataFrame:
        """The last change of every key."""
        cols = [c.split()[0] for c in schema.split(", ") if c.split()[0] not in keys]
        last = F.max_by(F.struct(*cols, "batch") if cols else F.struct("batch"), "batch").alias("_r")
        return self.changes(name, schema, before).groupBy(*keys).agg(last).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])

    def compact(self, name: str, schema: str, keys: list[str]) -> None:
        """Folds the log into a version, so that reading stays cheap; called between batches."""
        cols = [c.split()[0] for c in schema.split(", ") if c.split()[0] not in keys]
        last = F.max_by(F.struct(*cols, "batch"), "batch").alias("_r")
        folded = self.changes(name, schema).groupBy(*keys).agg(last).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (*cols, "batch")])
        self.write(name, folded)
        fs, p = self._fs(f"{self.root}/{name}/log")
        fs.delete(p, True)
