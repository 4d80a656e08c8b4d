"""Structured Streaming: at-least-once micro-batches over the batch operators, idempotent by anti join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.operators.changes import NATIVE, update_tracker
from weftline.sources.store import TableStore

MESSAGE = "type string, exchange_id long, native_id string, security_id long, security_symbol string, event_id long, event_name string, seq long, body string"
Handler = Callable[[DataFrame, int], None]


def parse_messages(stream: DataFrame, value: str = "value") -> DataFrame:
    """Typed messages; what cannot be read keeps its text and has type 'invalid'."""
    m = stream.select(F.col(value).alias("raw"), F.from_json(value, MESSAGE).alias("m"))
    return m.select(F.coalesce("m.type", F.lit("invalid")).alias("type"), *[F.col(f"m.{c.split()[0]}") for c in MESSAGE.split(", ")[1:]], "raw")


def run_batches(
    stream: DataFrame, handlers: dict[str, Handler], dead_letters: str, checkpoint: str, order: tuple[str, ...] = ("resolved", "stale", "new"), tries: int = 3, every: str | None = None
) -> StreamingQuery:
    """One checkpointed query: per batch the handlers in ``order``, then the rest; messages of no handler go to the dead letters.

    A handler that fails is tried again, ``tries`` times in all; then its messages of this batch are dead letters too and the stream goes on. A batch
    that is replayed must change nothing: handlers see the state before it (``TableStore.changes``) and write under its number. ``every`` is the longest wait
    for a batch (a processing-time trigger); without it what is there is worked off and the query ends.
    """

    def attempt(kind: str, df: DataFrame, number: int) -> bool:
        for _ in range(tries):
            try:
                handlers[kind](df, number)
                return True
            except Exception:  # noqa: BLE001
                continue
        return False

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            failed = [kind for kind in [*[k for k in order if k in handlers], *[k for k in handlers if k not in order]] if not attempt(kind, df.filter(F.col("type") == kind), number)]
            dead = df.filter(~F.col("type").isin(*handlers) | F.col("type").isin(*failed)) if failed else df.filter(~F.col("type").isin(*handlers))
            dead.select("raw").write.mode("overwrite").text(f"{dead_letters}/batch={number}")
        finally:
            df.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def insert_once(store: TableStore, name: str, schema: str, keys: list[str]) -> Handler:
    """Handler that adds rows whose key is not there yet; of equal keys in a batch one stays. Only the new rows are written."""

    def handle(df: DataFrame, number: int) -> None:
        there = store.changes(name, schema, number)
        cols = [c.split()[0] for c in schema.split(", ")]
        store.log(name, df.select(*cols).dropDuplicates(keys).join(there.select(*keys), keys, "left_anti"), number)

    return handle


def tick(store: TableStore, active: DataFrame, number: int, threshold: int = 3, name: str = "tracker") -> DataFrame:
    """One tick of the miss counter: absence has no message, so the whole tracker meets the active keys. A tick that was already counted is not counted again. Returns what is stale."""
    schema = "exchange_id long, native_id string, misses int, tick long"
    stored = store.read(name, schema)
    last = stored.agg(F.max("tick")).first()[0]
    if last is not None and last >= number:
        return stored.filter(f"misses >= {threshold}").select(*NATIVE, "misses")
    state, stale = update_tracker(stored.filter(f"misses < {threshold}").select(*NATIVE, "misses"), active, threshold)
    store.write(name, state.unionByName(stale).withColumn("tick", F.lit(number).cast("long")))
    return store.read(name, schema).filter(f"misses >= {threshold}").select(*NATIVE, "misses")


HASHES = "exchange_id long, native_id string, hash string"


def changed_groups(store: TableStore, name: str = "hashes") -> Handler:
    """Handler for 'new' messages: writes the groups of the batch whose latest body (by ``seq``) differs from the last known one, with its hash. The log is both the state and, by batch, the changes."""

    def handle(df: DataFrame, number: int) -> None:
        now = df.groupBy(*NATIVE).agg(F.sha2(F.max_by("body", F.struct("seq", "body")), 256).alias("hash"))
        known = store.state(name, HASHES, NATIVE, number)
        store.log(name, now.join(known, [*NATIVE, "hash"], "left_anti").select(*NATIVE, "hash"), number)

    return handle


def fresh(cache: DataFrame, at: str, now: str, days: int) -> DataFrame:
    """Entries of a cache table that have not outlived their time."""
    return cache.filter(F.col(at) > F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def file_stream(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """Text files of one JSON message a line, as a stream."""
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).load(path)
