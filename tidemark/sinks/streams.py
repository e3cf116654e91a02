"""Sinks for streaming frames. Output and checkpoints live in the shared folder."""

from __future__ import annotations

import sys
import threading
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions import without_end
from tidemark.session import ROCKSDB_PROVIDER, STATE_PROVIDER_KEY, delete_at_end, scratch_dir

BATCH_ID = "batch_id"


@contextmanager
def streaming_settings(spark: SparkSession, partitions: int | None = None):
    """Settings a stateful query fixes when it first starts: RocksDB state that
    commits changes instead of snapshots, one store per join partition, and the number
    of state partitions. Without ``partitions`` the session's shuffle partitions
    count, or the task slots of a local master."""
    context = spark.sparkContext
    if partitions is None and context.master.startswith("local"):
        partitions = context.defaultParallelism
    wanted = {
        STATE_PROVIDER_KEY: ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.join.stateFormatVersion": "3",
    }
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    partitions: int | None = None,
    keep_batch: bool = False,
    drain: bool = False,
) -> StreamingQuery:
    """Write everything available now as parquet, then stop.

    ``drain`` is for sources that hand out what they have step by step: the query goes on
    from micro-batch to micro-batch until it is stopped.

    Plain append output goes to the file sink, whose log makes it exactly-once.
    Update output and output changed by ``per_batch`` is written one folder per
    micro-batch; a repeated batch overwrites its folder. ``keep_batch`` persists a
    micro-batch for a ``per_batch`` step that reads it more than once.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime="0 seconds") if drain else writer.trigger(availableNow=True)
    if mode == "append" and per_batch is None:
        writer = writer.format("parquet").option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
    else:

        def write(batch: DataFrame, batch_id: int) -> None:
            if keep_batch:
                batch.persist()
            try:
                changed = per_batch(batch) if per_batch else batch
                out = changed.write.mode("overwrite")
                if partition_by:
                    out = out.partitionBy(*partition_by)
                out.parquet(f"{path}/{BATCH_ID}={batch_id}")
            finally:
                if keep_batch:
                    batch.unpersist()

        writer = writer.foreachBatch(write)
    with streaming_settings(stream.sparkSession, partitions):
        return writer.start()


def run_available_now(
    stream: DataFrame,
    mode: str = "append",
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    path: str | None = None,
    checkpoint: str | None = None,
    partition_by: Sequence[str] = (),
    partitions: int | None = None,
    keep_batch: bool = False,
    refuse_late: bool = False,
    drain: bool = False,
) -> DataFrame:
    """Run a stream over all available input and return what it wrote.

    A checkpoint given again resumes behind the input already done. ``refuse_late``
    raises an error if a row came behind the watermark and was dropped, in any
    micro-batch. ``drain``: see :func:`start_parquet`.
    """
    spark = stream.sparkSession
    if path is None:
        path = scratch_dir(spark, "stream-out")
        delete_at_end(spark, path)
    if checkpoint is None:
        checkpoint = scratch_dir(spark, "stream-state")
        delete_at_end(spark, checkpoint)
    with counted_drops(spark) as drops:
        query = start_parquet(
            stream, path, checkpoint, mode, per_batch, partition_by, partitions, keep_batch, drain
        )
        try:
            if drain:
                query.processAllAvailable()
        finally:
            if drain:
                query.stop()
        query.awaitTermination()
        dropped = drops.of(query)
    if refuse_late and dropped:
        raise RuntimeError(f"{dropped} rows came behind the watermark")
    plain = mode == "append" and per_batch is None
    return (spark.read.schema(stream.schema) if plain else spark.read).parquet(path)


class Drops(StreamingQueryListener):
    """Adds up the rows that queries drop behind the watermark, over all micro-batches."""

    def __init__(self):
        self.rows: Counter[str] = Counter()
        self.ended: defaultdict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        for operator in event.progress.stateOperators:
            self.rows[str(event.progress.runId)] += operator.numRowsDroppedByWatermark

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, timeout: float = 120) -> int:
        """The rows that an ended query has dropped; waits for its last report."""
        run = str(query.runId)
        if not self.ended[run].wait(timeout):
            raise RuntimeError(f"no report of the end of query {run}")
        return self.rows[run]


@contextmanager
def counted_drops(spark: SparkSession):
    """A listener that counts the dropped rows of the queries run meanwhile."""
    drops = Drops()
    spark.streams.addListener(drops)
    try:
        yield drops
    finally:
        spark.streams.removeListener(drops)


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    drain: bool = False,
) -> None:
    """Hand every micro-batch of the available input to ``write``, then stop."""
    spark = stream.sparkSession
    if checkpoint is None:
        checkpoint = scratch_dir(spark, "stream-state")
        delete_at_end(spark, checkpoint)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    with streaming_settings(spark):
        query = (writer if drain else writer.trigger(availableNow=True)).start()
    try:
        if drain:
            query.processAllAvailable()
    finally:
        if drain:
            query.stop()
    query.awaitTermination()


def split_late(
    stream: DataFrame, path: str, checkpoint: str, delay_ms: int = 0, ms: str = "ms", drain: bool = False
) -> tuple[DataFrame, DataFrame]:
    """All rows of a stream as two branches: those in time, and those that came late.

    A row is late if it is behind the largest time of the micro-batches before its own
    by more than the delay, which is where a watermark would drop it. Nothing is dropped
    here. Each micro-batch leaves its largest time beside its rows, so a batch that is
    repeated, or a query that goes on from its checkpoint, splits alike.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        reached = None
        if batch_id:
            reached = spark.read.parquet(f"{path}/reached/{BATCH_ID}={batch_id - 1}").first()[0]
        mark = None if reached is None else reached - delay_ms
        batch.persist()
        try:
            late = F.lit(False) if mark is None else F.coalesce(F.col(ms) < mark, F.lit(False))
            batch.withColumn("late", late).write.mode("overwrite").parquet(f"{path}/rows/{BATCH_ID}={batch_id}")
            top = batch.agg(F.max(ms).cast("bigint").alias("reached"))
            top = top.select(F.greatest("reached", F.lit(reached).cast("bigint")).alias("reached"))
            top.write.mode("overwrite").parquet(f"{path}/reached/{BATCH_ID}={batch_id}")
        finally:
            batch.unpersist()

    run_batches(without_end(stream), write, checkpoint, drain)
    rows = spark.read.parquet(f"{path}/rows")
    return rows.filter("not late").drop("late"), rows.filter("late").drop("late")


def latest_values(updates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The last value per key of an update stream written batch by batch."""
    return updates.groupBy(*keys).agg(F.max_by(value, BATCH_ID).alias(value))


def _print_rows(rows) -> None:
    for row in rows:
        fields = (f"{name}={value}" for name, value in row.asDict().items())
        sys.stdout.write(" ".join(fields) + "\n")  # in one piece: other tasks print too
        sys.stdout.flush()


def show_stream(
    stream: DataFrame, label: str, mode: str = "append", tasks: int | None = None
) -> StreamingQuery:
    """Print every row of each micro-batch, marked with ``label``.

    Rows are printed by the tasks that hold them, to the executors' output; ``tasks``
    sets how many partitions print.
    """
    marked = stream.select(F.lit(label).alias("label"), "*")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.coalesce(tasks) if tasks else batch).foreachPartition(_print_rows)

    writer = marked.writeStream.outputMode(mode).queryName(label).foreachBatch(write)
    with streaming_settings(stream.sparkSession):
        return writer.start()
