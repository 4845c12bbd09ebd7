"""Incremental runs: only new input is read, each hop keeps its own checkpoint."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from millrace.operators.tables import latest_by
from millrace.sources.files import sub_folders

EachBatch = Callable[[DataFrame, int], None]
OTHER = "_other"  # rows of a multiplexed stream whose table is not known


class LateRows(StreamingQueryListener):
    """Rows dropped below the watermark, summed over all batches of each run."""

    def __init__(self):
        self.dropped: dict[str, int] = defaultdict(int)
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.runId)] += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


_late: dict[str, LateRows] = {}


def listener(spark: SparkSession) -> LateRows:
    app = spark.sparkContext.applicationId
    if app not in _late:
        _late[app] = LateRows()
        spark.streams.addListener(_late[app])
    return _late[app]


def new_files(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType | None = None,
              max_files: int | None = None, **options) -> DataFrame:
    """Files that arrived since the last run, including those present before the first."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """Follow a parquet table written by ``land`` or by batch appends."""
    return new_files(spark, path, "parquet", spark.read.parquet(path).schema)


def land(stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = (),
         wait: bool = True) -> StreamingQuery:
    """Append everything that is available, exactly once, then stop."""
    listener(stream.sparkSession)
    query = (
        stream.writeStream.format("parquet").partitionBy(*partition_by)
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    if wait:
        query.awaitTermination()
    return query


def each_batch(stream: DataFrame, fn: EachBatch, checkpoint: str, mode: str = "append",
               every: str | None = None) -> StreamingQuery:
    """Run ``fn`` per micro-batch over all that is available, or periodically when ``every`` is given."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    query = writer.start()
    if not every:
        query.awaitTermination()
    return query


def batch_dir(base: str, batch_id: int) -> str:
    return f"{base}/batch_id={batch_id}"


def write_batch(df: DataFrame, base: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """A micro-batch under its own directory: a repeated batch replaces itself."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(batch_dir(base, batch_id))


def batch_log(base: str, partition_by: Sequence[str] = ()) -> EachBatch:
    return lambda df, batch_id: write_batch(df, base, batch_id, partition_by)


def newest_rows(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """Per key the row of the newest micro-batch, for logs of update-mode aggregates."""
    return latest_by(spark.read.parquet(base), keys, ["batch_id"]).drop("batch_id")


def load_once(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType, target: str,
              checkpoint: str, **options) -> None:
    """Bulk load; running it again adds only files it has not loaded."""
    land(new_files(spark, path, fmt, schema, **options), target, checkpoint)


def ingest_folders(spark: SparkSession, base: str, fmt: str, schemas: Mapping[str, str | T.StructType],
                   target: str, checkpoints: str, **options) -> list[str]:
    """One table per sub-folder: all loads are started together, then awaited.

    The schema of a folder without a given one is inferred from the files that are there.
    """
    names = sub_folders(spark, base)

    def schema(n: str) -> str | T.StructType:
        return schemas[n] if n in schemas else spark.read.format(fmt).options(**{"inferSchema": True, **options}).load(f"{base}/{n}").schema

    running = [
        land(new_files(spark, f"{base}/{n}", fmt, schema(n), **options), f"{target}/{n}", f"{checkpoints}/{n}", wait=False)
        for n in names
    ]
    for query in running:
        query.awaitTermination()
    return names


# ---- keyed dedup ---------------------------------------------------------------------------

def drop_repeats(stream: DataFrame, event_time: str, delay: str, keys: Sequence[str],
                 bounded: bool = True) -> DataFrame:
    """First row per key, with late rows dropped below the watermark.

    ``bounded`` forgets keys once the watermark has passed them. The published
    form (``bounded=False``) remembers every key for ever, because the event
    time is not one of the keys.
    """
    marked = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    return marked.dropDuplicatesWithinWatermark(list(keys)) if bounded else marked.dropDuplicates(list(keys))


def late_rows(query: StreamingQuery) -> int:
    """Rows a finished run of ``land`` dropped below the watermark, in all of its batches."""
    counts, run = listener(SparkSession.active()), str(query.runId)
    if not counts.ended[run].wait(60):  # reports of a run come before that of its end
        raise RuntimeError(f"no report of the end of run {run}")
    return counts.dropped[run]


# ---- fan-out -------------------------------------------------------------------------------

def fan_out(target: str, key: str) -> EachBatch:
    """One stream to one table per key value; any number of values in a single write.

    The folders are named by the key as text; the key itself stays in the rows, with its type.
    """
    return lambda df, batch_id: write_batch(df.withColumn("_branch", F.col(key).cast("string")), target, batch_id, ["_branch"])


def read_branch(spark: SparkSession, target: str, key: str, value) -> DataFrame:
    """One table of a fan-out (NULL is a key like any other); the partition filter keeps the others unread."""
    found = spark.read.parquet(target).schema
    fields = [T.StructField("_branch", T.StringType()) if f.name == "_branch" else f for f in found.fields]
    rows = spark.read.schema(T.StructType(fields)).parquet(target)  # else 01 and 1 would become numbers
    wanted = F.lit(value).cast(found[key].dataType)
    folder = F.nullif(wanted.cast("string"), F.lit(""))  # an empty name is written as that of NULL
    return rows.filter(F.col("_branch").eqNullSafe(folder) & F.col(key).eqNullSafe(wanted)).drop("_branch", key, "batch_id")


def split_payload(feed: DataFrame, schemas: Mapping[str, str], table: str = "table_name",
                  data: str = "data") -> dict[str, DataFrame]:
    """A multiplexed change stream as one typed frame per table, and the rows of all other tables, unparsed, as OTHER."""
    others = [c for c in feed.columns if c not in (table, data)]
    rest = feed.filter(~F.coalesce(F.col(table).isin(list(schemas)), F.lit(False)))
    return {
        name: feed.filter(F.col(table) == name)
        .select(*others, F.from_json(data, ddl).alias("_d")).select(*others, "_d.*")
        for name, ddl in schemas.items()
    } | {OTHER: rest}


def history_and_latest(history: str, latest: str, keys: Sequence[str], order: Sequence[str]) -> EachBatch:
    """Two sinks from one pass: every row, and the batch's newest row per key."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            write_batch(df, history, batch_id)
            write_batch(latest_by(df, keys, order), latest, batch_id)
        finally:
            df.unpersist()
    return write
