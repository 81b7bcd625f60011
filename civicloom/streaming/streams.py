"""Streaming forms of ingest, silver and the daily mart.

They share their column logic with the batch operators, so a stream that has seen
all files holds what a batch over those files gives.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from civicloom.functions.columns import timestamp_literal
from civicloom.functions.windows import keep_latest
from civicloom.operators.marts import DAILY_MEASURES, daily_aggregates, daily_from_parts, daily_parts
from civicloom.session import stage_path
from civicloom.sources.readers import read_optional

_BATCH = "batch_id"


def stream_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files: int = 1000,
    **options: object,
) -> DataFrame:
    """Files under ``path``, each read exactly once; the checkpoint replaces a saved mark."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "json":
        reader = reader.option("multiLine", True).option("mode", "DROPMALFORMED")
    return reader.options(**options).format(fmt).load(path)


def write_batches(
    sdf: DataFrame,
    target: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    mode: str = "append",
) -> StreamingQuery:
    """Run over everything available, one partition of ``target`` per micro-batch.

    A micro-batch that is replayed after a failure overwrites its own partition.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(shape(batch), batch_id, target)

    return (
        sdf.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_keep_latest(
    sdf: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[Column],
    ties: Sequence[Column] = (),
) -> StreamingQuery:
    """Append each micro-batch's newest record per key.

    A batch writes only its own rows, never the table. ``latest_view`` settles keys
    seen in several batches, and ``compact`` folds old batches into a base beside them.
    """
    return write_batches(sdf, target, checkpoint, lambda batch: keep_latest(batch, keys, order, ties))


def latest_view(
    spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[Column], ties: Sequence[Column] = ()
) -> DataFrame:
    """Newest record per key over the last compacted base and the batches since; of equal ones, the later batch wins."""
    rows = _live_rows(spark, target)
    return keep_latest(rows, keys, order, [*ties, F.desc(_BATCH)]).drop(_BATCH)


_BUCKET = "key_bucket"
#: Parts of a new base, by the hash of the key; a base keeps the number it began with.
BUCKETS = 64


def _base_path(target: str) -> str:
    return f"{target.rstrip('/')}.base"


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(s.getPath().getName()) for s in files.listStatus(path)] if files.exists(path) else []


@dataclass(frozen=True)
class _Base:
    """A complete base: the batches up to ``upto``, in buckets that lie where their last compaction wrote them."""

    upto: int
    buckets: int
    parts: dict[int, int]  # bucket: the compaction whose folder holds it


def _newest_base(spark: SparkSession, target: str) -> _Base | None:
    folder = f"{_base_path(target)}/manifests"
    done = [n for n in _listed(spark, folder) if "_SUCCESS" in _listed(spark, f"{folder}/{n}")]
    if not done:
        return None
    upto = max(int(n.removeprefix("upto=")) for n in done)
    rows = spark.read.parquet(f"{folder}/upto={upto}").collect()  # one row a bucket
    return _Base(upto, rows[0]["buckets"], {r["bucket"]: r["written"] for r in rows if r["bucket"] is not None})


def _base_rows(spark: SparkSession, target: str, parts: Mapping[int, int], like: DataFrame) -> DataFrame:
    paths = [f"{_base_path(target)}/upto={written}/{_BUCKET}={bucket}" for bucket, written in sorted(parts.items())]
    return (spark.read.parquet(*paths) if paths else like.limit(0)).select(like.columns)


def _live_rows(spark: SparkSession, target: str) -> DataFrame:
    base, rows = _newest_base(spark, target), spark.read.parquet(target)
    if base is None:
        return rows
    return rows.filter(F.col(_BATCH) > base.upto).unionByName(_base_rows(spark, target, base.parts, rows))


def compact(
    spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[Column], ties: Sequence[Column] = (), buckets: int = BUCKETS
) -> int:
    """Fold the batches written so far into a base beside ``target``; returns the last batch in it.

    The base is in buckets by the hash of the key. Only buckets that the new batches have keys of are
    read and written again; the others stay where they are, and a manifest, written last,
    says where each one lies. The stream goes on writing to ``target``. Readers take the newest
    complete manifest and the batches after it, so a crash in between changes nothing, and a scan
    no longer opens the folded batches. ``retire`` deletes them.
    """
    rows = spark.read.parquet(target)
    last = rows.agg(F.max(_BATCH)).first()[0]
    base = _newest_base(spark, target) or _Base(-1, buckets, {})
    if last is None or last == base.upto:
        return base.upto
    new = rows.filter((F.col(_BATCH) > base.upto) & (F.col(_BATCH) <= last))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(base.buckets)).cast("int")
    touched = {r[0] for r in new.select(bucket).distinct().collect()}  # at most as many as buckets
    old = _base_rows(spark, target, {k: v for k, v in base.parts.items() if k in touched}, rows)
    newest = keep_latest(new.unionByName(old), keys, order, [*ties, F.desc(_BATCH)]).withColumn(_BUCKET, bucket)
    newest.hint("rebalance", _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        _BUCKET
    ).parquet(f"{_base_path(target)}/upto={last}")
    parts = base.parts | dict.fromkeys(touched, last)
    manifest = [(base.buckets, k, v) for k, v in sorted(parts.items())] or [(base.buckets, None, None)]
    spark.createDataFrame(manifest, "buckets int, bucket int, written bigint").coalesce(1).write.mode("overwrite").parquet(
        f"{_base_path(target)}/manifests/upto={last}"
    )
    return last


def retire(spark: SparkSession, target: str) -> int:
    """Delete batches that the newest base holds, and what older bases alone hold; returns how many folders.

    The newest folded batch stays, so that the table keeps a schema to be read by. To be
    called when no reader started before the last ``compact``.
    """
    base = _newest_base(spark, target)
    if base is None:
        return 0
    folder = _base_path(target)
    numbers = [int(n.split("=")[1]) for n in _listed(spark, target) if n.startswith(f"{_BATCH}=")]
    old = [f"{target}/{_BATCH}={n}" for n in numbers if n < base.upto]
    for name in _listed(spark, folder):
        written = int(name.removeprefix("upto=")) if name.startswith("upto=") else base.upto + 1
        if written <= base.upto:
            parts = [n for n in _listed(spark, f"{folder}/{name}") if n.startswith(f"{_BUCKET}=")]
            dead = [n for n in parts if base.parts.get(int(n.split("=")[1])) != written]
            old += [f"{folder}/{name}"] if len(dead) == len(parts) else [f"{folder}/{name}/{n}" for n in dead]
    old += [f"{folder}/manifests/{n}" for n in _listed(spark, f"{folder}/manifests") if int(n.removeprefix("upto=")) < base.upto]
    files = spark._jvm.org.apache.hadoop.fs.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    for path in old:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    return len(old)


def stream_daily(silver: DataFrame, delay: str = "1 day", ts_col: str = "created_date") -> DataFrame:
    """The daily mart over one-day tumbling windows of event time.

    Rows later than ``delay`` behind the newest event are dropped by the watermark,
    and Spark reports how many in the query's progress. A watermark needs a zoned
    timestamp; days are cut in UTC, so the session's time zone must be UTC.
    """
    return (
        silver.withColumn("_at", F.col(ts_col).cast("timestamp_ltz"))
        .withWatermark("_at", delay)
        .groupBy(F.window("_at", "1 day").alias("w"), "borough")
        .agg(*daily_aggregates())
        .select(F.col("w.start").cast("date").alias("complaint_date"), F.col("*"))
        .drop("w")
    )


def run_daily(silver: DataFrame, delay: str = "1 day") -> DataFrame:
    """Run the daily stream over what is available and return the table it built.

    Each micro-batch emits the windows it changed; the newest emission of a window holds.
    """
    spark = silver.sparkSession
    target, checkpoint = stage_path(spark, "daily"), stage_path(spark, "daily-checkpoint")
    write_batches(stream_daily(silver, delay), target, checkpoint, mode="update").awaitTermination()
    rows = spark.read.parquet(target)
    return keep_latest(rows, ["complaint_date", "borough"], [F.desc(_BATCH)]).drop(_BATCH)


DAILY_PARTS = T.StructType([
    T.StructField("complaint_date", T.DateType()), T.StructField("borough", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in DAILY_MEASURES if c != "avg_resolution_days"],
    T.StructField("settled_days", T.LongType()), T.StructField("settled_rows", T.LongType()),
])


def _write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    rows.withColumn(_BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(_BATCH).parquet(path)


def _mark_before(spark: SparkSession, target: str, batch_id: int):
    """The newest event time in the batches before this one; replaying a batch finds the same."""
    if read_optional(spark, f"{target}/marks") is None:
        return None
    marks = spark.read.schema(f"newest timestamp_ntz, {_BATCH} bigint").parquet(f"{target}/marks")
    return marks.filter(F.col(_BATCH) < batch_id).agg(F.max("newest")).first()[0]


def split_daily(
    silver: DataFrame, target: str, checkpoint: str, delay: str = "1 day", ts_col: str = "created_date"
) -> StreamingQuery:
    """The daily mart of a stream with no row lost: what comes too late goes to a table beside it.

    Within each micro-batch a row is late if its whole day is more than ``delay`` behind the newest
    event of the batches before, as a watermark would have it; rows without a time are set
    aside likewise. ``target/daily`` gets the sums of the others by day, ``target/late`` the
    late rows with ``late_reason``, ``target/marks`` the newest event time, all under the batch's id,
    the mark last. A batch replayed after a failure finds the same marks and overwrites its own
    partitions. Nothing is kept in state, and days stay open for no longer than their sums.
    """
    spark = silver.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = _mark_before(spark, target, batch_id)
        time = F.col(ts_col)
        day_ends = F.date_add(time.cast("date"), 1).cast("timestamp_ntz")
        reason = F.when(time.isNull(), "no_time")
        if mark is not None:
            horizon = timestamp_literal(mark) - F.expr(f"INTERVAL '{delay}'")
            reason = reason.when(day_ends <= horizon, "late")
        # Three outputs of one reading of the files.
        rows = batch.withColumn("late_reason", reason).persist(StorageLevel.DISK_ONLY)
        try:
            on_time = rows.filter("late_reason IS NULL")
            by_day = on_time.groupBy(time.cast("date").alias("complaint_date"), "borough").agg(*daily_parts())
            _write_batch(by_day, batch_id, f"{target}/daily")
            _write_batch(rows.filter("late_reason IS NOT NULL"), batch_id, f"{target}/late")
            _write_batch(rows.agg(F.max(time).cast("timestamp_ntz").alias("newest")), batch_id, f"{target}/marks")
        finally:
            rows.unpersist()

    return (
        silver.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def split_daily_view(spark: SparkSession, target: str) -> DataFrame:
    """The daily mart over what ``split_daily`` took in time."""
    return daily_from_parts(spark.read.schema(DAILY_PARTS).parquet(f"{target}/daily"))


def late_view(spark: SparkSession, target: str, silver: T.StructType) -> DataFrame:
    """The rows that ``split_daily`` set aside, with their reason and batch."""
    schema = T.StructType([*silver.fields, T.StructField("late_reason", T.StringType()), T.StructField(_BATCH, T.LongType())])
    return spark.read.schema(schema).parquet(f"{target}/late")


class LateRows(StreamingQueryListener):
    """Adds up what watermarks drop, by query id, for as long as it is registered.

    A query itself only remembers its last hundred progress records. Spark counts after
    the partial aggregation, so a window's late rows in one task count once.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        progress = event.progress
        found = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        self.dropped[str(progress.id)] = self.dropped.get(str(progress.id), 0) + found

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        pass


def late_row_count(listener: LateRows, query: StreamingQuery) -> int:
    """What the watermark dropped of a finished query since the listener was registered."""
    query.awaitTermination()
    query._jsq.sparkSession().sparkContext().listenerBus().waitUntilEmpty()
    return listener.dropped.get(str(query.id), 0)
