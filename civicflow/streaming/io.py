"""Stream sources and sinks.

Every stream is normalised to Kafka-shaped rows ``(topic, offset, value)``
with ``value`` a JSON string, whatever carries it:

* ``kafka``  the Kafka source (needs the spark-sql-kafka package on the
  cluster; only configured here, there is no broker in the test image);
* ``files``  JSON-lines files of such rows (replays, backfills and tests);
  ``maxFilesPerTrigger`` paces the replay like a rate-limited consumer.

Sinks: Parquet (append, exactly-once file sink, optional partitioning), Kafka
(``key``/``value`` rows), ``foreachBatch`` logs for update mode, console and
memory for debugging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.functions.jsonio import to_json_value
from civicflow.session import scratch_path

RECORD_SCHEMA = "topic string, offset long, value string"


def read_records(
    spark: SparkSession,
    source: str = "files",
    path: str | None = None,
    topics: list[str] | None = None,
    bounded: bool = False,
    options: dict | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """Kafka-shaped records from ``source`` (stream, or batch when ``bounded``);
    ``starting``: where a topic is read from without a checkpoint (``earliest``
    for replays, ``latest`` for live detectors)."""
    opts = dict(options or {})
    if source == "kafka":
        # (partition, offset) is the total arrival order of a topic.
        reader = spark.read if bounded else spark.readStream
        opts.setdefault("subscribe", ",".join(topics or []))
        opts.setdefault("startingOffsets", starting)
        if bounded:
            opts.setdefault("endingOffsets", "latest")
        raw = reader.format("kafka").options(**opts).load()
        return raw.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
    if source == "files":
        if path is None:
            raise ValueError("files source needs a path")
        if bounded:
            df = spark.read.schema(RECORD_SCHEMA).option("recursiveFileLookup", "true").json(path)
        else:
            opts.setdefault("recursiveFileLookup", "true")  # staged slices are folders
            df = spark.readStream.schema(RECORD_SCHEMA).options(**opts).json(path)
        if topics:
            df = df.filter(F.col("topic").isin(topics))
        return df
    raise ValueError(f"unknown source {source!r}")


def stage_records(
    records: DataFrame,
    path: str,
    slices: int = 4,
    order: str = "offset",
    files_per_slice: int = 1,
) -> int:
    """Write Kafka-shaped rows as JSON-lines files: consecutive ranges of
    ``order``, ``files_per_slice`` files per range, file times in the order of
    the ranges, so a file stream with ``maxFilesPerTrigger = files_per_slice``
    replays one range per micro-batch.

    The number of slices is the caller's: it decides the micro-batches, and
    with them what update mode publishes, so it never follows the table's size.
    ``files_per_slice`` is how many tasks share a range; it changes no result.
    Returns the number of slices written."""
    lo, hi = records.agg(F.min(order), F.max(order)).first()
    if lo is None:  # nothing to replay: still create the (empty) input folder
        records.select("topic", "offset", "value").write.mode("append").json(path)
        return 0
    staged = records.withColumn("_slice", slice_of(order, lo, hi, slices))
    return stage_slices(staged, path, "_slice", slices, files_per_slice)


def slice_of(order: str, lo: int, hi: int, slices: int):
    """The slice index ``stage_records`` gives a row (for delayed replays)."""
    width = (hi - lo) // slices + 1
    return F.expr(f"({order} - {lo}) div {width}")


def stage_slices(records: DataFrame, path: str, slice_col: str, slices: int, files_per_slice: int = 1) -> int:
    """Write explicit slices (``slice_col`` from 0 to ``slices`` - 1) in one job,
    every slice as exactly ``files_per_slice`` files; lets a replay deliver
    chosen records late.

    Rows are dealt to the files of their slice by a hash of topic and offset.
    Each file also gets an empty line (no record to a JSON reader), so that a
    slice with few rows or none has its full number of files."""
    spark = records.sparkSession
    rows = records.select(
        F.col(slice_col).cast("long").alias("slice"),
        F.pmod(F.xxhash64("topic", "offset"), F.lit(files_per_slice)).alias("part"),
        F.to_json(F.struct("topic", "offset", "value")).alias("value"),
    )
    blank = spark.range(slices * files_per_slice).select(
        F.expr(f"id div {files_per_slice}").alias("slice"),
        (F.col("id") % files_per_slice).alias("part"),
        F.lit("").alias("value"),
    )
    (rows.unionByName(blank)
     .repartition(slices * files_per_slice, "slice", "part")
     .write.mode("append").partitionBy("slice", "part").text(path))
    _date_slices(spark, path, slices)
    return slices


def _date_slices(spark: SparkSession, path: str, slices: int) -> None:
    """Give the files of slice i a modification time i seconds after those of
    slice 0: file streams read by modification time.  Touches names only."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    first = jvm.System.currentTimeMillis() - slices * 1000
    for i in range(slices):
        files = fs.listFiles(jvm.org.apache.hadoop.fs.Path(root, f"slice={i}"), True)
        while files.hasNext():
            fs.setTimes(files.next().getPath(), first + i * 1000, -1)


def kafka_rows(df: DataFrame, key: str | None = None, cols: list[str] | None = None) -> DataFrame:
    """Row shape of a Kafka sink: optional key, value = JSON of the row (nulls kept)."""
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), to_json_value(cols).alias("value"))


def publish(rows: DataFrame, topic: str, options: dict | None = None, acks: str = "all") -> None:
    """Batch write of ``(key, value)`` rows to a Kafka topic (a replay).

    Delivery is acknowledged by the brokers (``acks``) and retried by the
    producer inside Spark's Kafka sink; no client-side send loop."""
    opts = {"topic": topic, "kafka.acks": acks, **(options or {})}
    rows.select("key", "value").write.format("kafka").options(**opts).save()


def write_stream(
    df: DataFrame,
    sink: str,
    checkpoint: str,
    mode: str = "append",
    path: str | None = None,
    topic: str | None = None,
    partition_by: list[str] | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    options: dict | None = None,
    state_partitions: int | None = None,
    writer=None,
):
    """Start one streaming query with its own checkpoint.

    ``state_partitions`` fixes the number of shuffle/state partitions of the
    query (frozen in the checkpoint when the query first starts; size it to
    the state, not to the cluster's batch default)."""
    if state_partitions:
        conf = df.sparkSession.conf
        old = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            return write_stream(df, sink, checkpoint, mode, path, topic, partition_by, trigger,
                                query_name, options, writer=writer)
        finally:
            conf.set("spark.sql.shuffle.partitions", old)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if sink == "parquet":
        if partition_by:
            w = w.partitionBy(*partition_by)
        return w.format("parquet").start(path)
    if sink == "kafka":
        return w.format("kafka").option("topic", topic).start()
    if sink == "update_log":
        return w.foreachBatch(_update_log_writer(path)).start()
    if sink == "foreach_batch":
        return w.foreachBatch(writer).start()
    if sink in ("console", "memory", "noop"):
        return w.format(sink).start()
    raise ValueError(f"unknown sink {sink!r}")


def _update_log_writer(path: str):
    """Update-mode output as an append-only log: each micro-batch's changed rows
    under ``batch_id=N`` (overwritten on retry, so replays are idempotent)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def latest_from_update_log(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current value per key of an update log: the row of the last batch."""
    log = spark.read.parquet(path)
    cols = [c for c in log.columns if c not in keys and c != "batch_id"]
    best = F.max_by(F.struct(*cols), F.col("batch_id")).alias("_b")
    return log.groupBy(*keys).agg(best).select(*keys, *[F.col("_b")[c].alias(c) for c in cols])


def run_to_completion(query, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query, without a time limit unless one is
    given; raise its error if it failed."""
    finished = query.awaitTermination(timeout_s) if timeout_s else (query.awaitTermination() or True)
    if not finished:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()


def new_run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
