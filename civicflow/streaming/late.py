"""Late rows kept apart in place of being lost.

A stream with a watermark drops rows behind it.  Here the bound is the job's
own: the greatest event time of the batches before, less a delay.  Each batch is
split in two feeds, on time and late; a late row carries the bound it missed.
The bounds are a table with one row per batch next to the feeds, so the step has
its state in the shared folder, and a batch that is repeated after a failure
overwrites its own rows with the same content.

``window_amendments`` turns the late feed into corrections of windows that were
closed when their rows came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.streaming.io import write_stream

BOUNDS = "bound_ms long, top_ms long, batch_id long"


def bound_before(spark: SparkSession, path: str, batch_id: int, delay_ms: int) -> int | None:
    """Rows of batch ``batch_id`` up to this event time are late (null: none)."""
    told = spark.read.schema(BOUNDS).parquet(f"{path}/bounds").where(F.col("batch_id") < batch_id)
    top = told.agg(F.max("top_ms")).first()[0]
    return None if top is None else top - delay_ms


def split_batch(path: str, delay_ms: int, t: str = "t_ms"):
    """The batch writer: ``on_time``, ``late`` and ``bounds`` under ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.createDataFrame([], BOUNDS).write.mode("append").partitionBy("batch_id").parquet(f"{path}/bounds")
        bound = bound_before(spark, path, batch_id, delay_ms)
        is_late = F.lit(False) if bound is None else F.coalesce(F.col(t) <= F.lit(bound), F.lit(False))
        batch = batch.withColumn("late", is_late)
        batch.where("NOT late").drop("late").write.mode("overwrite").parquet(f"{path}/on_time/batch_id={batch_id}")
        batch.where("late").drop("late").withColumn("bound_ms", F.lit(bound).cast("long")).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        top = batch.agg(F.max(t).alias("top_ms")).select(F.lit(bound).cast("long").alias("bound_ms"), "top_ms")
        top.write.mode("overwrite").parquet(f"{path}/bounds/batch_id={batch_id}")  # last: the batch is complete

    return write


def late_feed_job(rows: DataFrame, path: str, checkpoint: str, delay_ms: int, trigger: dict | None = None):
    """Start the split of a typed stream (``t_ms``); read the feeds with ``read_feeds``."""
    return write_stream(rows, "foreach_batch", checkpoint, trigger=trigger, writer=split_batch(path, delay_ms))


def read_feeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows on time, late rows with the bound they missed), with their batch."""
    return spark.read.parquet(f"{path}/on_time"), spark.read.parquet(f"{path}/late")


def window_counts(rows: DataFrame, size: str) -> DataFrame:
    return rows.groupBy(F.window("event_time", size).alias("window")).agg(F.count(F.lit(1)).alias("n_rows"))


def window_amendments(on_time: DataFrame, late: DataFrame, size: str) -> DataFrame:
    """Per window with late rows: rows on time, late rows, those of them that came
    after the window was closed (its end is not behind their bound), and all."""
    counted = late.withColumn("window", F.window("event_time", size))
    closed = F.unix_millis(F.col("window.end")) <= F.col("bound_ms")
    missed = counted.groupBy("window").agg(F.count(F.lit(1)).alias("n_late"), F.count_if(closed).alias("n_after_close"))
    kept = window_counts(on_time, size)
    return missed.join(kept, "window", "left").select(
        "window", F.coalesce("n_rows", F.lit(0)).alias("n_on_time"), "n_late", "n_after_close",
        (F.coalesce("n_rows", F.lit(0)) + F.col("n_late")).alias("n_rows"))
