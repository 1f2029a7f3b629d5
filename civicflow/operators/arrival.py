"""When the watermark passes an instant, in arrival order.

The watermark of a stream follows the greatest event time seen so far.  The
row at which it reaches a time ``v`` is the first arrival whose event time is
``v`` or more, so the running maximum over the arrivals turns into a suffix
minimum of arrival numbers over event time: per event-time bucket, and carried
over a table with one row a bucket.  Rows of one millisecond are one row before
that, so a bucket has at most ``2 * BUCKET_MS`` rows however many arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.operators.sequence import floor_div

BUCKET_MS = 60_000


def passing_arrivals(rows: DataFrame, later_ms: int, t: str = "t_ms", seq: str = "seq", bucket_ms: int = BUCKET_MS) -> DataFrame:
    """(t, passed): for every event time of ``rows`` the first arrival ``seq`` whose
    event time is at least ``later_ms`` later (null: none yet)."""
    firsts = rows.where(F.col(t).isNotNull()).groupBy(F.col(t).alias("_t")).agg(F.min(seq).alias("_seq"))
    points = firsts.select("_t", "_seq", F.lit(None).cast("long").alias("_asked")).unionByName(
        firsts.select((F.col("_t") + later_ms).alias("_t"), F.lit(None).cast("long").alias("_seq"), F.col("_t").alias("_asked")))
    points = points.withColumn("_b", floor_div(F.col("_t"), bucket_ms))
    # Going down in time; at equal times arrivals come before questions.
    down = Window.partitionBy("_b").orderBy(F.desc("_t"), F.col("_asked").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    inside = points.withColumn("_in", F.min("_seq").over(down))
    later = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    buckets = points.groupBy("_b").agg(F.min("_seq").alias("_m")).select("_b", F.min("_m").over(later).alias("_out"))
    return inside.where("_asked IS NOT NULL").join(buckets, "_b").select(F.col("_asked").alias(t), F.least("_in", "_out").alias("passed"))
