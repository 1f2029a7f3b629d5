import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicflow.operators.sequence import with_lookahead, with_lookback


def _random_rows(n, keys, seed):
    rnd = random.Random(seed)
    return [(rnd.choice(keys), rnd.randrange(0, 50) * 1000 * rnd.choice([1, 7, 300]), i, rnd.random())
            for i in range(n)]


def test_lookback_equals_window_lag(spark):
    rows = _random_rows(600, ["hot"] * 8 + ["a", "b"], seed=7)  # one key holds most rows
    df = spark.createDataFrame(rows, "k string, t long, seq long, v double")
    got = with_lookback(df, "k", "t", "seq", ["v"], 3, bucket_ms=20_000)
    w = Window.partitionBy("k").orderBy("t", "seq")
    exp = df.select("seq", *[F.lag("v", j).over(w).alias(f"v_lag{j}") for j in (1, 2, 3)])
    a = sorted(tuple(r) for r in got.select("seq", "v_lag1", "v_lag2", "v_lag3").collect())
    b = sorted(tuple(r) for r in exp.collect())
    assert a == b


def test_lookahead_equals_window_lead(spark):
    rows = _random_rows(400, ["x", "y"], seed=3)
    df = spark.createDataFrame(rows, "k string, t long, seq long, v double")
    got = with_lookahead(df, "k", "t", "seq", ["seq"], bucket_ms=15_000)
    w = Window.partitionBy("k").orderBy("t", "seq")
    exp = df.select("seq", F.lead("seq", 1).over(w).alias("seq_next"))
    assert sorted(tuple(r) for r in got.select("seq", "seq_next").collect()) == sorted(tuple(r) for r in exp.collect())


def test_lookback_of_the_order_column_itself(spark):
    rows = _random_rows(200, ["a", "b"], seed=5)
    df = spark.createDataFrame(rows, "k string, t long, seq long, v double")
    got = with_lookback(df, "k", "t", "seq", ["t", "v"], 1, bucket_ms=10_000)
    w = Window.partitionBy("k").orderBy("t", "seq")
    exp = df.select("seq", F.lag("t", 1).over(w).alias("t_lag1"), F.lag("v", 1).over(w).alias("v_lag1"))
    assert sorted(tuple(r) for r in got.select("seq", "t_lag1", "v_lag1").collect()) == sorted(tuple(r) for r in exp.collect())
