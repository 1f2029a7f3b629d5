"""Versioned histories, corrections and the roll-ups that follow them."""

import random

import pytest
from conftest import frame
from pyspark.sql import functions as F

from civicflow.operators import windows
from civicflow.operators.history import History, WardRollup

KEY = ["ward_id", "window"]
SCHEMA = "meter_id string, ward_id string, kwh_reading double, voltage double, power_factor double"


def truth(spark, seed=1, days=40):
    rng = random.Random(seed)
    rows = [{"sec": rng.randrange(0, days * 86400), "meter_id": "m", "ward_id": rng.choice(["W1", "W2", "W 3/x+%y", None]), "kwh_reading": rng.random(),
             "voltage": 220 + rng.random(), "power_factor": rng.choice([None, 0.8, 0.9])} for _ in range(600)]
    return windows.with_window_date(windows.ward_energy_with_counts(frame(spark, rows, SCHEMA))).cache()


def rows_of(df):
    cols = sorted(df.columns)
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*cols).collect())


def damaged(df, day):
    """Rows of one day are missing, of another doubled in value, and one day is invented."""
    moved = F.struct((F.col("window.start") + F.expr("INTERVAL 400 DAYS")).alias("start"), (F.col("window.end") + F.expr("INTERVAL 400 DAYS")).alias("end"))
    extra = df.where(F.dayofmonth("date") == 3).withColumn("window", moved).withColumn("date", F.to_date("window.start"))
    kept = df.where((F.dayofmonth("date") != day) | (F.col("ward_id") != "W1"))
    return kept.withColumn("total_kwh_consumed", F.when(F.dayofmonth("date") == day + 1, F.col("total_kwh_consumed") * 2).otherwise(F.col("total_kwh_consumed"))).unionByName(extra)


@pytest.fixture
def table(spark, tmp_path):
    good = truth(spark)
    return good, History.create(damaged(good, 5), str(tmp_path / "h"), ["ward_id", "date"])


def test_a_correction_rewrites_only_what_differs(spark, table):
    good, history = table
    before, opened = history.manifest().collect(), history.read(1)
    old = rows_of(opened)
    version, changed = history.correct(good, KEY)
    assert version == 2 == History.open(spark, history.root).version()
    assert rows_of(history.read()) == rows_of(good) and rows_of(opened) == old == rows_of(history.read(1))
    told = {(r["ward_id"], r["date"]) for r in changed.collect()}
    days = {(r["ward_id"], r["date"]) for r in good.union(damaged(good, 5)).select("ward_id", "date").distinct().collect()}
    assert told == {(w, d) for w, d in days if d.day == 6 or d.year == 2025 or (d.day == 5 and w in ("W1", None))} and len(told) < len(days) / 3
    after = {r["folder"] for r in history.manifest().collect()}
    untouched = {r["folder"] for r in before if (r["ward_id"], r["date"]) not in told}
    assert untouched < after and not {r["folder"] for r in before if (r["ward_id"], r["date"]) in told} & after
    assert history.correct(good, KEY)[0] == 2  # nothing differs any more


def test_small_differences_of_sums_are_none(table):
    good, history = table
    history.correct(good, KEY)
    noisy = good.withColumn("total_kwh_consumed", F.col("total_kwh_consumed") * (1 + 1e-13))
    assert history.correct(noisy, KEY)[0] == 2 and history.correct(noisy, KEY, tolerance=1e-15)[0] == 3


def test_a_lost_writer_leaves_the_table_as_it_was(table):
    good, history = table
    old = rows_of(history.read())
    history._write(good, 2)  # folders are written, the manifest never is
    assert history.version() == 1 and rows_of(history.read()) == old
    history.correct(good, KEY)
    with pytest.raises(RuntimeError, match="another writer"):
        history._commit(history.manifest(1), 2)
    assert rows_of(history.read()) == rows_of(good)


def test_append_and_empty_truth(spark, table):
    good, history = table
    history.correct(good, KEY)
    later = good.where(F.dayofmonth("date") == 7).withColumn("n_readings", F.lit(0).cast("long"))
    assert history.append(later) == 3 and history.read().count() == good.count() + later.count()
    assert history.correct(good.where("false"), KEY)[0] == 4 and history.read().count() == 0
    assert history.read().columns == good.columns


def test_rollups_follow_corrections(spark, table, tmp_path):
    good, history = table
    rollup = WardRollup(history, str(tmp_path / "r"))
    read = []
    for day in (5, 12, 20):
        history.correct(damaged(good, day), KEY)
        read.append(rollup.refresh().count())
        for unit in ("week", "month"):
            assert rows_of(rollup.totals(unit)) == rows_of(windows.rollup_history(history.read(), unit))
    history.correct(good, KEY)
    assert rollup.refresh().count() < read[0] / 3 and max(read[1:]) < read[0] / 3  # later refreshes read changed partitions only
    assert rollup.refresh().count() == 0
    for unit in ("week", "month"):
        assert rows_of(rollup.totals(unit)) == rows_of(windows.rollup_history(good, unit))


def test_only_the_named_partitions_are_opened(table):
    good, history = table
    only = good.where("ward_id = 'W2' AND dayofmonth(date) < 4").select("ward_id", "date").distinct()
    part = history.read(only=only)
    assert 0 < len(part.inputFiles()) == only.count() and rows_of(part) == rows_of(good.where("ward_id = 'W2' AND dayofmonth(date) < 4"))
