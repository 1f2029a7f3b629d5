"""Scale helpers: scan-parallelism guard, materialisation under the shared root."""

from civicflow.session import materialize, shared_root
from civicflow.sources.telemetry import ensure_parallelism


def test_parallelism_guard_only_spreads_small_scans(spark, tmp_path):
    one = spark.range(100).coalesce(1)
    assert ensure_parallelism(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert ensure_parallelism(many, 4) is many


def test_materialize_writes_under_the_checkpoint_root(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    out = materialize(df, "unit")
    assert sorted(r.x for r in out.collect()) == list(range(10))
    root = shared_root(spark)
    paths = [f.replace("file://", "").replace("file:", "") for f in out.inputFiles()]
    own = f"{root}/civicflow/{spark.sparkContext.applicationId}/unit-"
    assert paths and all(p.startswith(own) for p in paths)


def test_release_leaves_other_applications_alone(spark, tmp_path, monkeypatch):
    from civicflow import session

    monkeypatch.setattr(session, "shared_root", lambda s: str(tmp_path))
    own = materialize(spark.range(3), "unit")
    other = tmp_path / "civicflow" / "application_2" / "unit-1"
    spark.range(3).write.parquet(str(other))
    assert own.count() == 3
    session.release(spark)
    assert not (tmp_path / "civicflow" / spark.sparkContext.applicationId).exists()
    assert spark.read.parquet(str(other)).count() == 3


def test_a_missing_library_of_the_subpackage_leaves_the_other_queries(monkeypatch):
    import sys

    import __spark_entry__ as entry

    before = {"bus_bunching", "ward_energy_stream_append"}
    for name in [m for m in sys.modules if m.startswith("civicflow.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tiktoken", None)  # import raises ImportError
    assert before <= set(entry.queries()) and not any(n.startswith("op1_") for n in entry.queries())
    assert before <= set(entry.oracle_sql())
