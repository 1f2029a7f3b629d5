"""Session construction and the shared storage root.

Every job in this package runs on a plain ``SparkSession``.  The builder here
only pins what the semantics depend on (UTC session time, RocksDB state store
for the stateful streaming operators, AQE) and leaves cluster sizing to the
deployment.  ``shared_root`` resolves the cluster-wide folder named by
``spark.checkpoint.dir``; it is used for streaming checkpoints and for every
table this package materialises to cut lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    master: str | None = None,
    app_name: str = "civicflow",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session configured for the telemetry jobs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_session_conf(spark)
    if not spark.conf.get("spark.sql.streaming.checkpointLocation", None):
        # Default root for streams started without their own checkpoint.
        spark.conf.set("spark.sql.streaming.checkpointLocation", f"{shared_root(spark)}/streams")
    return spark


def ship_code() -> None:
    """Let Python workers run this package's functions and stateful processors
    without an install on the executors: cloudpickle sends its code by value.
    (A deployment may ship it with ``--py-files`` instead; both work.)"""
    import sys

    from pyspark import cloudpickle

    try:
        cloudpickle.register_pickle_by_value(sys.modules["civicflow"])
    except Exception:  # already registered, or an old cloudpickle
        pass


def ensure_session_conf(spark: SparkSession) -> None:
    """Settings the operators rely on; safe to call on a caller's session."""
    ship_code()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    except Exception:  # already fixed by a running stream; keep the caller's value
        pass


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir``.  Only when a session with a local master
    has none (as in tests) a private folder is created and registered, so that
    later calls and ``DataFrame.checkpoint()`` use the same place; on a cluster
    executors would not share it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        pass
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="civicflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root (never reused between runs), in
    the folder of this application."""
    return f"{application_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def application_root(spark: SparkSession) -> str:
    """What this application writes under the shared root, which others may share."""
    return f"{shared_root(spark)}/civicflow/{spark.conf.get('spark.app.id', 'application')}"


def release(spark: SparkSession) -> None:
    """Remove everything this application has written under the shared root with
    this package; call it when no result that reads such a table is needed any
    more.  Other applications under the same root keep theirs."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(application_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared root and read it back.

    Cuts the lineage of an intermediate used several times (it is computed
    once, survives executor loss, and the planner sees its real size).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
