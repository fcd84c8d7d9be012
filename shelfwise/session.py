"""Session construction and the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness (time zone, ANSI) and for the plan
# shape at scale (AQE coalescing, skew-join splitting, runtime broadcast
# decisions based on measured sizes).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # per-key streaming state (fines, audit) can reach billions of keys:
    # keep it in RocksDB rather than on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "shelfwise", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches; on a cluster use the cluster's own."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_SET: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``, registered once per application. Unset, a
    scratch folder is created for a local master; on a cluster that is an
    error, as executors would write to their own disks."""
    app = spark.sparkContext.applicationId
    if app not in _SET:
        path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not path:
            if not spark.sparkContext.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
            spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
        _SET[app] = path
    return _SET[app]


def materialize(df):
    """Cut lineage at ``df``: a reliable checkpoint written to the shared
    ``spark.checkpoint.dir`` (never a local checkpoint), so outputs derived
    from ``df`` neither recompute it nor lose it with an executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
