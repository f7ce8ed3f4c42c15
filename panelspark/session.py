"""SparkSession construction and the few settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs are written against. AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting handles hot join keys in
# the panel derivation; UTC keeps date casts identical to the DuckDB oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A join on (entity, date) may reuse a partitioning on entity alone, so a
    # join followed by a per-entity window shuffles once instead of twice.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Checkpoint files (lineage cuts) are deleted once no DataFrame refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "panelspark",
    extra: dict[str, str] | None = None,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    The library never makes up a folder: one on a single machine would not
    survive the loss of the executor that wrote it. Local runs name their own
    (``build_session(checkpoint_dir=...)``, the tests' fixture).
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
