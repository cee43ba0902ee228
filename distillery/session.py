"""SparkSession construction and lineage-cut helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets. AQE re-plans joins from runtime sizes (broadcast only
# when the measured side is small, skew-join splitting for hot keys) and coalesces
# small shuffle partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "distillery",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the cluster's shared ``spark.checkpoint.dir``. Only a local-mode session
    (tests) without one gets a fresh scratch folder; on a cluster nothing machine-local
    is ever used -- :func:`cut_lineage` then refuses to run until the setting exists."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            return None
        configured = tempfile.mkdtemp(prefix="distillery-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss;
    never a local checkpoint)."""
    if ensure_checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before cutting lineage")
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Compute an intermediate once for several consumers: a reliable checkpoint into the
    shared checkpoint dir when one is configured (lineage cut, survives executor loss),
    otherwise a memory-and-disk persist (recomputed from lineage if blocks are lost)."""
    from pyspark import StorageLevel

    if ensure_checkpoint_dir(df.sparkSession) is not None:
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)
