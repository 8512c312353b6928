"""Spark session defaults and shared-storage locations.

Everything here is plain session configuration.  The library never picks a
machine-local folder on its own: table roots and checkpoint folders come from
the session (``strata.warehouse``, ``spark.checkpoint.dir`` or Spark's own
``spark.sql.warehouse.dir``), which on a cluster name shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; each is only applied when the session has not
# set it already, so a cluster profile always wins.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Post-shuffle partitions of ~256 MB; AQE coalesces or splits around it.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Parquet data written by the store is always read with its own schema.
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "strata", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session; scale defaults fill only unset keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_scale_defaults(spark, explicit=conf)
    return spark


def apply_scale_defaults(spark: SparkSession, explicit: dict | None = None) -> None:
    """Set each scale default unless the caller or the cluster profile
    (spark-defaults / spark-submit) already set that key."""
    cluster = spark.sparkContext.getConf()
    for key, value in SCALE_DEFAULTS.items():
        if (explicit and key in explicit) or cluster.contains(key):
            continue
        spark.conf.set(key, value)


def warehouse_root(spark: SparkSession) -> str:
    """Root folder of the versioned table store.

    ``strata.warehouse`` if set, else ``<spark.sql.warehouse.dir>/strata``.
    """
    root = spark.conf.get("strata.warehouse", None)
    if root:
        return root.rstrip("/")
    base = spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse"
    return base.rstrip("/") + "/strata"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, falling back to the warehouse.

    ``spark.checkpoint.dir`` is read from the session.  When it is unset the
    checkpoint goes below the table warehouse, which is shared storage by
    definition, and the SparkContext is pointed at it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    target = configured or (warehouse_root(spark) + "/_checkpoints")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
