"""Session helpers. The caller owns the SparkSession; nothing here creates one."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the jobs are designed for; apply them when building a session.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the SparkContext or ``spark.checkpoint.dir``. Only a local-mode
    session without one gets a private temporary folder; on a cluster an
    unset value is an error, because a machine-local folder would not
    survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf and sc.master.startswith("local"):
        conf = tempfile.mkdtemp(prefix="tierlake-checkpoint-")
    if not conf:
        raise RuntimeError("Set spark.checkpoint.dir to a shared folder before running the jobs.")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf
