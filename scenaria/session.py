"""Session construction and lineage cutting.

On a cluster the session comes from the platform; ``checkpoint_dir`` only reads
``spark.checkpoint.dir`` and sets a scratch folder when it is unset (local tests).
"""

from __future__ import annotations

import tempfile

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
LOCAL_CONF = {"spark.driver.memory": "16g"}  # local mode: the driver JVM is the only executor


def get_spark(app: str = "scenaria", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    local = {} if not master or not master.startswith("local") else LOCAL_CONF
    for k, v in {**DEFAULT_CONF, **local, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.  Where it is unset, a local
    session (tests) gets a scratch folder; on a cluster that is an error, for executors could not see it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except PySparkNotImplementedError:  # Spark Connect: the server owns the checkpoint folder
        return d or ""
    d = d or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="scenaria-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
