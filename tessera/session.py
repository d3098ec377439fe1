"""Session construction and shared scratch locations.

Everything that has to be written between stages (round-trip sinks, lineage
cuts, streaming checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``.  We only fall back to a folder of our own when the
session does not name one (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
#: A local master computes in the driver; elsewhere its memory is the cluster's to set.
_LOCAL_CONF = {"spark.driver.memory": "16g"}


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**_DEFAULT_CONF, **(_LOCAL_CONF if (master or "").startswith("local") else {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one only when the session has none."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
        d = os.path.join(tempfile.gettempdir(), "tessera-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-scratch/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compiled(spark: SparkSession) -> None:
    """For queries with long projections.  The JVM never compiles a method of more
    than 8000 bytes of code, but interprets it; a stage that would need such a
    method is run operator by operator instead, in shorter ones."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def spread(df: DataFrame) -> DataFrame:
    """A frame read in fewer partitions than there are cores, dealt over all of
    them; any other stays as it is.  A file of one row group is one task, and
    so would be all that follows without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
