"""SparkSession helpers used by tests, the bench and the driver entry point."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only a local master (one
    machine, as in tests) may leave it unset; it then gets a scratch folder that
    is removed at exit. On a cluster an unset folder is an error, since executors
    do not see each other's disks."""
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read again: computed
    once however often it is used, and not lost with an executor."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ledgerlens") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # fall back from whole-stage codegen when a fused method is too big for the JIT (8000 bytes)
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
