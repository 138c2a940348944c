"""Session construction and shared-folder settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their RDDs are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The p-value expressions are long arithmetic chains; HotSpot refuses to
    # JIT methods over 8 kB of bytecode unless told otherwise.  Recommended
    # for executors on a cluster as well.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(
    master: str = "local[*]", shuffle_partitions: int = 8, app: str = "equiscope", **conf: str
) -> SparkSession:
    """A session for tests and local runs.  On a cluster use the session the
    platform provides; nothing here is required by the library."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def code_apart(df: DataFrame) -> DataFrame:
    """``df``, with code of its own for the projection at its top.

    Spark puts the arithmetic of all projections in a row into one method, and
    HotSpot only interprets methods over 8 kB of bytecode (see DEFAULT_CONF), which
    takes ten times as long.  A function on arrays keeps a projection out of that
    method; its code is then split into small ones, which are compiled."""
    first = df.columns[0]
    same = F.transform(F.array(F.col(first)), lambda x: x)
    return df.select(F.get(same, F.lit(0)).alias(first), *df.columns[1:])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring the cluster's
    ``spark.checkpoint.dir``.  Only when nothing is configured (local runs,
    tests) a private temporary folder is created."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    local = tempfile.mkdtemp(prefix="equiscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()
