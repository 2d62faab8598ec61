"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings the operators rely on for their behaviour at scale. All of
# them can be changed on a running session, so ``configure`` also works on a
# session somebody else created.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Several plans aggregate on the join key right after the join. Without
    # this, AQE leaves a skewed join partition alone there, because splitting
    # it costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that writes rows of a few days keeps a file open for each, instead
    # of sorting all its rows by day first, which spills where tasks are large.
    "spark.sql.maxConcurrentOutputFileWriters": "40",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "tripaudit", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared scratch location.

    The cluster names that location in ``spark.checkpoint.dir``. Where it is
    unset (tests on one machine) the folder lies below the session's warehouse,
    which the executors share by definition; no setting is changed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch_dir``, on whatever store it lies; one that is gone is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
