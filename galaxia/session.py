"""Session helpers: building a local session for tests/bench, and locating the
shared checkpoint folder the cluster names."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "galaxia") -> SparkSession:
    """A session for tests and the benchmark. Cluster jobs bring their own."""
    master = master or os.environ.get("GALAXIA_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("GALAXIA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; the one the cluster names wins.

    Order: the SparkContext's folder, then ``spark.checkpoint.dir`` from the
    session conf.  Only a local session without it (tests, the benchmark) gets a
    fresh temp folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:   # a Spark Connect session exposes no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and sc is not None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if sc is not None and sc.master.startswith("local"):
            named = tempfile.mkdtemp(prefix="galaxia-ckpt-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc is None:
        return named
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


# Sub-folder for the intermediate tables of the current unit of work (a stored
# batch sets it, so it can drop them after publishing).  A context variable, so
# worker threads started with a copied context write to the same place.
SCRATCH_SCOPE: contextvars.ContextVar[str | None] = contextvars.ContextVar("galaxia_scratch", default=None)


def scratch_root(spark) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/galaxia-tables"
    scope = SCRATCH_SCOPE.get()
    return f"{base}/{scope}" if scope else base


@contextlib.contextmanager
def scratch_scope(spark, name: str):
    """Intermediate tables written inside go to one folder of their own, which is
    removed at the end: nothing read later may come from them."""
    import uuid

    token = SCRATCH_SCOPE.set(f"{name}-{uuid.uuid4().hex}")
    folder = scratch_root(spark)
    try:
        yield folder
    finally:
        SCRATCH_SCOPE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str = "tmp"):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder
    and read it back.  Columnar, so later passes read only the columns they
    need, and zstd halves the ids; the folder is the one the cluster names
    (``spark.checkpoint.dir``)."""
    import uuid

    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
