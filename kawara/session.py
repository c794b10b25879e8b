"""Session defaults and the two helpers that cut lineage and ask about sizes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(master: str | None = None, app: str = "kawara", **conf) -> SparkSession:
    """A session with adaptive execution on; a cluster's own settings win over these."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # geometry is heavy on the processor: keep small shuffles parallel
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # codes such as "01100" in a partition path must stay strings
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session on this one machine may do without the setting; on a cluster a local folder
    would be a different one on every executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_code(df: DataFrame) -> DataFrame:
    """``df``, once Spark hands this package to Python workers that don't have it installed."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent
        bundle = f"{tempfile.mkdtemp(prefix='spark-')}/{root.name}.zip"  # read by the driver, which serves it
        with zipfile.ZipFile(bundle, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(bundle)
        _SHIPPED.add(sc.applicationId)
    return df


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, keeps iterative plans short.

    Nothing reads the shuffles behind it again, so their files go as soon as it is written.
    """
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # planned anew, under the setting
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast a table only after its row count was checked; otherwise leave it to Spark."""
    fixed = cut_lineage(df)
    n = fixed.limit(max_rows + 1).count()
    return F.broadcast(fixed) if n <= max_rows else fixed


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Rows over all cores when the input comes in fewer files than there are cores.

    A join with a broadcast side runs with the input's own parallelism; a single-file input
    would leave the cluster idle. Inputs of many files are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    # only the length crosses to Python: a large table has very many file names
    files = len(df._jdf.inputFiles())
    return df.repartition(cores, *cols) if 0 < files < cores else df
