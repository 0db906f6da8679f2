"""Session construction and the shared checkpoint folder.

Jobs never pick a machine-local folder on a cluster: the checkpoint folder
comes from ``spark.checkpoint.dir`` as configured by the cluster.  Only a
local master (tests, benchmarks) may fall back to a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


#: Rows that go to a Python worker at once; Spark's own 10,000 are 30 MB of text or more.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(master: str | None = None, app: str = "penmark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    UTC session time (date features and oracle parity), AQE with partition
    coalescing and skew-join splitting, Arrow for the pandas boundary, UI off.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        ARROW_ROWS: "2048",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the executors' Python workers.

    The pandas UDFs (list-literal fallback, kNN block kernel, batch
    inference) are pickled by reference to their module, so every worker must
    be able to import ``penmark``.  A zip of the package is registered with
    ``addPyFile`` (Spark ships it to every executor) once per application.
    A session that leaves Spark's batch size for the workers gets the package's.
    """
    sc = spark.sparkContext
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2048")
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="penmark-pkg-"), "penmark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  When nothing is set and the master is local, a scratch
    folder is created and registered, which is what tests do; on a cluster an
    unset folder is an error instead of a silent machine-local path.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="penmark-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage by writing a Parquet table into the shared checkpoint
    folder and reading it back.

    Unlike an eager ``Dataset.checkpoint`` (one job to count, a second that
    recomputes the plan to write it), the plan runs once; the result is
    splittable and column-pruned, and it survives lost executors because it
    lives on the shared file system.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
