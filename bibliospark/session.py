"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes.  Time zone: the reference stores
# naive timestamps, so all parsing / formatting happens in UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoints written by the global-order operators are removed once
    # their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # long pipelines run many small jobs: keep the driver's status history short
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def get_session(master: str | None = None, app: str = "bibliospark", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the package defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster in
    ``spark.checkpoint.dir``; we never invent one there.  Only a local-mode
    session without the setting (tests, laptops) gets a private temp folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="bibliospark-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: operators that cut lineage need a "
            "shared checkpoint folder on the cluster"
        )
    return sc.getCheckpointDir()


_SCRATCH: list[list[str]] = []   # paths of the open ``scratch_collected`` blocks


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back.

    Like ``checkpoint()`` it cuts the lineage to files every executor can
    read; unlike it, later plans prune columns and know the true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_collected(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``written_once`` writes inside the block when it ends.

    For jobs that have written their results by then: DataFrames built inside
    can't be read afterwards."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in map(jvm.org.apache.hadoop.fs.Path, _SCRATCH.pop()):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Nothing is done where workers find it already: it was shipped as a zip,
    or its folder is on the ``PYTHONPATH`` that Spark was started with."""
    sc = spark.sparkContext
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(here)
    known = (sc._jvm.System.getenv("PYTHONPATH") or "").split(os.pathsep)
    if not os.path.isdir(here) or root in map(os.path.abspath, filter(None, known)) or getattr(sc, "_bibliospark", None):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="bibliospark-"), "bibliospark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)   # Spark sends it to the executors
    sc._bibliospark = path
