"""Session helpers: building a session and locating the shared work folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; it is
only invented here (a fresh ``mkdtemp`` folder) when the session leaves it
unset, which is the case for local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    *,
    app_name: str = "vigil",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE on, the UI off and UTC as the session time zone."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoints cut lineage for one query; drop their files once the
        # checkpointed data is no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set to a fresh local folder only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="vigil-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # Checkpoint dirs come back as <configured>/<uuid>; keep tables beside them.
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per context.

    Functions of these modules travel by name, so workers started from another
    folder need the package itself.
    """
    sc = spark.sparkContext
    if getattr(sc, "_vigil_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="vigil-package-")
    target = os.path.join(folder, "vigil_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for top, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._vigil_shipped = True


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked through the cluster's file system API."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def shuffle_partitions(spark: SparkSession) -> int:
    """The configured shuffle partition count (the default bucket count)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = [
    "build_session",
    "ensure_checkpoint_dir",
    "path_exists",
    "ship_package",
    "shuffle_partitions",
    "work_path",
    "written",
]
