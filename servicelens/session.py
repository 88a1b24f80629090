"""Session helpers.

Library functions never create sessions; they use the one their input
DataFrames belong to.  ``local_session`` is for tests, benchmarks and the
command line.  ``checkpoint_dir`` reads the shared folder the cluster names
in ``spark.checkpoint.dir`` and only falls back to a scratch folder when the
setting is absent (local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g", extra=None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName("servicelens")
    conf = dict(DEFAULTS)
    conf.update({"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": memory})
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a scratch one only where unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        # Local runs and tests only: one JVM, so a scratch folder is shared.
        configured = tempfile.mkdtemp(prefix="servicelens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    import uuid

    base = checkpoint_dir(spark)
    path = os.path.join(base, f"servicelens-{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


# Folders handed out by this driver, until release_scratch removes them.
_SCRATCH: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Remove the intermediate tables this driver has written; results that
    still read them cannot be read any more.  Returns their number."""
    return _remove(spark, list(_SCRATCH))


def remove_scratch(spark: SparkSession, folders: set[str]) -> int:
    """Remove those of the folders that ``scratch_path`` has given out; other
    folders stay.  Their names are unique, so a URI's scheme does not matter."""
    names = {folder.rsplit("/", 1)[-1] for folder in folders}
    return _remove(spark, [path for path in _SCRATCH if os.path.basename(path) in names])


def _remove(spark: SparkSession, paths: list[str]) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        _SCRATCH.remove(path)
    return len(paths)


def input_version(spark: SparkSession, folder: str) -> tuple:
    """Name, length and modification time of everything in a folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(conf).listStatus(p)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))
