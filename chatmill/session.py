"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "chatmill") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CHATMILL_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none (local tests) is a private folder
    created and registered, so ``DataFrame.checkpoint()`` works too.
    """
    sc = spark.sparkContext
    path = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not path:
        path = sc.getCheckpointDir()
    if not path and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="chatmill-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


_TASK_MODULES = ("chatmill.operators.vocab", "chatmill.operators.pad_tasks", "chatmill.functions.subword")
_by_value: set = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Let Python workers run ``chatmill``'s task-side functions without the
    package installed: the modules that hold them are pickled by value into
    the task closures (cloudpickle's ``register_pickle_by_value``), so no
    file is shipped or written. Called by every operator that runs Python
    inside tasks, so they work whatever directory the driver started in."""
    import importlib

    from pyspark import cloudpickle
    for name in _TASK_MODULES:
        if name not in _by_value:
            cloudpickle.register_pickle_by_value(importlib.import_module(name))
            _by_value.add(name)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder for one staged table."""
    return f"{shared_dir(spark)}/chatmill-{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> str:
    """Write ``df`` as Parquet to a fresh path in the shared folder; it is
    deleted when the driver ends. Returns the path."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    delete_at_exit(df.sparkSession, path)
    return path


def delete_at_exit(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
