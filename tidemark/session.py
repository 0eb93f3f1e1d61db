"""Session factory and the shared scratch space that lineage cuts are written to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
#: Tables written by ``materialize`` that are still there, with their sessions.
_WRITTEN: dict[str, SparkSession] = {}


def session(app: str = "tidemark", cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings every query here is tested under."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    On a cluster that is the one ``spark.checkpoint.dir`` names.  Where the setting is absent (tests, laptops) a
    temporary folder of this machine is used, which is only right because every executor then lives on it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        _LOCAL_SCRATCH[app] = folder
        atexit.register(shutil.rmtree, folder, True)
        spark.sparkContext.setCheckpointDir(folder)
    return "file://" + _LOCAL_SCRATCH[app]


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage as a checkpoint does, but columnar and compressed, and a lost executor only costs a re-read.  The
    table goes with ``discard``, or when the process ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    track(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def track(spark: SparkSession, path: str) -> None:
    """``path`` goes when the process ends."""
    if not _WRITTEN:
        atexit.register(_discard_all)
    _WRITTEN[path] = spark


def discard(df: DataFrame) -> None:
    """Delete the table that ``materialize`` wrote for ``df``; nothing may read it any more."""
    path = getattr(df, "_scratch", None)
    if path in _WRITTEN:
        _delete(_WRITTEN.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _discard_all() -> None:
    for path, spark in list(_WRITTEN.items()):
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone; local files are deleted without it
            local = path.removeprefix("file://")
            if "://" not in local:
                shutil.rmtree(local, True)
    _WRITTEN.clear()


def default_data_dir() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
