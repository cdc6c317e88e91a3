"""Session helpers.

The library never creates a cluster session behind the caller's back: every
job takes the caller's ``SparkSession``. ``local_session`` exists for tests,
the bench and the driver smoke check only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job assumes: UTC wall clock (request-log dates are UTC),
# adaptive execution for runtime skew splitting and partition coalescing.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # windows-1251 / latin-1 decoding of raw bytes (TXT1)
    "spark.sql.legacy.javaCharsets": "true",
    # list and value state of the breaker stream (STR4)
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ragloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RAGLOOM_DRIVER_MEMORY", "16g"))
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (cluster use)."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running cluster session: leave as is
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The folder must be on a file system that the driver and all executors
    share. Where nothing is configured, a fresh local folder is used in local
    mode (one process); on a cluster that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ragloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked through Spark's own file system
    layer (any store that Spark can read)."""
    fs, jvm_path = _file_system(spark, path)
    return fs.exists(jvm_path)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _file_system(spark, path)
    fs.mkdirs(jvm_path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one store."""
    fs, jvm_path = _file_system(spark, source)
    if not fs.rename(jvm_path, _file_system(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")


def ship_package(spark: SparkSession) -> None:
    """Make ``ragloom`` importable on every executor's Python workers (the
    functions of ``mapInPandas``/``applyInPandas`` jobs are pickled by
    reference). The package is zipped once per SparkContext on the driver and
    distributed by Spark with ``addPyFile``."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_ragloom_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ragloom-pkg-"), "ragloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    sc._ragloom_shipped = True
