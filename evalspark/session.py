"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "evalspark") -> SparkSession:
    """Session for tests and the bench; a cluster passes its own settings."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EVALSPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spark settings sized to the data: initial shuffle partitions so each
    holds about ``partition_bytes`` of the largest shuffle input (AQE then
    coalesces small ones and splits skewed ones), scan splits of the same
    size, at least two tasks per core. Pass them to ``SparkSession.builder``.
    """
    parts = max(2 * cores, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset
    (local tests) a fresh folder is created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="evalspark-ckpt-")
        warnings.warn(f"spark.checkpoint.dir is not set: this local session writes intermediate tables to {conf_dir}", stacklevel=2)
        spark.sparkContext.setCheckpointDir(conf_dir)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Used for pre-aggregated intermediate tables that several branches of a
    plan read (so the big scan and shuffle run once), and to cut lineage so a
    lost executor does not send recomputation back to the raw scan. The files
    live under the cluster's shared folder (``spark.checkpoint.dir``), never
    on a machine-local path.
    """
    spark = df.sparkSession
    path = recorded_path(spark, "mat")
    df.write.parquet(path)
    return spark.read.parquet(path)


def recorded_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder that ``release_materialized`` deletes."""
    path = scratch_path(spark, name)
    _MATERIALIZED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


_MATERIALIZED: dict[str, list[str]] = {}


def materialized_paths(spark: SparkSession) -> list[str]:
    """The intermediate tables this application has written so far."""
    return list(_MATERIALIZED.get(spark.sparkContext.applicationId, []))


def release_materialized(spark: SparkSession) -> int:
    """Delete this application's intermediate tables from the shared folder.

    Call it once the DataFrames built on them are no longer needed (they
    read those files lazily). Returns the number of paths removed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _MATERIALIZED.pop(spark.sparkContext.applicationId, [])
    removed = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            fs.delete(hp, True)
            removed += 1
    return removed


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``evalspark`` importable on the executors' Python workers.

    Functions run by ``mapInPandas`` / pandas UDFs refer to this package, so
    it is zipped once per application and added with ``addPyFile`` (Spark
    distributes the file to every executor). Idempotent per application.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="evalspark-pyfiles-"), "evalspark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
