"""Spark session helpers and the few cluster-wide settings the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this engine wants; a cluster launcher may override any of them.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "castwright") -> SparkSession:
    """Session for tests, the bench and the smoke check (local mode only)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CASTWRIGHT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system and it is only read here. Only a
    local-mode session (tests, the smoke check, the bench) without the setting gets a fresh
    scratch folder; a cluster session without it is an error rather than a machine-local path.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        current = tempfile.mkdtemp(prefix="castwright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where a value must not be recomputed on task retry (generated job ids, remote
    model or speech calls) and for stage tables read more than once: the written table cuts
    the lineage, so a lost executor re-reads the files instead of recomputing (or calling the
    remote service again).
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def is_whole(spark: SparkSession, path: str) -> bool:
    """True for a written table whose job was committed."""
    at, files = _hadoop(spark, f"{path}/_SUCCESS")
    return files.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    at, files = _hadoop(spark, path)
    files.mkdirs(at)


def drop_folder(spark: SparkSession, path: str) -> None:
    at, files = _hadoop(spark, path)
    files.delete(at, True)


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-spread the rows of a freshly read table when the scan gave too few splits.

    Call it on a scan (optionally with projections/filters), not on a DataFrame that already
    contains a shuffle: for a scan, counting partitions only lists files, while on a shuffled
    plan it would run the upstream stages. Large inputs already arrive in many file splits and
    are left alone (no shuffle); a small file with one row group would otherwise put all
    row-level work on one core.
    """
    spark = df.sparkSession
    target = min_partitions or int(spark.sparkContext.defaultParallelism)
    if df.rdd.getNumPartitions() >= target:
        return df
    if keys:
        return df.repartition(target, *keys)
    return df.repartition(target)


def observed(df: DataFrame, name: str, *metrics) -> DataFrame:
    """Attach row metrics to ``df`` (``Dataset.observe``).

    Besides reporting counts, the CollectMetrics node stops the optimizer from pushing a later
    filter on a derived column down through a deep stack of projections, which would otherwise
    inline every intermediate expression into one huge predicate at the scan.
    """
    import uuid

    from pyspark.sql import functions as F

    ms = list(metrics) or [F.count(F.lit(1)).alias("rows")]
    return df.observe(f"{name}-{uuid.uuid4().hex[:8]}", *ms)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``castwright`` importable on the executors' Python workers (``addPyFile`` of a zip
    of the package, once per application), whatever their working directory or path."""
    import zipfile

    import castwright

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(castwright.__file__))
    fd, path = tempfile.mkstemp(suffix=".zip", prefix="castwright-pkg-")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(app)
