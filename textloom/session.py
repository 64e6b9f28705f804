"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "textloom",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass no master and let
    spark-submit decide; the settings below are the ones this library relies on."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or f"local[{cpus}]")
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TEXTLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local master (tests) may have none: a
    fresh folder under the system temp dir is set then; on a cluster that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="textloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: what is above runs once and
    a lost executor costs no recomputation of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_once(df: DataFrame, column: str, name: str) -> tuple[DataFrame, int]:
    """``written_once`` as a table in buckets of ``column``, and the number of buckets (the session's shuffle
    partitions). A join on ``column`` and others with a side in as many hash partitions of it reads the table in place;
    Spark takes that side as it is only without ``requireAllClusterKeysForCoPartition``, which is therefore set for the
    session (it changes plans, no results). The table's entry in the catalog is dropped again; its files stay."""
    import uuid

    spark = df.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    df.write.bucketBy(buckets, column).format("parquet").option("path", scratch_path(spark, name)).saveAsTable(entry)
    table = spark.table(entry)
    table.schema  # resolved: the files are known from here on
    spark.sql(f"DROP TABLE {entry}")
    return table, buckets


def ship_package(spark: SparkSession) -> None:
    """Makes ``textloom`` importable in the Python workers of every executor: the
    package is zipped once per SparkContext and added with ``addPyFile`` (functions
    given to mapInPandas / applyInPandas are pickled by reference to this package)."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_textloom_shipped", False):
        return
    import textloom

    pkg = os.path.dirname(os.path.abspath(textloom.__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="textloom-py-"), "textloom.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    sc._textloom_shipped = True
