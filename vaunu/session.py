"""Session helpers shared by all operators: builder, table reader, shared-folder materialisation."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vaunu")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of ``spark``, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="vaunu-")) / "vaunu.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; a Parquet file or a directory of them."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a local one where that is unset.

    A machine-local folder is only taken when the master itself is local.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="vaunu-")
    context.setCheckpointDir(folder)
    return folder


_written: list[tuple[SparkSession, str]] = []


def _delete_written() -> None:
    """Results may be read lazily until the application ends; then nothing of what was written between stays."""
    for spark, path in _written:
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # noqa: BLE001 - the JVM is gone already
            return


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage, so that a plan used twice is computed once and a lost executor costs no
    recomputation of what came before. The files are deleted when the application ends.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark).rstrip('/')}/vaunu-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_delete_written)
    _written.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over enough partitions to keep all cores busy with work that is heavy for its bytes.

    For scans of few bytes only: one that already has a partition for each core stays as it is.
    """
    spark = df.sparkSession
    ship(spark)
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)
