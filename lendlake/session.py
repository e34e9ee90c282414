"""Session helpers for tests and the benchmark, and the checkpoint folder.

Library code never creates a session: every operator takes DataFrames, and
the query catalogue takes the caller's ``SparkSession``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lendlake") -> SparkSession:
    """A local session for tests / bench (UI off, AQE on, UTC)."""
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
        .config("spark.driver.memory", os.environ.get("LENDLAKE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    Where it is unset, a folder is made only for a local master, whose driver
    and executors are one process.  On a cluster the executors would each
    write to a disk of their own, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lendlake-ckpt-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, label: str, apart: bool = False) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back; ``apart`` gives each row a file, for rows of many MB.

    Cuts the lineage (a lost executor re-reads files) and needs no cache that
    somebody must release; folders are grouped by application.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/lendlake-stored/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    (df.write.option("maxRecordsPerFile", 1) if apart else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions that run in Python workers refer to its modules.  Spark's file
    server sends the archive, so it may lie on the driver's own disk.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="lendlake-")) / "lendlake.zip"
        with zipfile.ZipFile(target, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)
