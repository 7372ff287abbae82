"""Session helpers: code shipping, shared work folders and lineage-cutting writes."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8) -> SparkSession:
    """A session with the settings that tests and the benchmark share."""
    return (
        SparkSession.builder.master(master)
        .appName("rasterloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


#: Rows of whole texts in an Arrow batch; Spark's own default, 10,000, takes hundreds of megabytes where texts are long.
BATCH_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, and make Arrow batches small unless they have been set."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if getattr(ship_package, "app", None) == app:
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="rasterloom-code-"))
    target = os.path.join(folder, f"rasterloom_{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent).as_posix())
    spark.sparkContext.addPyFile(target)
    ship_package.app = app


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share; a session on one machine (tests) may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:
        base = getattr(work_dir, "own", None) or "file://" + tempfile.mkdtemp(prefix="rasterloom-")
        work_dir.own = base
    return f"{base.rstrip('/')}/rasterloom-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back: the lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = path or work_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``materialize`` wrote and that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
