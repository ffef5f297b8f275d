"""Spark session with the settings every job of the package relies on."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

SESSION_CONF = {
    # Dates and months are cut in UTC in every job, not only at ingest.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    # Joins on persisted tables leave skewed keys to the adaptive planner.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merged partitions, and with them output files, of a size worth a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_spark(
    app_name: str = "shopmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session in UTC with snappy Parquet output and adaptive execution.

    ``shuffle_partitions`` is the number of reduce tasks before adaptive
    coalescing. Size it so that shuffled bytes / partitions is about 200 MB;
    too many is cheap (they are merged), too few is not.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application, so that their Python workers can
    import it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_shipped_package", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._shipped_package = True
