"""Versions of datasets: written aside, tested, and only then put in the place of the old ones.

Every run writes into folders of its own. Publishing switches the location of one registered table after
another, which touches no data: a reader sees a table's old files or its new ones, never
a part. A run that fails or is killed before leaves all tables as they were; one that is killed while
publishing leaves some at the old version, all of them whole, and the next run goes on from there.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import SparkSession

from shopmart.sinks import catalog

_VERSION = re.compile(r"v\d{20}-[0-9a-f]{8}")


def new_version() -> str:
    """A folder name that no other run has; later runs sort behind earlier ones."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(
    spark: SparkSession,
    database: str,
    base: str,
    tables: Iterable[str],
    buckets: int | None = None,
    bucketed: Mapping[str, str] | None = None,
) -> None:
    """Point the tables of a database to the datasets under ``base``; ``bucketed`` names the columns of those
    that were written in ``buckets``."""
    names = [catalog.identifier(table) for table in tables]
    catalog.create_database(spark, database)
    for name in names:
        path, column = f"{base.rstrip('/')}/{name}", (bucketed or {}).get(name, "")
        spec = {"buckets": buckets, "bucket_by": column} if buckets and column else {}
        catalog.point_table(spark, database, name, path, **spec)


def _folder(spark: SparkSession, path: str):
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def expire(
    spark: SparkSession, base: str, keep: int, in_use: Collection[str] = ()
) -> list[str]:
    """Delete versions under ``base`` but for the last ``keep`` and those that ``in_use`` names,
    which are locations of tables; the names of those deleted."""
    if keep < 1:
        raise ValueError("keep at least one version")
    files, root = _folder(spark, base)
    if not files.exists(root):
        return []
    found = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    versions = sorted(name for name in found if _VERSION.fullmatch(name))
    used = {part for place in in_use for part in place.split("/")}
    gone = [name for name in versions[:-keep] if name not in used]
    for name in gone:
        _, path = _folder(spark, f"{base.rstrip('/')}/{name}")
        files.delete(path, True)
    return gone
