"""Helpers shared by the operators: the cluster's shared folder and files in it."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.session import ship_package

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, without a trailing slash.

    It is read from ``spark.checkpoint.dir``. Where that is unset, a temporary folder is made and
    set if driver and executors are one process, as in tests; on a cluster this raises.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to a table in the shared folder and read back.

    This cuts the lineage: what reads the result does not compute ``df`` again,
    and a lost executor costs only the tasks that it ran.
    """
    path = new_folder(df.sparkSession, name)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that any executor can reach."""
    return pafs.FileSystem.from_uri(uri)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


# A key with over a thousandth of the rows is hot; so there are under a thousand.
HOT_SHARE = 1000


def lookup(many: DataFrame, one: DataFrame, key: str, n_rows: str) -> DataFrame:
    """Inner join of ``many`` to ``one`` (unique, non-null keys), safe against hot keys.

    ``one`` has a column ``n_rows`` with each key's rows in ``many``. Keys with over 1/1000 of all
    rows, of which there are under 1000 by arithmetic, are broadcast; the
    others are shuffled. Both inputs are read twice and should be written tables.
    """
    total = one.agg(F.sum(n_rows)).first()[0] or 0
    is_hot = F.col(n_rows) * HOT_SHARE > total
    hot, rest = one.where(is_hot).drop(n_rows), one.where(~is_hot).drop(n_rows)
    found = many.join(F.broadcast(hot), key)
    others = many.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return found.unionByName(others)


# Bits of a bitmap of hashed keys: 1 MB, whatever the size of the tables.
BITMAP_BITS = 1 << 23


def bitmap_place(key: str) -> Column:
    """The bit that stands for a key."""
    return F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS)).cast("int")


def bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap of hashed keys, gathered on the driver: it says of rows which surely lack a key
    of ``keys``. The more keys, the fewer rows it rules out; its size stays the same."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BITMAP_BITS, bool)
        for batch in batches:
            held[batch.column(0).to_numpy()] = True
        yield pa.RecordBatch.from_pydict({"bits": [np.packbits(held).tobytes()]})

    known = np.zeros(BITMAP_BITS // 8, np.uint8)
    parts = keys.select(bitmap_place(key).alias("place")).coalesce(32)
    for row in parts.mapInArrow(tidy(bits), "bits binary").toLocalIterator():
        known |= np.frombuffer(row.bits, np.uint8)
    return known


def in_bitmap(known: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the bit of each place is set."""
    return (known[places >> 3] >> (7 - (places & 7)) & 1).astype(bool)


# Bytes of rows that Spark hands to a Python worker at a time, so that long texts do not add up.
BATCH_BYTES = 1 << 22


def release() -> None:
    """Return a worker's free memory to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task``, after which the worker returns its free memory to the system.

    Idle workers are kept for later tasks, beside the memory of the executor.
    """

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        release()

    return run


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application.

    For the rest of the session, batches of rows for Python workers are limited to ``BATCH_BYTES``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)
