"""CSV source: one table per file, or per folder of part files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmart.schemas import OPTIONAL_TYPES, RAW_SCHEMAS, RAW_TABLES
from shopmart.sources.quoted_csv import read_quoted_csv

SUFFIX = "_dataset"


def table_name(stem: str, prefix: str | None = None) -> str:
    """Table of a file named ``<prefix><table>_dataset``, where both ends may be missing.

    Without a ``prefix``, whatever precedes the name of a raw table is one.
    """
    name = stem.removesuffix(SUFFIX)
    if prefix is not None:
        return name.removeprefix(prefix)
    known = [t for t in RAW_TABLES if name == t or name.endswith(f"_{t}")]
    return max(known, key=len) if known else name


@dataclass(frozen=True)
class CsvTable:
    """A file, or a folder of part files, and the file its header is read from."""

    path: str
    first_file: str


def _qualified(spark: SparkSession, src: str) -> str:
    """A path in full, as listings give it: with scheme and host, without a slash at the end."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(src)
    return path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")


def list_csv(spark: SparkSession, src: str, prefix: str | None = None) -> dict[str, CsvTable]:
    """Tables under ``src``, on any file system Spark can read.

    A file directly in ``src`` is a table by its own name; files anywhere below a
    subfolder are the parts of one table named by that subfolder. Only names are read,
    and a folder comes back as one entry however many parts it has. Within such a folder, a file
    that is not named as CSV raises, as leaving it out could lose a part; directly in
    ``src`` it is no table. Spark itself skips hidden files, whose names begin with a dot or an
    underscore.
    """
    root = _qualified(spark, src)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
    # The listing has full paths; below the root, the first name is the table's.
    below = F.substring("path", len(root) + 2, 1 << 20)
    first = F.substring_index(below, "/", 1)
    is_part = F.contains(below, F.lit("/"))
    outside = ~F.startswith(F.col("path"), F.lit(f"{root}/"))
    found = (
        files.select(
            F.concat(F.lit(f"{root}/"), first).alias("table_path"),
            "path",
            is_part.alias("is_part"),
            (~F.lower("path").endswith(".csv") | outside).alias("odd"),
        )
        .where("is_part or not odd")
        .groupBy("table_path")
        .agg(
            F.min("path").alias("first_file"),
            F.min(F.when(F.col("odd"), F.col("path"))).alias("odd"),
        )
        .orderBy("table_path")
        .collect()
    )
    for row in found:
        if row.odd is not None:
            raise ValueError(f"{row.odd} is not a CSV file")
    tables: dict[str, CsvTable] = {}
    for row in found:
        stem = row.table_path.rsplit("/", 1)[-1]
        name = table_name(re.sub(r"(?i)\.csv$", "", stem), prefix)
        if name in tables:
            raise ValueError(f"two sources for table {name!r} in {src}")
        tables[name] = CsvTable(row.table_path, row.first_file)
    if not tables:
        raise FileNotFoundError(f"no CSV files in {src}")
    return dict(sorted(tables.items()))


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    # A quote inside a quoted field is written twice.
    return (
        spark.read.option("header", "true")
        .option("recursiveFileLookup", "true")
        .option("multiLine", str(multi_line).lower())
        .option("quote", '"')
        .option("escape", '"')
    )


def declared_schema(table: str, header: Sequence[str]) -> T.StructType:
    """Types for the columns of a file, in the order of its header.

    Declared columns get their declared type; further columns are kept, as text
    unless their type is known.
    """
    declared = RAW_SCHEMAS.get(table, T.StructType())
    missing = [name for name in declared.fieldNames() if name not in header]
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}; its header is {list(header)}")
    types = OPTIONAL_TYPES | {field.name: field.dataType for field in declared}
    return T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in header])


def read_csv(
    spark: SparkSession,
    table: str,
    source: CsvTable,
    multi_line: bool = True,
    infer: bool = False,
    mode: str = "FAILFAST",
    whole_files: bool = False,
) -> DataFrame:
    """Rows of one table.

    Only the header is read to lay out the schema, so the files are scanned
    once. A value that does not fit its declared type raises rather than turn
    into NULL. All parts must have the same header.

    ``multi_line`` is needed if a quoted field may hold a line break. Files are split over
    tasks either way, but then they are scanned for quotes first (see ``quoted_csv``); ``whole_files``
    reads each with line breaks in one task instead, which also allows for a quote in an unquoted field.
    ``infer`` takes all types from the data, at the cost of a scan and with whole files.
    """
    reader = _reader(spark, multi_line)
    if infer:
        return reader.option("inferSchema", "true").csv(source.path)
    header = reader.csv(source.first_file).columns
    if not header:
        raise ValueError(f"{source.first_file} has no header")
    if multi_line and not whole_files:
        return read_quoted_csv(spark, source.path, declared_schema(table, header), mode)
    return (
        reader.schema(declared_schema(table, header))
        .option("enforceSchema", "false")
        .option("mode", mode)
        .csv(source.path)
    )
