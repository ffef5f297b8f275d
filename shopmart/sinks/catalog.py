"""Databases, external tables over Parquet, managed tables and views."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the names that are accepted.
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def identifier(name: str) -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain SQL identifier: {name!r}")
    return name


def qualified(database: str, table: str) -> str:
    """Tables are always named with their database; the current one is never relied on."""
    return f"{identifier(database)}.{identifier(table)}"


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(database)}")


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Forget a table; the files of an external one stay."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(database, table)}")


def register_parquet(spark: SparkSession, database: str, table: str, path: str) -> None:
    """External table over a Parquet dataset, replacing an earlier registration."""
    drop_table(spark, database, table)
    spark.catalog.createTable(qualified(database, table), path=path, source="parquet")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def location(spark: SparkSession, database: str, table: str) -> str:
    """Where the files of a registered table are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(database, table)}")
    return rows.where("col_name = 'Location'").first().data_type


def _buckets(spark: SparkSession, name: str) -> dict[str, str]:
    """A registered table's number of buckets and their columns; empty if it has none."""
    wanted = ("Num Buckets", "Bucket Columns", "Sort Columns")
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name in wanted}


def point_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    buckets: int | None = None,
    bucket_by: str = "",
) -> None:
    """Register a Parquet dataset, or switch the location of the table that has its name.

    A switch changes one entry of the catalog, so readers see the old files or the new ones. Only where
    columns or buckets differ, the table is registered anew. ``buckets`` are those that
    the files were written with, sorted by the same column.
    """
    name = qualified(database, table)
    schema = spark.read.parquet(path).schema
    column = f"`{bucket_by}`"
    spec = {"Num Buckets": str(buckets), "Bucket Columns": f"[{column}]", "Sort Columns": f"[{column}]"}
    spec = spec if buckets else {}
    if spark.catalog.tableExists(name):
        fields = [(f.name, f.dataType) for f in schema]
        same = fields == [(f.name, f.dataType) for f in spark.table(name).schema]
        if same and _buckets(spark, name) == spec:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
            spark.catalog.refreshTable(name)
            return
    if not buckets:
        register_parquet(spark, database, table, path)
        return
    drop_table(spark, database, table)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({column}) SORTED BY ({column}) "
        f"INTO {int(buckets)} BUCKETS LOCATION {_quoted(path)}"
    )


def analyze(spark: SparkSession, database: str, table: str, columns: Iterable[str] = ()) -> None:
    """Count a table's rows, and the distinct values of some columns, for the planner.

    It reads those columns once. A table whose location was switched keeps the old figures until then.
    """
    name = qualified(database, table)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    listed = ", ".join(f"`{identifier(c)}`" for c in columns)
    if listed:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {listed}")


def register_all(spark: SparkSession, database: str, base: str, tables: Iterable[str]) -> None:
    names = [identifier(table) for table in tables]
    create_database(spark, database)
    for name in names:
        register_parquet(spark, database, name, f"{base.rstrip('/')}/{name}")


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    name = qualified(database, table)
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name} is not registered")
    return spark.table(name)


def save_table(df: DataFrame, database: str, table: str, path: str) -> None:
    """Parquet table at ``path``, overwritten.

    The place is always named: without one it would be the session's warehouse, which may be
    a folder of one machine.
    """
    create_database(df.sparkSession, database)
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    writer.saveAsTable(qualified(database, table))


def create_view(df: DataFrame, name: str) -> None:
    """Session view, computed when it is queried."""
    df.createOrReplaceTempView(identifier(name))


def create_sql_view(spark: SparkSession, database: str, name: str, sql: str) -> None:
    """View in the catalog, which other sessions see as long as the catalog lasts."""
    create_database(spark, database)
    spark.sql(f"CREATE OR REPLACE VIEW {qualified(database, name)} AS {sql}")


def refresh(spark: SparkSession, database: str, tables: Iterable[str]) -> None:
    """Drop cached file listings and data of tables that were rewritten."""
    for table in tables:
        spark.catalog.refreshTable(qualified(database, table))
