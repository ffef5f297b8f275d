"""CSV with line breaks in quoted fields, read by many tasks per file.

A line break ends a record where the quotes before it are even in number. Spark splits a file at line
breaks as for any text, and three passes make records of it:

1. Quotes are counted per split, in parallel. The parity of all splits before one tells whether it begins within a
   quoted field. The driver holds one number and one flag per split of 128 MB or so.
2. Every task follows the parity through the lines of its split and joins the lines of each record. Records
   that begin and end in the split are done.
3. The splits at whose ends a record goes on are read again, for these records' parts alone: their last lines and
   the next splits' first ones meet in a small grouping.

Records are parsed by Spark's own CSV parser, so types, nulls and damage are as with its reader. A quote in a field is
written twice, and one that is not around a whole field is an error of the file. Lines may end in line feeds or in
carriage returns and line feeds. Files must be in UTF-8.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shopmart.session import ship_package

QUOTE = '"'
_PARTS = "file string, split long, kind byte, record string"
_WHOLE, _BEGUN, _CONTINUED = 0, 1, 2

# For each file, where its splits begin and whether each begins within a quoted field.
Parities = dict[str, tuple[np.ndarray, np.ndarray]]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and the place where their split begins, in the order of the file."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").alias("line"),
    )


def split_parities(lines: DataFrame) -> Parities:
    """Whether each split begins within a quoted field."""
    quotes = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "split").agg((F.sum(quotes.cast("long")) % 2).alias("odd"))
    found: dict[str, list[tuple[int, int]]] = {}
    for row in counted.toLocalIterator():
        found.setdefault(row.file, []).append((row.split, row.odd))
    out: Parities = {}
    for file, splits in found.items():
        starts, odd = np.array(sorted(splits), np.int64).T
        before = (np.cumsum(odd) - odd) % 2 == 1
        if odd.sum() % 2:
            raise ValueError(f"{file} ends within a quoted field")
        out[file] = (starts, before)
    return out


def _begins_quoted(parities: Parities, file: str, split: int) -> bool:
    starts, before = parities.get(file, (np.zeros(0, np.int64), None))
    at = int(np.searchsorted(starts, split))
    if at == len(starts) or starts[at] != split:
        raise ValueError(f"{file} changed while it was read, or is split in another way than before")
    return bool(before[at])


class _Split:
    """The lines of one split, as they arrive, made into records."""

    def __init__(self, file: str, split: int, quoted: bool) -> None:
        self.file, self.split = file, split
        self.quoted = quoted  # whether the next line begins within a quoted field
        self.open: list[str] = []  # lines of a record that has not ended
        self.continued = quoted  # whether that record began in an earlier split

    def add(self, lines: pa.Array) -> tuple[list[str], pa.Array | None]:
        """What continues an earlier split's record and ends here, and the whole records of some lines."""
        odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False) % 2
        ends = (np.cumsum(odd) + self.quoted) % 2 == 0  # lines that end a record
        stops = np.flatnonzero(ends) + 1
        if not len(stops):
            self.open += lines.to_pylist()
            self.quoted = True
            return [], None
        first, last = int(stops[0]), int(stops[-1])
        head = "\n".join([*self.open, *lines.slice(0, first).to_pylist()])
        self.open = lines.slice(last).to_pylist()
        self.quoted = bool(self.open)
        offsets = pa.array(stops, pa.int32())
        inner = lines.slice(0, last).cast(pa.string())
        records = pc.binary_join(pa.ListArray.from_arrays(offsets, inner), "\n")
        if self.continued:
            self.continued = False
            return [head], records
        return [], pa.concat_arrays([pa.array([head], pa.string()), records])

    def rest(self) -> tuple[int, str] | None:
        """What has not ended with the split."""
        if not self.open:
            return None
        return (_CONTINUED if self.continued else _BEGUN), "\n".join(self.open)


def _checked_header(file: str, record: str, header: Sequence[str]) -> None:
    found = next(csv.reader([record.rstrip("\r").removeprefix("\ufeff")]), [])
    if found != list(header):
        raise ValueError(f"{file} has the header {found}, not {list(header)}")


def _records(lines: DataFrame, parities: Parities, header: Sequence[str]) -> DataFrame:
    """Records and parts of records, by split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Split | None = None

        def rows(kind: int, records: list[str] | pa.Array) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([current.file] * n, pa.string()),
                    pa.array(np.full(n, current.split)),
                    pa.array(np.full(n, kind, np.int8)),
                    pa.array(records, pa.string()) if isinstance(records, list) else records,
                ],
                ["file", "split", "kind", "record"],
            )

        def finish() -> Iterator[pa.RecordBatch]:
            rest = current.rest() if current else None
            if rest:
                yield rows(rest[0], [rest[1]])

        for batch in batches:
            files, splits = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            cuts = np.flatnonzero((splits[1:] != splits[:-1]) | (files[1:] != files[:-1])) + 1
            bounds = [0, *cuts.tolist(), len(splits)]
            for a, b in zip(bounds, bounds[1:], strict=False):
                if a == b:
                    continue
                file, split = files[a], int(splits[a])
                is_new = current is None or (current.file, current.split) != (file, split)
                if is_new:
                    yield from finish()
                    current = _Split(file, split, _begins_quoted(parities, file, split))
                head, whole = current.add(batch.column(2).slice(a, b - a))
                if head:
                    yield rows(_CONTINUED, head)
                if whole is not None:
                    if is_new and split == 0:
                        _checked_header(file, whole[0].as_py(), header)
                        whole = whole.slice(1)
                    yield rows(_WHOLE, whole)
        yield from finish()

    return lines.mapInArrow(run, _PARTS)


def _at_cut_records(lines: DataFrame, parities: Parities) -> DataFrame:
    """The lines of splits that begin or end within a record."""
    cut = []
    for file, (starts, before) in parities.items():
        after = np.append(before[1:], False)
        cut += [(file, int(x)) for x in starts[before | after]]
    chosen = lines.sparkSession.createDataFrame(cut, "file string, split long")
    # One row per split at most.
    return lines.join(F.broadcast(chosen), ["file", "split"], "left_semi")


def _stitched(parts: DataFrame) -> DataFrame:
    """Records from their parts: one that begins, and those that continue it up to the next one that begins."""
    # Splits are in order of their place; within one, what is continued comes before what is begun.
    order = F.struct("split", (F.col("kind") == _BEGUN).alias("begun"))
    by_file = Window.partitionBy("file").orderBy(order)
    numbered = parts.withColumn("n", F.sum((F.col("kind") == _BEGUN).cast("long")).over(by_file))
    grouped = numbered.groupBy("file", "n").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("o"), "record"))).alias("parts")
    )
    return grouped.select(F.array_join(F.col("parts.record"), "\n").alias("record"))


def read_records(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """``record``: the text of each record of the files under ``path``, without their headers."""
    ship_package(spark)
    lines = _lines(spark, path)
    parities = split_parities(lines)
    whole = _records(lines, parities, header).where(F.col("kind") == _WHOLE)
    parts = _records(_at_cut_records(lines, parities), parities, header).where(F.col("kind") != _WHOLE)
    both = whole.select("record").unionByName(_stitched(parts))
    ended = F.regexp_replace("record", "\r$", "")
    return both.select(ended.alias("record")).where(F.trim("record") != "")


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """Rows of the files under ``path``, all of whose headers are the names in ``schema``."""
    records = read_records(spark, path, schema.fieldNames())
    options = {"quote": QUOTE, "escape": QUOTE, "mode": mode}
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("record", columns, options)
    return records.select(parsed.alias("row")).select("row.*")
