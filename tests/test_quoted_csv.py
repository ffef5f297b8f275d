"""CSV with quoted line breaks, split at any place, against the reader of whole files."""

import csv
import random

import pytest
from helpers import settings, tuples
from pyspark.sql import types as T

from shopmart.sources import quoted_csv
from shopmart.sources.csv_files import CsvTable, read_csv

NAMES = ["order_id", "review_score", "review_comment_message", "note"]
WORDS = ["good", "bad, really", 'so "called"', "line\nbreak", "two\n\nbreaks", '"', "\n", "a\n\"b\"\nc", "é日本", ""]


def rows(n, seed=1):
    rng = random.Random(seed)
    return [
        (f"o{k}", rng.choice([1, 5, ""]), " ".join(rng.choice(WORDS) for _ in range(rng.randrange(5))), rng.choice(WORDS))
        for k in range(n)
    ]


def write(path, data, end="\n", quoting=csv.QUOTE_MINIMAL):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end, quoting=quoting)
        out.writerow(NAMES)
        out.writerows(data)
    return CsvTable(str(path), str(path if path.is_file() else next(path.iterdir())))


def both(spark, source):
    return read_csv(spark, "order_reviews", source), read_csv(spark, "order_reviews", source, whole_files=True)


@pytest.mark.parametrize("size", [64, 300, 4096, 1 << 20])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, size, quoting):
    """Splits of down to 64 bytes: records over several splits, splits that begin at every kind of place."""
    source = write(tmp_path / "order_reviews.csv", rows(400 if size > 64 else 60), quoting=quoting)
    with settings(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1"):
        split, whole = both(spark, source)
        assert split.schema == whole.schema
        if size == 300:
            assert split.rdd.getNumPartitions() > 20 and whole.rdd.getNumPartitions() == 1
        assert tuples(split) == tuples(whole) and split.count() == (400 if size > 64 else 60)


def test_carriage_returns_empty_lines_and_a_mark_at_the_start(spark, tmp_path):
    path = tmp_path / "order_reviews.csv"
    path.write_bytes(
        b"\xef\xbb\xbforder_id,review_score,note\r\n"
        b'o1,5,"a\r\nb"\r\n\r\no2,4,\r\n   \r\no3,3,"""x"""\r\n"o4",,"\r\n"\r\no5,1,last'
    )
    source = CsvTable(str(path), str(path))
    with settings(spark, spark__sql__files__maxPartitionBytes="16", spark__sql__files__openCostInBytes="1"):
        split = read_csv(spark, "order_reviews", source)
        found = {r.order_id: (r.review_score, (r.note or "").replace("\r", "")) for r in split.collect()}
    assert found == {"o1": (5, "a\nb"), "o2": (4, ""), "o3": (3, '"x"'), "o4": (None, "\n"), "o5": (1, "last")}


def test_many_files_and_one_long_field(spark, tmp_path):
    """A field far longer than a split, whose middle splits hold neither begin nor end of a record."""
    long = [("o1", 1, 'x\n"quoted"\n' * 3000, "y"), ("o2", 2, "z", "")]
    for k in range(3):
        write(tmp_path / "order_reviews" / f"p{k}.csv", [*rows(50, k), *long, *rows(50, k + 9)])
    source = CsvTable(str(tmp_path / "order_reviews"), str(tmp_path / "order_reviews" / "p0.csv"))
    with settings(spark, spark__sql__files__maxPartitionBytes="1000", spark__sql__files__openCostInBytes="1"):
        split, whole = both(spark, source)
        assert tuples(split) == tuples(whole) and split.count() == 306


def test_open_quotes_other_headers_and_bad_values_raise(spark, tmp_path):
    open_end = tmp_path / "open.csv"
    open_end.write_text('order_id,review_score\no1,"5\n')
    schema = T.StructType.fromDDL("order_id string, review_score int")
    with pytest.raises(ValueError, match="within a quoted field"):
        quoted_csv.read_quoted_csv(spark, str(open_end), schema)
    bad = tmp_path / "bad.csv"
    bad.write_text('order_id,review_score\no1,"five"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        quoted_csv.read_quoted_csv(spark, str(bad), schema).collect()
    loose = quoted_csv.read_quoted_csv(spark, str(bad), schema, mode="PERMISSIVE")
    assert tuples(loose) == [("o1", None)]
    other = tmp_path / "other.csv"
    other.write_text("review_score,order_id\n5,o1\n")
    with pytest.raises(Exception, match="header"):
        quoted_csv.read_quoted_csv(spark, str(other), schema).collect()


def test_changed_splits_are_noticed(spark, tmp_path):
    source = write(tmp_path / "order_reviews.csv", rows(300))
    lines = quoted_csv._lines(spark, source.path)
    parities = quoted_csv.split_parities(lines)
    ((file, (starts, before)),) = parities.items()
    moved = {file: (starts + 1, before)}
    with pytest.raises(Exception, match="changed while it was read"):
        quoted_csv._records(lines, moved, NAMES).count()
