"""What the operators share: words, scratch tables, bounded buckets and column helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlake.settings import passing_shuffles, shared_folder
from spendlake.sources.landing import delete_folder

#: The white space between words, as a Java or RE2 pattern; ``bytes.split()`` splits at the same.
BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared scratch folder and read again.

    Cuts the lineage: a lost executor costs no more than the files it was reading, and what
    several later steps use is computed once.  The shuffle files of the step go when it ends.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark)
    with passing_shuffles(spark):
        rows.write.option("compression", "zstd").parquet(folder)
    table = spark.read.schema(rows.schema).parquet(folder)
    table._scratch_folder = folder
    return table


def release(*tables: DataFrame) -> None:
    """Delete the files of stored tables, once all that reads them is stored itself."""
    for table in tables:
        delete_folder(table.sparkSession, table._scratch_folder)


#: Words of 64 bits in the table of ``maybe_among``, which is broadcast.
MARK_BITS = 18


def maybe_among(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """The rows whose key may be among those of ``wanted``: all that are, and few others.

    ``wanted`` marks the hashes of its keys in a bitmap of 2^18 words of 64 bits, whatever its
    size, so rows that a join would only drop stay in their task.  Null is a key like any other.
    """
    word = lambda key: F.shiftrightunsigned(F.xxhash64(key), 64 - MARK_BITS)
    mark = lambda key: F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.xxhash64(key).bitwiseAND(63).cast("int")
    )
    marks = wanted.groupBy(word(wanted_key).alias("_word")).agg(F.bit_or(mark(wanted_key)).alias("_marks"))
    met = rows.join(F.broadcast(marks), word(key) == F.col("_word"))
    return met.where(F.col("_marks").bitwiseAND(mark(key)) != 0).drop("_word", "_marks")


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit numbers, all bits of which depend on all bits."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """64-bit hashes of words; remembers a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 250_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark application."""
    context = spark.sparkContext
    if getattr(context, "_spendlake_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in package.rglob("*.py"):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(target)
    context._spendlake_shipped = True


def with_fields(rows: DataFrame, fields: str) -> StructType:
    """The schema of the rows with more fields at the end."""
    return StructType([*rows.schema.fields, *StructType.fromDDL(fields).fields])


def sliced_by_bytes(column: str, most: int) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """Slices of a batch whose texts have at most so many bytes, or that are one row."""

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = batch.column(column).cast(pa.large_binary())
        ends = np.cumsum([len(v) for v in (x.as_buffer() or b"" for x in sizes)])
        start, before = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, end - start)
            start, before = end, ends[end - 1]

    return slices


def commonest(counts: DataFrame, key: str, most: int) -> pa.Table:
    """The ``most`` rows of the highest counts ``n``, ties by key.

    A histogram of at most some hundred classes of counts first shows which rows can be among
    them, so the driver never sees many more.
    """
    size = F.floor(F.log2("n") * 8)
    left, least = most, 0
    for row in sorted(counts.groupBy(size.alias("size")).count().collect(), reverse=True):
        left, least = left - row["count"], row["size"]
        if left <= 0:
            break
    return counts.where(size >= least).orderBy(F.desc("n"), key).limit(most).toArrow()


def map_arrow(
    rows: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | StructType,
    most_rows: int | None = None,
    slices: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """``mapInArrow`` with a function of one batch, never an empty one.

    Batches of more than ``most_rows`` rows are handed over in slices, or cut by ``slices``.
    """
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if slices is not None:
                yield from map(function, slices(batch))
                continue
            for start in range(0, batch.num_rows, most_rows or max(batch.num_rows, 1)):
                yield function(batch.slice(start, most_rows))

    return rows.mapInArrow(run, schema)


def bucket_digits(rows: int, least: int = 1000) -> int:
    """Hex digits of a hash that cut so many rows into buckets of about max(least, sqrt(rows))."""
    digits = 0
    while rows > max(least, rows**0.5) * 16**digits:
        digits += 1
    return digits
