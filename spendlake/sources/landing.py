"""Landing the JSON exports as Parquet tables with explicit nested schemas."""

from __future__ import annotations

import logging
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from spendlake.settings import shared_folder
from spendlake.sources.json_arrays import MalformedArray, array_elements

log = logging.getLogger(__name__)


class LandingError(ValueError):
    """An export file does not have the agreed shape."""


def _file_system(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, whichever Spark can read."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or glob exists on any file system Spark can read."""
    jvm_path, file_system = _file_system(spark, path)
    found = file_system.globStatus(jvm_path)
    return found is not None and len(found) > 0


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob."""
    jvm_path, file_system = _file_system(spark, pattern)
    return [status.getPath().toString() for status in file_system.globStatus(jvm_path) or []]


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, none if there is no such folder."""
    jvm_path, file_system = _file_system(spark, folder)
    if not file_system.exists(jvm_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(jvm_path)]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files of a folder."""
    jvm_path, file_system = _file_system(spark, path)
    return file_system.getContentSummary(jvm_path).getLength()


def rename(spark: SparkSession, source: str, target: str) -> None:
    jvm_path, file_system = _file_system(spark, source)
    if not file_system.rename(jvm_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm_path, file_system = _file_system(spark, path)
    file_system.delete(jvm_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    jvm_path, file_system = _file_system(spark, path)
    stream = file_system.create(jvm_path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_small(spark: SparkSession, path: str) -> str:
    """A small file as text, read in the driver without a job."""
    jvm_path, file_system = _file_system(spark, path)
    stream = file_system.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def infer_schema(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> StructType:
    """Schema as found in the files: for drafting or checking a schema, not for reading."""
    return spark.read.option("multiLine", multi_line).json(path).schema


def field_paths(schema: DataType, prefix: str = "") -> set[str]:
    """Dotted names of all fields, looking into structs and arrays of structs."""
    if isinstance(schema, ArrayType):
        return field_paths(schema.elementType, prefix)
    if not isinstance(schema, StructType):
        return set()
    paths: set[str] = set()
    for field in schema.fields:
        name = f"{prefix}{field.name}"
        paths.add(name)
        paths |= field_paths(field.dataType, f"{name}.")
    return paths


def reject_unknown_fields(
    spark: SparkSession, path: str | list[str], schema: str, multi_line: bool = False
) -> None:
    """Raise when the files hold a field, at any depth, that the schema does not know."""
    known = field_paths(StructType.fromDDL(schema))
    unknown = field_paths(infer_schema(spark, path, multi_line)) - known
    if unknown:
        raise LandingError(f"{path}: unknown fields {sorted(unknown)}")


def _first_character(spark: SparkSession, path: str) -> str:
    """The first character of a file that is no white space; no more of it is read."""
    jvm_path, file_system = _file_system(spark, path)
    stream = file_system.open(jvm_path)
    try:
        while (byte := stream.read()) >= 0:
            if not chr(byte).isspace():
                return chr(byte)
        return ""
    finally:
        stream.close()


def _reject_non_array(spark: SparkSession, path: str | list[str]) -> None:
    """Raise when the first text of a file does not open a JSON array; reads the files' starts."""
    for file in spark.read.text(path).inputFiles():
        if _first_character(spark, file) not in ("[", ""):
            raise LandingError(f"{file} is not a JSON array")


#: Bytes up to which one task reads a whole JSON array file.
WHOLE_FILE_BYTES = 1 << 30


def _by_size(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Files that one task can read, and those it should not; a compressed one cannot be cut."""
    files: tuple[list[str], list[str]] = ([], [])
    for file in spark.read.text(path).inputFiles():
        jvm_path, file_system = _file_system(spark, file)
        large = file_system.getFileStatus(jvm_path).getLen() > WHOLE_FILE_BYTES
        compressed = file.lower().endswith((".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate"))
        files[large and not compressed].append(file)
    return files


def read_json_array(
    spark: SparkSession, path: str, schema: str, strict: bool = True
) -> DataFrame:
    """Rows of pretty-printed JSON array files, one row per array element.

    Each file is read by a single task, the cheapest way for many files of ordinary size; those
    above ``WHOLE_FILE_BYTES`` are read by ``read_split_array``.
    """
    if strict:
        _reject_non_array(spark, path)
    whole, large = _by_size(spark, path)
    if not large:
        return _read_whole_arrays(spark, path, schema, strict)
    parts = [read_split_array(spark, large, schema, strict)]
    if whole:
        parts.append(_read_whole_arrays(spark, whole, schema, strict))
    return reduce(DataFrame.unionByName, parts)


def _read_whole_arrays(
    spark: SparkSession, path: str | list[str], schema: str, strict: bool
) -> DataFrame:
    if strict:
        reject_unknown_fields(spark, path, schema, multi_line=True)
    return spark.read.schema(schema).options(multiLine=True, mode="FAILFAST").json(path)


def read_split_array(
    spark: SparkSession, path: str | list[str], schema: str, strict: bool = True
) -> DataFrame:
    """The same rows, from files that are each cut into their elements by many tasks.

    It takes far more processor time than one task would, spread over the cluster.  The elements
    are written one a line to the shared scratch folder and read from there, so land an export
    once and read the landed table.
    """
    if strict:
        _reject_non_array(spark, path)
    scratch = shared_folder(spark)
    try:
        array_elements(spark, path, scratch).write.text(f"{scratch}/lines")
    except MalformedArray as error:
        raise LandingError(str(error)) from None
    return read_ndjson(spark, f"{scratch}/lines", schema, strict)


def read_ndjson(
    spark: SparkSession, path: str, schema: str, strict: bool = True
) -> DataFrame:
    """Rows of newline-delimited JSON; the files are split over many tasks."""
    if strict:
        reject_unknown_fields(spark, path, schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


READERS = {"array": read_json_array, "split_array": read_split_array, "ndjson": read_ndjson}


def land(
    spark: SparkSession,
    source: str,
    target: str,
    schema: str,
    layout: str = "array",
    strict: bool = True,
) -> int | None:
    """Replace the landing table at ``target`` with the rows of ``source``, read as ``layout`` says.

    Returns the number of rows landed, or None when there is no such file: the load of that
    table is then skipped and the old landing table stays.
    """
    if not path_exists(spark, source):
        log.warning("skipping %s: not found", source)
        return None
    READERS[layout](spark, source, schema, strict).write.mode("overwrite").parquet(target)
    landed = spark.read.schema(schema).parquet(target).count()
    log.info("%s: landed %s rows", target, landed)
    return landed


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, row_count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def freshness(
    df: DataFrame,
    loaded_at: str,
    now: Column | None = None,
    max_age: timedelta | None = None,
) -> DataFrame:
    """Newest ``loaded_at`` value and its age; ``is_stale`` when a largest age is given."""
    moment = F.current_timestamp() if now is None else now
    newest = df.agg(F.max(loaded_at).alias("newest"))
    age = (F.unix_timestamp(moment) - F.unix_timestamp("newest")).cast("long")
    result = newest.select("newest", age.alias("age_seconds"))
    if max_age is None:
        return result
    return result.withColumn(
        "is_stale",
        F.col("newest").isNull() | (F.col("age_seconds") > int(max_age.total_seconds())),
    )
