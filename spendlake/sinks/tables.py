"""Partitioned Parquet tables, published version by version.

A table is a folder below its database.  Every write goes to folders of its own, named by a fresh
version (``version=..`` below the table or below each partition it touches), and counts only once
a pointer to it is there: a small numbered file next to the table that names the schema, comments,
description and the folder of every partition.  Pointers are written under another name and
renamed, and the highest number holds, so a reader, another session or a driver that was lost
half-way sees the table before a change or after it, never between.  Folders that no pointer
names any more are deleted after the change, those of a write that never ended by the next one.

The session catalog is defined from the pointer: a table carries the number it was defined from,
and is defined again when that is no longer the last, so tables outlive a session whose catalog
does not.  A table has one writer at a time.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructField, StructType

from spendlake.settings import Settings, passing_shuffles, shared_folder
from spendlake.sinks.schema import SchemaChange, columns_of, compare
from spendlake.sources.landing import (
    delete_folder,
    file_names,
    matching_paths,
    read_small,
    rename,
    write_text,
)

log = logging.getLogger(__name__)

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Layout:
    """How a table is stored and described."""

    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    description: str = ""
    column_comments: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Pointer:
    """What a table holds from one change to the next."""

    number: int
    schema: StructType
    partition: str | None
    description: str
    #: Partition value (``""`` for a table without partitions) -> folder below the table.
    folders: Mapping[str, str]
    #: Fields that were dropped from the table while files still hold them.
    dropped: tuple[str, ...] = ()

    def text(self) -> str:
        content = vars(self) | {"schema": self.schema.jsonValue()}
        return json.dumps(content)

    @staticmethod
    def of(text: str) -> Pointer:
        content = json.loads(text)
        content["schema"] = StructType.fromJson(content["schema"])
        return Pointer(**content | {"dropped": tuple(content["dropped"])})


def arrange(df: DataFrame, layout: Layout, folders: Iterable[str] = ()) -> DataFrame:
    """Order rows for the files to be written, in partitions and further ``folders`` below them.

    The rebalance puts a partition's rows together, but cuts one that is larger than the
    advisory size into several tasks and merges small ones, so neither a hot day nor many thin
    days hurt.  Sorting by the clustering columns makes row-group statistics selective.
    """
    if layout.partition_by:
        df = df.hint("rebalance", layout.partition_by)
        return df.sortWithinPartitions(layout.partition_by, *folders, *layout.cluster_by)
    if layout.cluster_by:
        return df.hint("rebalance").sortWithinPartitions(*layout.cluster_by)
    return df


def arrange_by_range(
    df: DataFrame, layout: Layout, files: int, folders: Iterable[str] = ()
) -> DataFrame:
    """Like ``arrange``, but cut at sampled bounds of the clustering columns, into some ``files``.

    A hash of the row comes last in the order, so a hot value is cut as well, into files that hold
    nothing else.  Spark samples the bounds, which reads the rows twice.
    """
    spread = F.xxhash64(*[f.name for f in df.schema if isinstance(f.dataType, AtomicType)])
    partition = [layout.partition_by] if layout.partition_by else []
    cut = df.repartitionByRange(files, *partition, *layout.cluster_by, spread)
    return cut.sortWithinPartitions(*partition, *folders, *layout.cluster_by)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column_ddl(field_: StructField) -> str:
    comment = field_.metadata.get("comment")
    suffix = f" COMMENT {_quoted(comment)}" if comment else ""
    return f"`{field_.name}` {field_.dataType.simpleString()}{suffix}"


class Warehouse:
    """One database of tables."""

    def __init__(self, spark: SparkSession, settings: Settings = Settings()) -> None:
        self.spark = spark
        self.database = settings.database
        self.base_path = (settings.base_path or shared_folder(spark)).rstrip("/")
        self.kept_versions = settings.kept_versions
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
            f"LOCATION {_quoted(f'{self.base_path}/{self.database}')}"
        )

    def full_name(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def location(self, name: str) -> str:
        return f"{self.base_path}/{self.database}/{name}"

    def exists(self, name: str) -> bool:
        """Whether the table is known, after looking for one of an earlier session."""
        pointer = self._pointer(name)
        if pointer is None:
            return False
        self._define(name, pointer)
        return True

    def read(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise ValueError(f"{self.database}.{name} has not been built")
        return self.spark.table(self.full_name(name))

    def replace(
        self, name: str, df: DataFrame | Sequence[DataFrame], layout: Layout = Layout()
    ) -> None:
        """Create the table, or replace it whole.

        Several parts are written one after the other and published together.
        """
        parts = [df] if isinstance(df, DataFrame) else df
        parts = [self._with_comments(part, layout) for part in parts]
        described = parts[0]
        before = self._pointer(name)
        self._clear_unfinished(name)
        folders = self._written(name, parts, layout)
        fields = [f for f in described.schema.fields if f.name != layout.partition_by]
        fields += [f for f in described.schema.fields if f.name == layout.partition_by]
        schema = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in fields])
        number = before.number + 1 if before else 1
        self._publish(
            name, Pointer(number, schema, layout.partition_by, layout.description, folders)
        )

    def drop(self, name: str) -> None:
        """Forget a table and delete its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(name)}")
        delete_folder(self.spark, self._pointers(name))
        delete_folder(self.spark, self.location(name))

    def overwrite_partitions(
        self,
        name: str,
        df: DataFrame,
        layout: Layout,
        low: date | None = None,
        drop_vanished: bool = True,
    ) -> list[date]:
        """Replace exactly the partitions present in ``df``; returns them.

        With ``drop_vanished``, partitions on or after ``low`` that the batch no longer
        has a row for are emptied too; older ones are never touched.  All of it, a change of the
        schema included, is published at once.
        """
        described = self._with_comments(df, layout)
        self._clear_unfinished(name)
        pointer, change = self._with_schema(name, described.schema)
        batch = described.select(*columns_of(described.schema, change.schema))
        folders = self._written(name, [batch], layout)
        kept = dict(pointer.folders)
        if drop_vanished:
            bound = low.isoformat() if low else ""
            gone = [d for d in kept if d != NULL_PARTITION and d >= bound and d not in folders]
            for day in gone:
                del kept[day]
        passing = set(pointer.folders.values()) - set(self._pointer(name).folders.values())
        self._publish(name, self._next(pointer, folders={**kept, **folders}), passing)
        return sorted(date.fromisoformat(d) for d in folders if d != NULL_PARTITION)

    def recluster(self, name: str, layout: Layout) -> list[str]:
        """Make the files of each partition disjoint in the clustering columns; returns partitions.

        A write cuts a hot day into files that may each span all clustering values.  Here the
        partitions of several files whose ranges cross are written anew, at sampled bounds, and
        published at once; a filter on the leading clustering columns then reads few files of a
        day.  Partitions of one file or of disjoint files are neither rewritten nor, the former,
        read.  Null clustering values come first, equal rows may fill several files.
        """
        if not layout.cluster_by or not self.exists(name):
            return []
        pointer = self._pointer(name)
        several = [
            value
            for value, folder in pointer.folders.items()
            if len(self._data_files(name, folder)) > 1
        ]
        crossing = {
            row.partition: row.files
            for row in self._crossing(self._rows_of(name, pointer, several), layout).collect()
        }
        if not crossing:
            return []
        self._clear_unfinished(name)
        rows = self._rows_of(name, pointer, list(crossing))
        folders = self._written(name, [rows], layout, sum(crossing.values()))
        self._publish(name, self._next(pointer, folders={**pointer.folders, **folders}))
        return sorted(crossing)

    def partition_dates(self, name: str) -> list[date]:
        """Dates the table has a partition for, from its pointer alone."""
        if not self.exists(name):
            raise ValueError(f"{self.database}.{name} has not been built")
        days = self._pointer(name).folders
        return sorted(date.fromisoformat(d) for d in days if d not in ("", NULL_PARTITION))

    def high_water_mark(self, name: str) -> date | None:
        """Latest partition date; no data file is read."""
        return max(self.partition_dates(name), default=None)

    def sync_schema(self, name: str, df: DataFrame) -> SchemaChange:
        """Give the table the columns of ``df``, and the wider type of both, at any depth.

        Old rows read NULL in new fields, fields ``df`` lacks are dropped.  Old files are read with
        a wider type; only where they cannot be, or where a dropped field comes back under its old
        name, are the partitions written anew.  Types that do not fit are an error.
        """
        before = self._pointer(name)
        self._clear_unfinished(name)
        pointer, change = self._with_schema(name, df.schema)
        if pointer != before:
            self._publish(name, self._next(pointer))
        return change

    def describe_columns(self, name: str) -> dict[str, str]:
        """Column comments stored with the table."""
        return {f.name: f.metadata.get("comment", "") for f in self.read(name).schema}

    def _with_comments(self, df: DataFrame, layout: Layout) -> DataFrame:
        for column, text in layout.column_comments.items():
            df = df.withMetadata(column, {"comment": text})
        return df

    # --- writing and publishing ---

    def _data_files(self, name: str, folder: str) -> list[str]:
        names = file_names(self.spark, f"{self.location(name)}/{folder}")
        return [n for n in names if not n.startswith(("_", "."))]

    def _rows_of(self, name: str, pointer: Pointer, values: list[str]) -> DataFrame:
        """Rows of some partitions, by their names in the pointer."""
        rows = self.read(name)
        if not pointer.partition:
            return rows if values else rows.limit(0)
        column = F.col(pointer.partition)
        dates = [date.fromisoformat(v) for v in values if v != NULL_PARTITION]
        wanted = column.isin(dates) if dates else F.lit(False)
        return rows.where(wanted | column.isNull() if NULL_PARTITION in values else wanted)

    def _crossing(self, rows: DataFrame, layout: Layout) -> DataFrame:
        """``partition, files`` of partitions with files whose clustering ranges cross."""
        by = layout.partition_by
        value = F.coalesce(F.col(by).cast("string"), F.lit(NULL_PARTITION)) if by else F.lit("")
        key = F.struct(*layout.cluster_by)
        files = rows.groupBy(
            value.alias("partition"), F.col("_metadata.file_path").alias("file")
        ).agg(F.min(key).alias("low"), F.max(key).alias("high"))
        before = Window.partitionBy("partition").orderBy("low", "high")
        highest = F.max("high").over(before.rowsBetween(Window.unboundedPreceding, -1))
        return (
            files.withColumn("crosses", F.col("low") < highest)
            .groupBy("partition")
            .agg(F.count("*").alias("files"), F.bool_or("crosses").alias("crossing"))
            .where("crossing")
        )

    def _written(
        self, name: str, parts: Sequence[DataFrame], layout: Layout, files: int | None = None
    ) -> dict[str, str]:
        """Write the rows of all parts under a new version; the folder of each partition, below the table.

        With a number of ``files``, rows are cut by ranges of the clustering columns.
        """
        cut = partial(arrange_by_range, files=files) if files else arrange
        version, root, column = uuid.uuid4().int >> 66, self.location(name), layout.partition_by
        write_text(self.spark, f"{self._pointers(name)}/started-{version}", "")
        if not column:
            for df in parts:
                with passing_shuffles(self.spark):
                    cut(df, layout).write.mode("append").parquet(f"{root}/version={version}")
            return {"": f"version={version}"}
        days: set[str] = set()
        for df in parts:
            seen = Observation(f"partitions of {name}")
            # No literal: Spark would leave it out of the sort, and then sort once more without clusters.
            number = F.col(column).isNull().cast("long") * 0 + F.lit(version)
            observed = df.withColumn("version", number).observe(
                seen,
                F.collect_set(column).alias("present"),
                F.coalesce(F.max(F.col(column).isNull()), F.lit(False)).alias("without"),
            )
            rows = cut(observed, layout, folders=["version"])
            with passing_shuffles(self.spark):
                rows.write.mode("append").partitionBy(column, "version").parquet(root)
            days |= {str(day) for day in seen.get["present"]}
            days |= {NULL_PARTITION} if seen.get["without"] else set()
        return {day: f"{column}={day}/version={version}" for day in days}

    def _with_schema(self, name: str, wanted: StructType) -> tuple[Pointer, SchemaChange]:
        """The pointer a table will have with the columns of a batch, not yet published.

        Partitions are written anew here if the files cannot be read with them.
        """
        pointer = self._pointer(name)
        if pointer is None:
            raise ValueError(f"{self.database}.{name} has not been built")
        try:
            change = compare(pointer.schema, wanted)
        except ValueError as error:
            raise ValueError(f"{name}: {error}") from None
        if pointer.partition in (*change.widened, *change.rewritten, *change.removed):
            raise ValueError(f"{name}: type of {pointer.partition} changed, rebuild the table")
        if not change:
            return pointer, change
        column = pointer.partition
        last = [f for f in change.schema.fields if f.name == column]
        change.schema = StructType([f for f in change.schema.fields if f.name != column] + last)
        folders, dropped = pointer.folders, {*pointer.dropped, *change.removed}
        if change.rewritten or set(change.added) & set(pointer.dropped):
            old = self.read(name)
            rows = old.select(*columns_of(old.schema, change.schema))
            folders, dropped = self._written(name, [rows], Layout(column)), set()
        log.info("%s: %s", name, change)
        synced = Pointer(
            pointer.number, change.schema, column, pointer.description, folders, tuple(sorted(dropped))
        )
        return synced, change

    def _next(self, pointer: Pointer, **changes: object) -> Pointer:
        return Pointer(**vars(pointer) | {"number": pointer.number + 1} | changes)

    def _pointers(self, name: str) -> str:
        return f"{self.location(name)}.versions"

    def _numbers(self, name: str) -> list[int]:
        names = file_names(self.spark, self._pointers(name))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _pointer(self, name: str, number: int | None = None) -> Pointer | None:
        """The pointer of that number, by default the last."""
        if number is None:
            number = max(self._numbers(name), default=None)
        if number is None:
            return None
        return Pointer.of(read_small(self.spark, f"{self._pointers(name)}/{number:010}.json"))

    def _publish(self, name: str, pointer: Pointer, passing: Iterable[str] = ()) -> None:
        """Make a change count, follow it in the catalog, then delete what it superseded.

        ``passing`` are folders written on the way that no pointer came to name.
        """
        target = f"{self._pointers(name)}/{pointer.number:010}.json"
        write_text(self.spark, f"{target}.new", pointer.text())
        rename(self.spark, f"{target}.new", target)
        self._define(name, pointer)
        for folder in set(passing) - set(pointer.folders.values()):
            self._delete_version(name, folder)
        self._collect(name)

    def _collect(self, name: str) -> None:
        """Delete folders that only pointers older than the kept ones name, and those pointers."""
        numbers = self._numbers(name)
        split = max(0, len(numbers) - 1 - max(0, self.kept_versions))
        used = {f for n in numbers[split:] for f in self._pointer(name, n).folders.values()}
        for number in numbers[:split]:
            for folder in set(self._pointer(name, number).folders.values()) - used:
                self._delete_version(name, folder)
            delete_folder(self.spark, f"{self._pointers(name)}/{number:010}.json")
        for started in self._started(name):
            if any(folder.endswith(f"version={started}") for folder in used):
                delete_folder(self.spark, f"{self._pointers(name)}/started-{started}")

    def _delete_version(self, name: str, folder: str) -> None:
        """Delete a version, and its partition's folder if nothing else is in it."""
        delete_folder(self.spark, f"{self.location(name)}/{folder}")
        partition = f"{self.location(name)}/{folder}".rpartition("/version=")[0]
        if partition != self.location(name) and not file_names(self.spark, partition):
            delete_folder(self.spark, partition)

    def _started(self, name: str) -> list[str]:
        names = file_names(self.spark, self._pointers(name))
        return [n.removeprefix("started-") for n in names if n.startswith("started-")]

    def _clear_unfinished(self, name: str) -> None:
        """Delete what writes left that never were published."""
        pointers = [self._pointer(name, n) for n in self._numbers(name)]
        used = {folder for pointer in pointers for folder in pointer.folders.values()}
        root = self.location(name)
        for version in self._started(name):
            for pattern in (f"{root}/version={version}", f"{root}/*/version={version}"):
                for path in matching_paths(self.spark, pattern):
                    folder = path.rpartition(f"/{name}/")[2]
                    if folder not in used:
                        self._delete_version(name, folder)
            delete_folder(self.spark, f"{self._pointers(name)}/started-{version}")

    # --- the session catalog ---

    def _defined(self, name: str) -> int | None:
        """The number of the pointer that a table of the catalog was defined from."""
        if not self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return None
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(name)}").collect()
        return next((int(r.value) for r in properties if r.key == "spendlake.number"), -1)

    def _define(self, name: str, pointer: Pointer) -> None:
        """Define the external table as the pointer says; no data moves."""
        if self._defined(name) == pointer.number:
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(name)}")
        columns = ", ".join(_column_ddl(f) for f in pointer.schema)
        folder = f"/{pointer.folders['']}" if "" in pointer.folders else ""
        clauses = f"USING parquet LOCATION {_quoted(self.location(name) + folder)}"
        if pointer.partition:
            clauses += f" PARTITIONED BY (`{pointer.partition}`)"
        if pointer.description:
            clauses += f" COMMENT {_quoted(pointer.description)}"
        clauses += f" TBLPROPERTIES ('spendlake.number' = '{pointer.number}')"
        self.spark.sql(f"CREATE TABLE {self.full_name(name)} ({columns}) {clauses}")
        if pointer.partition:
            self._add_partitions(name, pointer.partition, pointer.folders.items())

    def _add_partitions(self, name: str, column: str, folders: Iterable[tuple[str, str]]) -> None:
        specs = [
            f"PARTITION (`{column}` = {'NULL' if day == NULL_PARTITION else f'DATE{_quoted(day)}'}) "
            f"LOCATION {_quoted(f'{self.location(name)}/{folder}')}"
            for day, folder in folders
        ]
        for start in range(0, len(specs), 500):
            some = " ".join(specs[start : start + 500])
            self.spark.sql(f"ALTER TABLE {self.full_name(name)} ADD {some}")
