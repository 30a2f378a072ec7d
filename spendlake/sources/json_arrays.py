"""Elements of large JSON array files, found by many tasks.

A file is read in pieces that end at ``}``, which Spark can start reading at any byte.  Whether a
piece begins inside a string, and how deep, depends on all text before it.  So a first pass notes
for each split of a file what it does to either state: whether it leaves a string open, and how
many levels it opens if it was entered outside or inside a string.  Running sums over the splits
of a file give the state each one is entered in, and a second pass cuts its pieces into elements.
Only what lies across the border of splits is put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Where a piece of text lies: one split of one file.
_SPLIT = ["file", "block"]


class MalformedArray(ValueError):
    """A file that is no whole JSON array of objects."""


def _scanner() -> Callable[[str], tuple[int, tuple[int, int]]]:
    """A function of a piece: quotes in it, and levels opened if entered outside or in a string.

    The ``}`` that ended the piece counts.  Made here so that it travels to the tasks by value.
    """
    import re

    escaped = re.compile(r"\\.", re.DOTALL)

    def scan(piece: str) -> tuple[int, tuple[int, int]]:
        parts = (escaped.sub("", piece) if "\\" in piece else piece).split('"')
        quotes = len(parts) - 1

        def levels(inside: int) -> int:
            opened = sum(p.count("{") + p.count("[") - p.count("]") for p in parts[inside::2])
            return opened - ((inside + quotes) % 2 == 0)

        return quotes, (levels(0), levels(1))

    return scan


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def _effects(pieces: DataFrame) -> DataFrame:
    """``file, block, quotes, outside, inside``: what each split does to the state."""
    scan = _scanner()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["file", "block", "quotes", "outside", "inside"]
        split, quotes, levels = None, 0, [0, 0]
        for batch in batches:
            done = []
            for file, block, value in batch.itertuples(index=False, name=None):
                if (file, block) != split:
                    if split is not None:
                        done.append((*split, quotes % 2, *levels))
                    split, quotes, levels = (file, block), 0, [0, 0]
                more, opened = scan(value)
                for entered in (0, 1):
                    levels[entered] += opened[(entered + quotes) % 2]
                quotes += more
            yield pd.DataFrame(done, columns=names)
        if split is not None:
            yield pd.DataFrame([(*split, quotes % 2, *levels)], columns=names)

    return pieces.mapInPandas(run, "file string, block long, quotes int, outside long, inside long")


def _states(effects: DataFrame) -> DataFrame:
    """``file, block, in_string, depth, last_string, last_depth``: before and after each split."""
    so_far = Window.partitionBy("file").orderBy("block")
    quotes = F.sum("quotes").over(so_far)
    entered = effects.withColumn("last_string", quotes % 2).withColumn(
        "in_string", (quotes - F.col("quotes")) % 2
    )
    change = F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside"))
    depth = F.sum("change").over(so_far)
    return entered.withColumn("change", change).select(
        *_SPLIT, "in_string", (depth - F.col("change")).alias("depth"), "last_string", depth.alias("last_depth")
    )


def _cut(pieces: DataFrame) -> DataFrame:
    """``file, block, part, text`` from pieces in order, each with the state of its split.

    Whole elements have part NULL; what goes on from the split before has part 0, what goes on in
    the next one part 1.
    """
    scan = _scanner()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        first, further = re.compile(r"\s*\[\s*(?=\{)"), re.compile(r"\s*,\s*(?=\{)")
        nothing, closing = re.compile(r"\s*(\[\s*\]\s*)?"), re.compile(r"\s*\]\s*")
        names = ["file", "block", "part", "text"]
        split, inside, depth, held, part = None, 0, 0, [], None

        def malformed(text: str) -> ValueError:
            return ValueError(f"{split[0]}: not a JSON array of objects near {text[:80]!r}")

        def rest() -> list[tuple]:
            return [(*split, 0 if part == 0 else 1, "".join(held))] if held else []

        for batch in batches:
            done = []
            for file, block, value, in_string, entered in batch.itertuples(index=False, name=None):
                if (file, block) != split:
                    done += rest()
                    split, inside, depth, held = (file, block), in_string, entered, []
                    part = 0 if in_string or entered > 1 else None
                quotes, opened = scan(value)
                after = depth + opened[inside]
                if not held and part is None:  # between elements
                    if after < 0:
                        if not (closing if depth else nothing).fullmatch(value):
                            raise malformed(value)
                        depth = after
                        continue
                    start = depth in (0, 1) and (further if depth else first).match(value)
                    if not start:
                        raise malformed(value)
                    value = value[start.end() :]
                inside, depth = (inside + quotes) % 2, after
                held += [value, "}"]
                if not inside and depth == 1:
                    done.append((*split, part, "".join(held)))
                    held, part = [], None
            yield pd.DataFrame(done, columns=names).astype({"part": "Int32"})
        if split is not None:
            yield pd.DataFrame(rest(), columns=names).astype({"part": "Int32"})

    return pieces.mapInPandas(run, "file string, block long, part int, text string")


def array_elements(spark: SparkSession, path: str | list[str], scratch: str) -> DataFrame:
    """``value``: the text of each element of JSON array files, on one line.

    ``scratch`` is a new folder that all executors share; the parts of elements are kept there.
    Files that end too early or too late are an error here, text between elements that does not
    belong there when the rows are read.  An empty file has no elements.
    """
    pieces = _pieces(spark, path)
    _effects(pieces).write.parquet(f"{scratch}/effects")
    effects = spark.read.parquet(f"{scratch}/effects")
    states = _states(effects)
    ends = states.groupBy("file").agg(F.max_by(F.struct("last_string", "last_depth"), "block").alias("end"))
    # The last piece has no brace, so one level too many is closed.
    broken = ends.where((F.col("end.last_string") != 0) | (F.col("end.last_depth") != -1)).first()
    if broken:
        raise MalformedArray(f"{broken.file}: not a whole JSON array")
    numbered = pieces.withColumn("number", F.monotonically_increasing_id())
    placed = numbered.join(states.select(*_SPLIT, "in_string", "depth"), _SPLIT)
    ordered = placed.sortWithinPartitions(*_SPLIT, "number")
    _cut(ordered.select(*_SPLIT, "value", "in_string", "depth")).write.parquet(f"{scratch}/parts")
    parts = spark.read.parquet(f"{scratch}/parts")
    across = parts.where(F.col("part").isNotNull())
    # An element goes from one part 1 to the last part 0 before the next.
    order = Window.partitionBy("file").orderBy("block", "part")
    begun = across.select(*_SPLIT, "part", F.sum("part").over(order).alias("element"))
    joined = (
        across.join(begun, [*_SPLIT, "part"])
        .groupBy("file", "element")
        .agg(F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("texts"))
        .select(F.array_join("texts.text", "").alias("text"))
    )
    whole = parts.where(F.col("part").isNull()).select("text").unionByName(joined)
    return whole.select(F.translate("text", "\r\n", "  ").alias("value"))
