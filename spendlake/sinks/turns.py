"""Large plans in turns: the rows of some keys after those of others.

A plan whose groups, joins and windows all hold one column in their keys gives the same rows
when the values of that column are dealt into shares and the shares are worked out one after the
other.  Only the shuffle files of one share then lie on disk at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.settings import passing_shuffles, shared_folder
from spendlake.sources.landing import delete_folder, file_names, stored_bytes

#: Bytes of input files that a turn should take at most, and the most turns there are: each turn
#: plans the dimensions anew, so their number must not grow with the data.
TURN_BYTES = 128 << 20
MOST_TURNS = 8


def turns_for(spark: SparkSession, path: str) -> int:
    """In how many turns a plan over these files should run."""
    return min(MOST_TURNS, max(1, ceil(stored_bytes(spark, path) / TURN_BYTES)))


def is_turn(key: Column | str, turn: int, turns: int) -> Column:
    """Whether a row's key belongs to a turn; NULL is a key like any other."""
    return F.pmod(F.xxhash64(key), F.lit(turns)) == turn


def in_turns(
    lines: DataFrame, key: str, turns: int, plan: Callable[[DataFrame, int], DataFrame]
) -> DataFrame:
    """The rows of ``plan(share of the lines, turn)`` of all turns, from the shared scratch folder.

    The lines are worked out once and written by turns; a share is deleted when its turn ends.
    """
    spark, folder = lines.sparkSession, shared_folder(lines.sparkSession)
    with passing_shuffles(spark):
        dealt = lines.withColumn("_turn", F.pmod(F.xxhash64(key), F.lit(turns)))
        dealt.write.option("compression", "zstd").partitionBy("_turn").parquet(f"{folder}/lines")
        for turn in range(turns):
            path = f"{folder}/lines/_turn={turn}"
            if file_names(spark, path):
                share = spark.read.schema(lines.schema).parquet(path)
            else:
                share = spark.createDataFrame([], lines.schema)
            rows = plan(share, turn)
            rows.write.option("compression", "zstd").parquet(f"{folder}/rows/{turn}")
            delete_folder(spark, path)
    return spark.read.schema(rows.schema).parquet(*[f"{folder}/rows/{turn}" for turn in range(turns)])
