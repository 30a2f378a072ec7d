"""Run settings and the session options the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """Everything a run can be told from outside.

    ``incremental`` is off by default: a run then rebuilds every table.  With it on,
    the usage models only rebuild the partitions inside the lookback window, unless
    ``full_refresh`` asks for the whole history without dropping the tables.
    ``as_of`` fixes the date tenures are measured against; unset means today.
    ``landing_database`` is the name the raw models stamp their rows with.  ``kept_versions``
    superseded versions of each table stay on disk, for readers that began before a change.
    With more than one of ``turns``, whole builds of the marts of usage lines take the customers
    in so many shares one after the other, and the shuffle files of one share lie on disk at a time.
    """

    reporting_currency: str = "USD"
    lookback_days: int = 3
    incremental: bool = False
    full_refresh: bool = False
    as_of: date | None = None
    database: str = "spendlake"
    landing_database: str = "landing"
    base_path: str | None = None
    kept_versions: int = 0
    turns: int = 1

    def as_of_date(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)


# Runtime options only: memory, cores and the shuffle width belong to the cluster.
SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sides up to this size are broadcast, beyond it sorted and merged.  Spark checks it against
    # file sizes when it plans and against shuffled bytes when it runs, both compressed: 64 MB can
    # be 9 million orders, 600 MB in the driver.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    # Split a hot join key even where the next operator wanted that partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Group on all keys even if the rows already lie by one of them, say the customer after a
    # join: otherwise a hot customer's rows are aggregated raw in one task.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # Lets a rebalance before a write cut a hot day into several files.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the options above on a session somebody else created, where they are not set."""
    chosen = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for name, value in SESSION_OPTIONS.items():
        if name not in chosen:
            spark.conf.set(name, value)
    return spark


#: Spark then removes the shuffle files of an execution when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of writes inside go as each write ends.

    They would otherwise stay until the driver happens to collect its garbage, and those of all
    tables of a build lie on disk together.  For writes alone: each plans its rows anew, whereas a
    DataFrame collected twice would shuffle twice.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.  All paths of an
    application lie in one folder, which goes when its JVM ends.
    """
    context = spark.sparkContext
    scratch = getattr(context, "_spendlake_scratch", None)
    if scratch is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.gettempdir()
        scratch = f"{root.rstrip('/')}/spendlake-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(scratch)
        file_system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        file_system.mkdirs(path)
        file_system.deleteOnExit(path)
        context._spendlake_scratch = scratch
    return f"{scratch}/{uuid.uuid4().hex}"
