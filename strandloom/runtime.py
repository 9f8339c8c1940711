"""Session helpers: scratch tables that cut lineage, spreading, size checks.

Lineage is cut by writing a Parquet table into the folder that the cluster
names in ``spark.checkpoint.dir`` and reading it back. Such a table survives
the loss of any executor, is columnar and compressed, and tells Catalyst its
true size, so that broadcasts are chosen on a measured size.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast by hint; beyond it the same join runs as a shuffle.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20

_own_folder: str | None = None


def session(cores: int | str = 8, shuffle_partitions: int | None = None, memory: str = "12g") -> SparkSession:
    """A local session with the settings that this library is tuned for; on a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strandloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that their Python workers can import it wherever they start."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="strandloom-code-")  # on the driver, which serves it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "strandloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.join("strandloom", os.path.relpath(full, package)))
    spark.sparkContext.addPyFile(archive)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where it is unset, a folder of our own, if driver and executors are one process."""
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="strandloom-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return "file://" + _own_folder


def release(spark: SparkSession) -> None:
    """Delete all scratch tables of this application. Frames that read them can't be used any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/strandloom/{spark.sparkContext.applicationId}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_released: set[str] = set()


def _release_at_exit(spark: SparkSession) -> None:
    """Results read their scratch tables, so these live as long as the driver; a driver that is killed leaves them behind."""
    app = spark.sparkContext.applicationId
    if app in _released:
        return
    _released.add(app)

    def leave() -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            if spark.sparkContext.applicationId == app:
                release(spark)

    atexit.register(leave)


class Scratch:
    """Written tables of one job. ``save`` cuts lineage, ``drop`` frees a table that is no longer read; what is left goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        _release_at_exit(spark)
        self.spark = spark
        self.home = f"{scratch_root(spark)}/strandloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def save(self, df: DataFrame, label: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.home}/{self._n:03d}-{label}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # type: ignore[attr-defined]
        return out

    def counted(self, df: DataFrame, label: str = "t", **figures: Column) -> tuple[DataFrame, dict[str, int]]:
        """``save``, and figures that the write itself observes: ``rows`` and the given aggregates. No job of their own is run."""
        seen = Observation()
        out = self.save(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in figures.items())), label)
        return out, {k: v or 0 for k, v in seen.get.items()}

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = getattr(table, "_scratch_path", None)
            if path:
                jvm = self.spark._jvm
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def table_bytes(spark: SparkSession, table: DataFrame) -> int:
    """Bytes on disk of a table that ``Scratch.save`` wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)  # type: ignore[attr-defined]
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def spread(df: DataFrame) -> DataFrame:
    """Give a Python stage as many partitions as there are cores, if a small input has fewer."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)
