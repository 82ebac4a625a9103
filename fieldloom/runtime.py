"""Session, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a written table is measured for a broadcast at all, and bytes up to which it then is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def session(app: str = "fieldloom", cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and bench, whose workers get this package; clusters bring their own session and call ship() where the package isn't installed."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    ship(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all executors share; one of our own only where it is unset (local runs)."""
    global _own
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own is None or not os.path.isdir(_own):
        _own = tempfile.mkdtemp(prefix="fieldloom-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return f"file://{_own}"


class Scratch:
    """Tables written into the shared folder: they cut lineage, survive the loss of executors and carry their size for the planner.

    drop() removes a table no later step reads; what a returned plan still reads is removed when the application ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        path, fs = hadoop(spark, self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def write(self, df: DataFrame, files: int | None = None, small: bool = False, **told: Column) -> DataFrame:
        """Writes df and reads it back. files: that many output files, for tables known to be small; what made their rows stays parallel.

        As it is written its rows are counted, and the aggregates told, which the result's attribute told then holds by name; small: its bytes too, for small_side().
        Counts are sums over tasks, and a task that ran twice counts twice."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        seen = Observation()
        told |= {"bytes": _bytes(df)} if small else {}
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in told.items()])
        (counted.repartition(files) if files else counted).write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path, out.told = path, seen.get
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for df in tables:
            if where := getattr(df, "_scratch_path", None):
                path, fs = hadoop(self.spark, where)
                fs.delete(path, True)


def hadoop(spark: SparkSession, where: str):
    """(path, file system) of a path, as the JVM sees them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _bytes(df: DataFrame) -> Column:
    """Bytes of rows as text, which is more than they take in memory but for headers."""
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0))


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether the measured rows and bytes of a written table are within the limits of a broadcast; bytes not told as it was written are measured now, if its rows are within theirs."""
    told = getattr(df, "told", {})
    n = told["rows"] if told else df.count()
    return n <= rows and (told["bytes"] if "bytes" in told else df.agg(_bytes(df)).first()[0]) <= most


def small_side(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if is_small(); beyond that the join is left to the planner, whose skew handling splits hot keys."""
    return F.broadcast(df) if is_small(df) else df


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for row-wise Python work over a table of few files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, for jobs started where it is neither installed nor in the working folder; once an application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    here = os.path.dirname(os.path.abspath(__file__))
    name = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="fieldloom-"), "fieldloom"), "zip", os.path.dirname(here), "fieldloom")
    atexit.register(shutil.rmtree, os.path.dirname(name), ignore_errors=True)
    spark.sparkContext.addPyFile(name)
