"""Session settings, the shared folder, and written intermediate tables.

Everything that cuts lineage goes through :func:`materialise`, which writes
parquet under the folder named by ``spark.checkpoint.dir``.  All executors see
that folder, so the loss of an executor never loses an intermediate result.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_written: list[tuple[SparkSession, str]] = []


def build_session(app: str = "siltstone", cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless their PYTHONPATH already holds it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    if not os.path.isdir(package) or root in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="siltstone-code-"), "siltstone.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from the session's spark.checkpoint.dir.

    Where the setting is absent a temporary folder is set, but only for a
    local master: a machine-local folder is not visible to a cluster.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partitions, for operators that must name a count."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, removed when the driver ends."""
    ship(spark)
    path = f"{shared_dir(spark)}/siltstone/{label}-{uuid.uuid4().hex[:12]}"
    _written.append((spark, path))
    return path


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def short_shuffles(spark: SparkSession):
    """Within it a query's shuffle files go as soon as the query has ended.

    For writes only: each write has a plan of its own, so nothing reads its shuffles again.
    """
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def joined_by_part(spark: SparkSession):
    """Within it a plan may join on several columns where both sides lie by one of them; a bucketed side then stays in place."""
    return _set(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = workspace(spark, label)
    with short_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove written intermediate tables that nothing will read again."""
    for df in tables:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            remove(df.sparkSession, path)


class Versioned:
    """A small table that is replaced as a whole; the newest complete version counts, in any session.

    A version is written to a folder of another name and appears by one rename.
    The one before stays for readers that still have it.
    """

    def __init__(self, spark: SparkSession, label: str, root: str | None = None):
        self.spark, self.root = spark, root or workspace(spark, label)

    def versions(self) -> list[int]:
        fs, p = hadoop_path(self.spark, self.root)
        return sorted(int(n[1:]) for s in (fs.listStatus(p) if fs.exists(p) else []) if (n := s.getPath().getName())[0] == "v" and n[1:].isdigit())

    def read(self, schema: str | StructType) -> DataFrame:
        found = self.versions()
        return self.spark.read.schema(schema).parquet(f"{self.root}/v{found[-1]}") if found else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame) -> None:
        found = self.versions()
        to, held = f"{self.root}/v{found[-1] + 1 if found else 0}", f"{self.root}/_{uuid.uuid4().hex[:12]}"
        with short_shuffles(self.spark):
            rows.write.parquet(held)
        fs, old = hadoop_path(self.spark, held)
        _, new = hadoop_path(self.spark, to)
        if fs.exists(new) or not fs.rename(old, new):
            raise RuntimeError(f"another writer made {to} first")
        for v in found[:-1]:
            remove(self.spark, f"{self.root}/v{v}")


class Buckets:
    """A growing table in the shared folder, bucketed by one column and so never shuffled by it again.

    Each append adds a file to each bucket; joins on the column read bucket
    against bucket, and a condition on it reads the buckets it names.
    """

    def __init__(self, spark: SparkSession, label: str, column: str, buckets: int, path: str | None = None):
        self.spark, self.column, self.buckets = spark, column, buckets
        self.path = path or workspace(spark, label)
        self.name = f"siltstone_{label}_{uuid.uuid4().hex[:12]}"
        self.written = False

    def reopen(self, schema: StructType) -> None:
        """Take up a table that another session wrote to ``path``."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (`{self.column}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        self.written = True

    def append(self, rows: DataFrame) -> None:
        with short_shuffles(self.spark):
            rows.repartition(self.buckets, self.column).write.mode("append").bucketBy(self.buckets, self.column).option("path", self.path).saveAsTable(self.name)
        self.written = True

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(self.spark, self.path)


def hadoop_path(spark: SparkSession, path: str):
    """The (file system, path) pair of Hadoop's API for ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def release(spark: SparkSession) -> None:
    """Remove every intermediate table of this session; results that read them must be written before."""
    for held in [w for w in _written if w[0] is spark]:
        _written.remove(held)
        remove(spark, held[1])


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # the JVM may be gone already
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
