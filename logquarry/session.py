"""Session settings and scratch folders for intermediate tables."""

import atexit
import functools
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str, cpus: str | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="logquarry-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="logquarry-scratch-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or what the session was given since."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Through Spark's own file system, so any store works."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """A folder of its own below the scratch root for the intermediate tables of one run.

    As a context it removes the folder when the run ends, also after an error. Later steps of the run
    start from stored files that outlive any executor, with pruning and without recomputation.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` once as Parquet and read it back."""
        path = self.path(name)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        delete(self.spark, self.folder)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *error) -> None:
        self.remove()


@functools.cache
def _area_of(application_id: str) -> Scratch:
    spark = SparkSession.active()
    area = Scratch(spark)

    def remove() -> None:
        if spark.sparkContext._jsc is not None and SparkSession.getActiveSession() is not None:
            area.remove()

    atexit.register(remove)
    return area


def session_area(spark: SparkSession) -> Scratch:
    """A scratch folder for lazily returned results; removed when the program ends with its session alive."""
    return _area_of(spark.sparkContext.applicationId)


@functools.cache
def _ship(application_id: str) -> None:
    package = Path(__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='logquarry-package-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(archive)


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a session: their Python need not have it installed."""
    _ship(spark.sparkContext.applicationId)


def use_scratch(spark: SparkSession) -> None:
    """Give a plain local session without ``spark.checkpoint.dir`` a temporary scratch root."""
    sc = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()) and sc.master.split("[")[0] == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="logquarry-scratch-"))


def stored_in_place(df: DataFrame) -> DataFrame:
    """``df`` computed once into the checkpoint folder, partitions and their order kept as they are."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def gathered(df: DataFrame) -> DataFrame:
    """A result of a known few rows, such as a report's one row, computed now and kept with the plan."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
