"""Table writes: staging loads, versioned tables and exports.

A versioned table gets a new folder ``v=<n>`` per write. Spark puts ``_SUCCESS`` there once all
tasks have committed; readers take the newest folder that has it. A write that dies leaves a
folder nobody reads, and the next write replaces it. One writer per table is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def load(df: DataFrame, path: str, if_exists: str = "replace") -> None:
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    df.write.mode(MODES[if_exists]).option("partitionOverwriteMode", "static").parquet(path)


def ensure(spark: SparkSession, path: str, schema: StructType) -> None:
    """Creates the table empty, with its types, when nothing is there."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for results of a known small number of rows."""
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").option("header", True).csv(path)


def _finished(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching ``pattern`` in which a Spark write has committed."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(s.getPath().getParent()) for s in files.globStatus(hadoop_path) or []]


def finished_numbers(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """Numbers ``n`` of the complete folders ``root/<prefix>=<n>``, ascending."""
    return sorted(int(p.rsplit("=", 1)[1]) for p in _finished(spark, f"{root}/{prefix}=*"))


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Parquet files that committed writes have left in a folder."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(s.getPath()) for s in files.globStatus(pattern) or [])


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file unless it is there; of several writers exactly one succeeds.

    The file system must create files exclusively, as HDFS and local ones do.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    if files.getScheme() == "file":
        # The local file system's own create looks first and writes later; this one is atomic.
        folder = files.resolvePath(target.getParent()).toUri().getPath()
        return bool(spark._jvm.java.io.File(folder, target.getName()).createNewFile())
    try:
        files.create(target, False).close()
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# The version in use and the one before it, for readers that planned earlier.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class VersionedTable:
    root: str

    def versions(self, spark: SparkSession) -> list[int]:
        return finished_numbers(spark, self.root, "v")

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.versions(spark))

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """Newest complete version; with ``schema`` a missing table reads as empty."""
        done = self.versions(spark)
        if done:
            reader = spark.read.schema(schema) if schema else spark.read
            return reader.parquet(f"{self.root}/v={done[-1]}")
        if schema is None:
            raise FileNotFoundError(f"No complete version under {self.root}")
        return spark.createDataFrame([], schema)

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Writes the next version.

        With partition columns the rows are first brought together by them: small partitions
        are merged, large ones cut, so that a task does not write a sliver of every partition.
        """
        done = self.versions(df.sparkSession)
        number = done[-1] + 1 if done else 1
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/v={number}")
        return number

    def take_back(self, spark: SparkSession, number: int) -> None:
        """Deletes a version that must not be read."""
        delete_folder(spark, f"{self.root}/v={number}")

    def drop_old(self, spark: SparkSession, keep: int = KEPT_VERSIONS) -> list[int]:
        """Deletes all but the newest ``keep`` complete versions."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        old = self.versions(spark)[:-keep]
        for number in old:
            delete_folder(spark, f"{self.root}/v={number}")
        return old
