"""Session settings the library relies on.

Everything here is a runtime SQL setting, so a session handed over by a cluster can be
adjusted in place; memory, cores and the checkpoint folder stay the cluster's business.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Naive timestamps are UTC wall-clock times.
    "spark.sql.session.timeZone": "UTC",
    # Bad dates, overflows and divisions by zero raise instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    # Run-time re-planning: coalesce small shuffles, split skewed ones, and broadcast a join
    # side only when its measured size is below the threshold (sort-merge otherwise).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A hash table takes about four times its rows, and every broadcast passes through the driver.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    # Sizes of Parquet are taken as rows in memory, or a well compressed table would be broadcast by its file.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Staging, facts and scratch tables are written more often than they are read.
    "spark.sql.parquet.compression.codec": "zstd",
    # A job's shuffle files go when it has ended. Otherwise they stay until the driver happens to collect its
    # garbage, and a run of many steps holds the shuffles of all of them on its disks.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# A split of compressed Parquet that a task can sort in memory. It replaces Spark's default only; a
# cluster that has set its own stays with it.
SPLIT_DEFAULT, SPLIT_BYTES = "134217728b", "16m"


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    if spark.conf.get("spark.sql.files.maxPartitionBytes") == SPLIT_DEFAULT:
        spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    return spark


_WORK: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables of this session.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session may go without; it gets a temporary folder.
    """
    session_id = spark.sparkContext.applicationId
    if session_id not in _WORK:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors can reach")
        base = shared or tempfile.mkdtemp(prefix="merchlake-")
        _WORK[session_id] = f"{base.rstrip('/')}/merchlake-{session_id}"
        if isinstance(spark, SparkSession):
            atexit.register(_clear, spark, _WORK[session_id], None if shared else base)
    return _WORK[session_id]


def _clear(spark: SparkSession, folder: str, own: str | None) -> None:
    """Removes the work folder when the program ends. A session stopped before leaves a shared one."""
    if own is not None:
        shutil.rmtree(own, ignore_errors=True)
    elif spark.sparkContext._jsc is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_session(cores: str = "8", app: str = "merchlake") -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        # Call sites of every column expression are a debugging aid that costs round trips.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", "/tmp/merchlake-spark-warehouse")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
