"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. A join whose hot key is found at run time is split even when
# that costs one more exchange; without the second flag the split is skipped below an aggregate.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",  # zone-less instants mean UTC, also where Spark truncates them
}

# Applied where the session has no value of its own. Shuffled rows of a few bytes are many times larger
# in a sort, so a quarter of Spark's size of a joined-up partition bounds the memory of a task.
UNLESS_SET = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

_OWN: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    for name, value in UNLESS_SET.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below `spark.checkpoint.dir`, which every executor can reach.

    It is deleted when the driver ends. Where the setting is missing, a session whose executors
    are threads of the driver gets a temporary folder; any other has to be given one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        configured = _OWN.get(app) or _OWN.setdefault(app, tempfile.mkdtemp(prefix="starloom-"))
    folder = f"{configured.rstrip('/')}/starloom-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return folder


def work_path(spark: SparkSession) -> str:
    """A name in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str | None = None, compression: str = "snappy") -> DataFrame:
    """Write `df` once to shared storage and read it back, so later steps start from files.

    Used where a result feeds several steps or where row-to-partition numbering must not change
    between them; losing an executor afterwards costs a re-read, not a recomputation.
    """
    target = path or work_path(df.sparkSession)
    df.write.mode("overwrite").parquet(target, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(target)
