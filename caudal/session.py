"""Session creation and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_going: set[str] = set()
_made_up: dict[str, str] = {}
SHARED_FOLDER_KEY = "spark.checkpoint.dir"


def local_session(app_name: str = "caudal", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks. On a cluster the caller passes its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local temporary folder is made up only in local mode, where driver and
    executors are one process; on any other master an unset folder is an error.
    """
    folder = spark.conf.get(SHARED_FOLDER_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{SHARED_FOLDER_KEY} must name a folder all executors share")
    # kept here, as a running session does not take this setting
    app = spark.sparkContext.applicationId
    if app not in _made_up:
        _made_up[app] = tempfile.mkdtemp(prefix="caudal-")
    return _made_up[app]


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run writes to. The application's tables go when it ends."""
    folder = f"{shared_folder(spark)}/caudal-{spark.sparkContext.applicationId}"
    if folder not in _going:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
        _going.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, however often it is used, and safe from lost executors."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
