"""Session settings and the durable storage every multi-job operator relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that hold on a cluster as well as on one machine. Skewed join partitions are split at run
# time, small sides are broadcast only after their measured size is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.metricsEnabled": "false",
    # State of feeds lives on disk: what is remembered may outgrow memory, its bound is a feed's watermark.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A one-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kanaat")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local session without it."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="kanaat-")
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for tables one job writes and the next one reads."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so that a lost executor costs no recomputation."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether the table holds at most ``max_rows`` rows; never reads more than one row beyond."""
    return df.limit(max_rows + 1).count() <= max_rows


# Rows a derived table may have to be sent to every task.
SIDE_ROWS = 10_000


def small_side(df: DataFrame, most_rows: int = SIDE_ROWS) -> DataFrame:
    """A join side known to be small once it is computed: sent to every task if it has at most
    ``most_rows`` rows, so that the large side is neither shuffled nor gathered by its few keys. A
    larger one is joined by shuffle, where hot partitions are split at run time."""
    rows = df.limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
