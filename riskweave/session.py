"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "riskweave", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. On a cluster the submitter configures the session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, stream checkpoints and state.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, since its executors share the machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="riskweave-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    """Scratch of this application: others that share the root keep theirs."""
    return f"{scratch_root(spark)}/riskweave/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch area and return the table read back; ``codec`` replaces the session's one.

    The result no longer depends on executors that computed it, and its file sizes give the
    optimizer true statistics for the joins that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, builds: Sequence[Callable[[], DataFrame]]) -> list[DataFrame]:
    """Results of independent builds, whose jobs run side by side."""
    scratch_root(spark)  # set once, before the threads ask for it
    with ThreadPoolExecutor(len(builds)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(build)) for build in builds]
        return [f.result() for f in started]


def drop_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table that this application wrote under the scratch area."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
