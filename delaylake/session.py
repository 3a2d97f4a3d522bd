"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; all can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later step could have used the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above; sizing (shuffle partitions, memory) stays with the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "8g", warehouse: str | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("delaylake")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        # Test tables are small: keep their partitions on several cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


SCRATCH_SETTING = "spark.delaylake.scratch.dir"  # runtime setting; before spark.checkpoint.dir, which is fixed at start

_made: list[str] = []  # scratch folders of this process
_databases: list[str] = []  # and the prefixes of scratch databases


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="delaylake-")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies in; nothing happens when it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def note_databases(prefix: str) -> None:
    """Databases whose names start so belong to a scratch lake."""
    _databases.append(prefix)


def release_scratch(spark: SparkSession) -> None:
    """Remove what this process has written as scratch: folders, and databases of scratch lakes.

    Frames that read from there cannot be used afterwards.
    """
    for row in spark.sql("SHOW DATABASES").collect():
        if _databases and row[0].startswith(tuple(_databases)):
            spark.sql(f"DROP DATABASE IF EXISTS `{row[0]}` CASCADE")
    for path in _made:
        remove_folder(spark, path)
    _databases.clear()
    _made.clear()


@contextmanager
def releasing(spark: SparkSession, *kept_purposes: str) -> Iterator[None]:
    """Folders made inside go when the block ends well, but for those of ``kept_purposes``.

    For steps that write several copies on the way to a small result; no frame left over may read from the others.
    """
    before = len(_made)
    yield
    for path in _made[before:]:
        if not path.rsplit("/", 1)[-1].rsplit("-", 1)[0] in kept_purposes:
            remove_folder(spark, path)
            _made.remove(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Executors on other machines have to see what is written here, so a local temporary folder is
    accepted only when the whole session runs on one machine.
    """
    root = spark.conf.get(SCRATCH_SETTING, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        root = _local_folder()
    path = f"{root.rstrip('/')}/delaylake/{purpose}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` computed once, from a Parquet copy in the shared folder.

    For results used more than once or joined as a small side: Spark then knows their size, and a lost
    executor costs no recomputation.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
