"""Session helpers: a local test session and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Scratch folders of local sessions; removed when the process ends.
_LOCAL_DIRS: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seriesforge")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.TemporaryDirectory(prefix="seriesforge-", ignore_cleanup_errors=True)
    return _LOCAL_DIRS[app].name


def session_cache(spark: SparkSession) -> dict:
    """What jobs of this session keep for each other, such as fitted models.

    It hangs on the session: modules of the package travel to workers by value, so a module must
    not hold anything that can't be pickled.
    """
    return vars(spark).setdefault("_seriesforge_cache", {})


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there anything to read? Other failures (no permission, no file system) are raised."""
    try:
        spark.read.schema("_ int").parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path itself, for listings, renames and deletes."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate this package wrote itself and nobody reads any more."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(groups: DataFrame, label: str = "groups") -> DataFrame:
    """Materialise a one-row-per-group table before it is joined back to the rows it came from.

    As a written table its true size is known when the join is planned: a small one is
    broadcast and the rows stay where they are, a large one gets a shuffle join that adaptive
    execution can split at hot keys. An aggregate inside the plan would be guessed as large
    as its input and always shuffle the rows.
    """
    return materialize(groups, label)
