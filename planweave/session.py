"""Session builder and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def session(app: str = "planweave", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the tests and the bench share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where the session names none, a local one on a local master and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
    made = tempfile.mkdtemp(prefix="planweave-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows that lie in the plan itself: no Python worker starts to read them, and Spark knows how few they are."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)
    return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow), kind)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and any executor can reread it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared one, by whichever file system it is on."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored() table that nothing reads any more."""
    root = shared_folder(df.sparkSession)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/")):
            remove(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nobody holds any more.

    Python's handles go first, then the JVM's; the files follow in the background, so each step gets a moment.
    """
    import gc
    import time

    for _ in range(2):
        gc.collect()
        time.sleep(0.2)
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
