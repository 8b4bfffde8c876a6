"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Equi-joins leave hot keys to the adaptive planner; it may add a shuffle to split one.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(name: str = "lakemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Applies the settings that every operator relies on to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; a temporary one only for local sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="lakemill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/lakemill/{label}-{uuid.uuid4().hex}"


#: Removes the shuffle files of a statement as soon as it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a generated method above which Spark runs its operators one by one.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def _with(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def freed(spark: SparkSession) -> AbstractContextManager[None]:
    """For writes: each plans its own shuffles, which nothing reads once the rows are written.

    Without it they lie on the executors' disks until the driver happens to collect garbage.
    """
    return _with(spark, FREED, "true")


def compiled(spark: SparkSession) -> AbstractContextManager[None]:
    """For statements with rules on many columns, which Spark generates as one very long method.

    The JVM compiles no method of more than 8,000 bytes and would interpret it for every row.
    """
    return _with(spark, METHOD_LIMIT, "8000")


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Writes `df` to the shared folder and reads it back.

    Cuts the lineage on storage that outlives executors, fixes values that depend on how rows
    were partitioned, and gives the planner the real size of an intermediate result.
    """
    path = fresh_folder(df.sparkSession, label)
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the folder of a settled frame that nothing reads any more; other frames are left alone."""
    spark = df.sparkSession
    files = df.inputFiles()
    folder = files[0].rpartition("/")[0] if files else ""
    if "/lakemill/" in folder and folder.partition("/lakemill/")[0].endswith(scratch_root(spark).rpartition(":")[2]):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
