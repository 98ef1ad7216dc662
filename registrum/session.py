"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"
METHOD_BYTES = 8000


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("registrum")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="registrum-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/registrum/{label}-{uuid.uuid4().hex}"


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """For writes of many computed columns. The JVM never compiles a method of more than 8000 bytes of code, and
    Spark makes one of a whole stage: such a stage is run operator by operator meanwhile, whose methods are short."""
    given = spark.conf.get(METHOD_KEY)
    spark.conf.set(METHOD_KEY, min(int(given), METHOD_BYTES))
    try:
        yield
    finally:
        spark.conf.set(METHOD_KEY, given)


def write_and_reread(df: DataFrame, label: str = "staged") -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder.

    Unlike a cached frame it outlives lost executors, and unlike ``checkpoint()``
    later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
