"""Session helpers shared by the jobs, the bench and the tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "riskloom") -> SparkSession:
    """A local session for tests and benches; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session on a single machine may leave it unset; it then gets a
    temporary folder. On a cluster every executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="riskloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage_folder(spark: SparkSession) -> str:
    """Folder of what this application stages."""
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{spark.sparkContext.applicationId}"


def clear_stages(spark: SparkSession) -> None:
    """Remove all tables this application staged; frames that read them end with it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(stage_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read on from there.

    Used before iterative work (fits, searches). A lost executor then costs a
    re-read instead of a rebuild of all upstream rollups and joins, and every
    pass reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
