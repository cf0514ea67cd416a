"""Session settings and tables written between stages."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "chatnorm", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Recording the Python call site of every expression more than doubles plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's checkpoint folder, which all executors can reach.

    Only on a single machine that names none (tests) a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="chatnorm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/chatnorm/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage at durable files, and gives the planner the true size of the table: it
    broadcasts the table when that size is below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles it otherwise.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/table"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of a location."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)
