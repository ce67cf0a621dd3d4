"""Shared working storage: where intermediate tables and files go on a cluster."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the setting is missing (tests on one machine) a temporary folder is used;
    on a cluster a missing setting is an error, since a local folder is not shared.
    """
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
        at = "file://" + tempfile.mkdtemp(prefix="graphloom-")
        atexit.register(shutil.rmtree, at.removeprefix("file://"), ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/graphloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deal(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt by keys to a fixed number of tasks.

    For steps that take much time a byte: the optimizer joins partitions by their bytes, so that
    one core would have them all, but leaves those of a given number. Where rows lie by a key already,
    the planner drops a deal by the same one; its hash is another.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)
