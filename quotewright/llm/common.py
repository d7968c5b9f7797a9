"""Small helpers of the operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quotewright.sources.storage import fresh_path


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until they clash with no column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, where lost executors don't matter."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(spark: SparkSession) -> None:
    """Let Python workers import this package: by PYTHONPATH if that has it (as executors
    inherit or are given it), else as a file that Spark hands to every executor."""
    home = Path(__file__).resolve().parents[2]
    if any(x and Path(x).resolve() == home for x in os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:  # Spark's file server on the driver reads it until the end
        _SHIPPED[application] = tempfile.TemporaryDirectory(prefix="quotewright-")
        archive = shutil.make_archive(f"{_SHIPPED[application].name}/quotewright", "zip", home, "quotewright")
        spark.sparkContext.addPyFile(archive)


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}
