"""Helpers shared by the operators: table access, the word and case rules, and
column handling that is safe against clashing names."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Words are maximal runs without the six ASCII white-space characters.
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send a module's functions and classes to Python workers by value, so executors
    need no copy of this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store_texts(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a table in the shared checkpoint folder, as the library's helper
    does, but compressed with zstd: for the tables that hold whole texts or all units."""
    return store_at(df, scratch_path(df.sparkSession, name))


def store_at(df: DataFrame, path: str) -> DataFrame:
    """``store_texts`` at a path that its last reader hands to ``discard``."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table whose every reader has been written itself."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def words(text: Column) -> Column:
    """Array of the words of ``text`` (empty for an empty text)."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once per row.

    A lambda variable stands for the value, so an expensive array used several
    times inside ``body`` is not computed again for every use.
    """
    return F.transform(F.array(value), body)[0]
