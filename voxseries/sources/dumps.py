"""Line readers for (compressed) dumps."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries.sources.zstd_source import ZstdLines


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per line in ``value``; only a newline ends a line, and a last line without one
    counts. Plain and splittable files are cut by ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.text(list(paths), lineSep="\n")


def scan_dump(spark: SparkSession, *paths: str, long_window: bool = False) -> DataFrame:
    """Lines of ``.zst`` dumps.

    Spark's codec reads windows up to 2^27 bytes. ``long_window`` streams files made with a
    larger one through the ``zstandard`` wheel: a data source with one input partition per file,
    which holds some megabytes of lines at a time. The driver sees the files' names. A zstd file cannot be split either way, so filter first and only then
    ``repartition`` what is left.
    """
    if not long_window:
        return read_lines(spark, *paths)
    # Spark lists the files, wherever they are; it needs no content for that: the column is pruned from the scan.
    files = spark.read.format("binaryFile").load(list(paths)).select("path")
    spark.dataSource.register(ZstdLines)
    names = json.dumps(sorted(row.path for row in files.collect()))
    raw = spark.read.format("zstd_lines").option("files", names).load()
    return raw.select(F.col("value").cast("string").alias("value"))
