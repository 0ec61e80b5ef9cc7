"""Readers of the small whitespace-delimited tables, and of a valence lexicon."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.numbers import clean_percent
from voxseries.functions.text import strip
from voxseries.sources.dumps import read_lines

POLL_HEADER = ["date", *K.POLL_VALUES, "freq", "week"]
PROBABILITY_HEADER = ["date", "lpc", "cpc"]


def split_fields(lines: DataFrame, header, strict: bool = False) -> DataFrame:
    """Whitespace-delimited text rows to string columns, by the names of the header row.

    The header row is the one that holds the first name; it is left out. Without one, columns are
    taken in the order of ``header``. A name that is missing raises with ``strict``, else its
    column is null. These files are small; one row of them comes to the driver.
    """
    rows = lines.select(F.split(strip(F.col("value")), r"\s+").alias("_fields"))
    is_header = F.array_contains("_fields", header[0])
    found = rows.filter(is_header).first()
    names = list(found["_fields"]) if found else list(header)
    missing = [name for name in header if name not in names]
    if missing and strict:
        raise ValueError(f"columns not in the header row: {missing}")
    table = rows.filter(~is_header & (F.get("_fields", F.lit(0)) != ""))
    return table.select(*[
        (F.lit(None).cast("string") if name in missing else F.get("_fields", F.lit(names.index(name)))).alias(name)
        for name in header
    ])


def _typed(name: str, strict: bool) -> Column:
    col = F.col(name)
    if name == "freq":
        return col
    if name == "date":
        return col.cast("date") if strict else col.try_cast("date")
    if name == "week":
        return col.cast("int") if strict else col.try_cast("int")
    return clean_percent(col, strict)


def parse_percent_table(lines: DataFrame, header=POLL_HEADER, strict: bool = False) -> DataFrame:
    """Dates, percents, granularity and week label from text rows. ``strict`` raises on a bad
    cell, the tolerant mode makes it null."""
    table = split_fields(lines, header, strict)
    return table.select(*[_typed(name, strict).alias(name) for name in header])


def read_polls(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return parse_percent_table(read_lines(spark, path), POLL_HEADER, strict)


def read_probability(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return parse_percent_table(read_lines(spark, path), PROBABILITY_HEADER, strict)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``word, valence`` file; further columns are ignored."""
    fields = F.split(F.col("value"), "\t")
    table = read_lines(spark, path).select(
        F.lower(strip(F.get(fields, F.lit(0)))).alias("word"),
        F.get(fields, F.lit(1)).try_cast("double").alias("valence"),
    )
    return table.filter((F.col("word") != "") & F.col("valence").isNotNull())
