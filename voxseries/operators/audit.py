"""Counts that tell what a stage did, and the summary of a corpus."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def raw_counts():
    """seen, kept and bad over flagged lines. Every line counts as seen, a last one without a
    newline included."""
    return [
        F.count(F.lit(1)).alias("seen"),
        F.count_if("kept").alias("kept"),
        F.count_if("bad").alias("bad"),
    ]


def clean_counts(lines: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: total lines and those that cleaning kept."""
    marks = lines.select(F.lit(1).alias("total"), F.lit(0).alias("kept")).unionByName(
        cleaned.select(F.lit(0).alias("total"), F.lit(1).alias("kept"))
    )
    return marks.agg(F.sum("total").alias("total"), F.sum("kept").alias("kept"))


def match_counts():
    """inputs, matched and unmatched over joined rows flagged ``matched``."""
    return [
        F.count(F.lit(1)).alias("inputs"),
        F.count_if("matched").alias("matched"),
        F.count_if(~F.col("matched")).alias("unmatched"),
    ]


def audit(flagged: DataFrame, counts) -> DataFrame:
    """The counts as a one-row table, in one pass."""
    return flagged.agg(*counts)


def observed(flagged: DataFrame, counts, name: str) -> tuple[DataFrame, Observation]:
    """The same rows with the counts attached: they are filled in by whatever job writes the
    rows, so the input is not read again for them."""
    seen = Observation(name)
    return flagged.observe(seen, *counts), seen


def summary(daily: DataFrame, weekly: DataFrame) -> DataFrame:
    """One row: targeted rows, first and last date, number of dates, first and last week."""
    days = daily.select("comment_volume", "date")
    weeks = weekly.select("week")
    return days.unionByName(weeks, allowMissingColumns=True).agg(
        F.sum("comment_volume").alias("targeted_rows"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("date").alias("daily_buckets"),
        F.min("week").alias("first_week"), F.max("week").alias("last_week"),
    )


def summary_of(both: DataFrame, comments: DataFrame | None = None, submissions: DataFrame | None = None) -> DataFrame:
    """The same from the two-grain rollup, in one pass over it. With the one-row counts of the first filter also what was
    scanned and kept of comments and submissions."""
    daily = F.col("grain") == "daily"
    facts = both.agg(
        F.sum(F.when(daily, F.col("comment_volume"))).alias("targeted_rows"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("date").alias("daily_buckets"),
        F.min("week").alias("first_week"), F.max("week").alias("last_week"),
    )
    counts = []
    for name, audited in (("comments", comments), ("submissions", submissions)):
        if audited is not None:
            counts += [audited.select(n).scalar().alias(f"{name}_{m}") for n, m in (("seen", "scanned"), ("kept", "kept"))]
    return facts.select("*", *counts)


def extent(series: DataFrame, key: str) -> DataFrame:
    """First and last ``key`` and number of rows of each group's series."""
    return series.groupBy("party").agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("points")
    )
