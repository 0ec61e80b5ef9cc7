"""Poll tables at the grain of a series."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.dates import iso_week


def poll_daily(polls: DataFrame, freq: str = "daily") -> DataFrame:
    return polls.filter(F.col("freq") == freq)


def poll_weekly(polls: DataFrame, values=K.POLL_VALUES, week_source: str = "label") -> DataFrame:
    """Mean of each value over all polls of a week, of either granularity; nulls are skipped.

    The week is the table's own label. ``week_source="iso"`` derives it from the date instead,
    which gives other weeks wherever the labels disagree.
    """
    if week_source == "iso":
        polls = polls.withColumn("week", iso_week(F.col("date")).cast("int"))
    return polls.filter(F.col("week").isNotNull()).groupBy("week").agg(
        *[F.avg(v).alias(v) for v in values]
    )
