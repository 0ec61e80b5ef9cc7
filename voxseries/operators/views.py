"""Read models: what a chart or a table of the series needs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.dates import week_axis_date, within_series
from voxseries.functions.numbers import clamp_abs
from voxseries.functions.text import compact_number, week_label
from voxseries.operators.joins import left_series


def for_group(df: DataFrame, party: str) -> DataFrame:
    return df.filter(F.col("party") == party)


def clip(df: DataFrame, col: str, last) -> DataFrame:
    """Rows up to and including ``last``."""
    limit = F.lit(last)
    return df.filter(F.col(col) <= (limit.cast("date") if dict(df.dtypes)[col] == "date" else limit))


def select_existing(df: DataFrame, cols) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def weekly_view(
    weekly: DataFrame, polls_by_party: DataFrame, last: int | None = K.LAST_WEEK,
    first_day: str = K.WEEK_ONE,
) -> DataFrame:
    """Chart rows of every group's weekly series: axis date, label, measures, poll, volume.

    ``last=None`` keeps all weeks.
    """
    rows = weekly if last is None else clip(weekly, "week", last)
    return _view(
        left_series(rows, polls_by_party, "week"),
        week_axis_date(F.col("week"), first_day), week_label(F.col("week")),
    )


def daily_view(
    daily: DataFrame, polls_by_party: DataFrame, last: str | None = K.EVENT_DAY
) -> DataFrame:
    """Chart rows of every group's daily series; ``last=None`` keeps all days."""
    rows = daily if last is None else clip(daily, "date", last)
    return _view(left_series(rows, polls_by_party, "date"), F.col("date"), F.col("date").cast("string"))


def _view(rows, axis, label):
    return rows.select(
        "party", axis.alias("x_axis"), label.alias("label"),
        *[m for m in K.MEASURES if m in rows.columns],
        F.col("poll"), F.col("comment_volume").alias("volume"),
    )


def event_marker(view: DataFrame, day: str = K.EVENT_DAY) -> DataFrame:
    """Per group, whether ``day`` lies inside its drawn series, give or take one day."""
    span = view.groupBy("party").agg(F.min("x_axis").alias("first"), F.max("x_axis").alias("last"))
    shown = within_series(F.lit(day).cast("date"), F.col("first"), F.col("last"))
    return span.select("party", "first", "last", shown.alias("shown"))


def cell_strength(table: DataFrame, col: str) -> DataFrame:
    """Correlation cells with their colour strength: absolute value, one at most."""
    return table.withColumn("strength", clamp_abs(F.col(col)))


def stat_cards(summary: DataFrame) -> DataFrame:
    """Summary figures as short texts; scanned and kept comments too, where the summary has them."""
    counted = [compact_number(F.col(c)).alias(c) for c in ("comments_scanned", "comments_kept") if c in summary.columns]
    return summary.select(
        *counted, compact_number(F.col("targeted_rows")).alias("targeted_rows"),
        F.concat(F.col("last_week").cast("string"), F.lit(" weeks")).alias("weeks"),
    )
