"""Read models of a finished analysis, ready to publish."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.operators.audit import summary, summary_of
from voxseries.operators.joins import polls_long
from voxseries.operators.polls import poll_daily, poll_weekly
from voxseries.operators.rollup import rollup_both
from voxseries.operators.sample import head, sample_n
from voxseries.operators.views import daily_view, select_existing, stat_cards, weekly_view
from voxseries.plans.analysis import split_grains
from voxseries.sources.tables import staged

# Columns of the table of example rows.
_SAMPLE_COLUMNS = ["date", "party", "targeted_sentence", "trans_sentiment", "vader_score"]


def build_views(
    weekly: DataFrame, daily: DataFrame, polls: DataFrame, mapping=K.POLL_COLUMNS,
    last_week: int | None = K.LAST_WEEK, last_day: str | None = K.EVENT_DAY,
) -> dict[str, DataFrame]:
    """Chart and table rows for every group; a reader picks one with a filter on ``party``."""
    week_polls = polls_long(poll_weekly(polls, list(mapping.values())), ["week"], mapping)
    day_polls = polls_long(poll_daily(polls), ["date"], mapping)
    facts = summary(daily, weekly)
    return {
        "weekly": weekly_view(weekly, week_polls, last_week),
        "daily": daily_view(daily, day_polls, last_day),
        "weekly_polls": week_polls.filter(F.col("poll").isNotNull()),
        "daily_polls": day_polls.filter(F.col("poll").isNotNull()),
        "summary": facts,
        "cards": stat_cards(facts),
    }


def views_of_scored(
    scored: DataFrame, polls: DataFrame, copies: str | None = None, comments: DataFrame | None = None,
    submissions: DataFrame | None = None, **options,
) -> dict[str, DataFrame]:
    """The same from scored rows, scanned once: both grains are stored first. Counts of the first filter go into the summary."""
    both, polls = staged(rollup_both(scored, copies), "series"), staged(polls, "polls")
    weekly, daily = split_grains(both)
    views = build_views(weekly, daily, polls, **options)
    facts = summary_of(both, comments, submissions)
    return views | {"summary": facts, "cards": stat_cards(facts)}


def sample_rows(scored: DataFrame, key: str, n: int = 10, seed: int = 0) -> DataFrame:
    """``n`` example rows per group, in the columns a table shows."""
    return select_existing(sample_n(scored, n, key, seed, by="party"), _SAMPLE_COLUMNS)


def first_rows(series: DataFrame, key: str, n: int = 50) -> DataFrame:
    return head(series, ["party", key], n)
