"""From series and polls to correlations, regressions and tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.operators.correlate import corr_grid, corr_long, corr_wide
from voxseries.operators.joins import lagged_pairs, polls_long
from voxseries.operators.polls import poll_daily, poll_weekly
from voxseries.operators.regress import fit_line, ols
from voxseries.operators.rollup import rollup_both
from voxseries.sources.tables import staged


def split_grains(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weekly and daily series out of the two-grain rollup."""
    weekly = both.filter(F.col("grain") == "weekly").drop("grain", "date")
    daily = both.filter(F.col("grain") == "daily").drop("grain", "week")
    return weekly, daily


def analyse(
    weekly: DataFrame, daily: DataFrame, polls: DataFrame, mapping=K.POLL_COLUMNS,
    weekly_lags=K.WEEKLY_LAGS, daily_lags=K.DAILY_LAGS,
) -> dict[str, DataFrame]:
    """Every result table. Polls are in the wide layout with ``freq`` and ``week``; their week is the label they carry, not
    the ISO week of their date.

    Per grain, correlations of all lags and the regression lines are made once and stored; the tables are views of these.
    """
    week_polls = polls_long(poll_weekly(polls, list(mapping.values())), ["week"], mapping)
    day_polls = polls_long(poll_daily(polls), ["date"], mapping)
    out = {}
    for grain, series, by_party, key, lags in (
        ("weekly", weekly, week_polls, "week", weekly_lags),
        ("daily", daily, day_polls, "date", daily_lags),
    ):
        pairs = lagged_pairs(series, by_party, key, sorted({0, *lags}))
        stats = staged(corr_long(pairs, ["party", "lag"], min_n=3), f"{grain}-stats")
        lines = staged(ols(pairs.filter("lag = 0")), f"{grain}-lines")
        enough = F.col("n") >= 5
        tall = stats.filter("lag = 0").select(
            "party", "measure", *[F.when(enough, F.col(c)).alias(c) for c in ("pearson", "spearman")], "n")
        asked = stats.filter(F.col("lag").isin(list(lags)))
        out |= {
            f"{grain}_corr": corr_wide(asked),
            f"{grain}_corr_by_model": tall,
            f"{grain}_regression": lines,
            f"{grain}_fit": fit_line(lines),
            f"{grain}_model_grid": corr_grid(tall, "measure", "pearson", K.MEASURES),
        } | {
            f"{grain}_lag_grid_{m}": corr_grid(asked.filter(F.col("measure") == m), "lag", "pearson", lags)
            for m in K.MEASURES
        }
    return out


def analyse_scored(
    scored: DataFrame, polls: DataFrame, copies: str | None = None, **options
) -> dict[str, DataFrame]:
    """The same from scored rows, which are scanned once: both grains are stored, and all tables come from them."""
    both, polls = staged(rollup_both(scored, copies), "series"), staged(polls, "polls")
    weekly, daily = split_grains(both)
    return analyse(weekly, daily, polls, **options)


def tall_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Result tables under each other, a row for each number: ``table``, ``party``, ``at`` (lag, measure or point, where a
    table has them), ``name``, ``value``."""
    out = None
    for name, table in tables.items():
        keys = [c for c in ("lag", "measure", "point") if c in table.columns]
        values = [c for c in table.columns if c != "party" and c not in keys]
        at = F.concat_ws("/", *[F.col(c).cast("string") for c in keys]).alias("at")
        wide = table.select(F.lit(name).alias("table"), "party", at, *[F.col(f"`{v}`").cast("double").alias(v) for v in values])
        rows = wide.unpivot(["table", "party", "at"], values, "name", "value")
        out = rows if out is None else out.unionByName(rows)
    return out
