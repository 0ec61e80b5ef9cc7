"""Scored rows to daily and weekly series."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.numbers import ratio

_CLASSES = {"pos": K.POSITIVE, "neg": K.NEGATIVE, "neu": K.NEUTRAL}


def class_indicators(df: DataFrame, col: str = "trans_sentiment", mapping=None) -> DataFrame:
    """``is_pos``, ``is_neg``, ``is_neu`` as 0 or 1; a null class is 0 in all of them."""
    mapping = mapping or _CLASSES
    return df.withColumns({
        f"is_{name}": F.when(F.col(col) == code, 1).otherwise(0) for name, code in mapping.items()
    })


def add_ratios(df: DataFrame, names=tuple(_CLASSES)) -> DataFrame:
    """``total`` of the class counts and each one's share of it, null where it is zero."""
    total = sum((F.col(f"{n}_count") for n in names[1:]), F.col(f"{names[0]}_count"))
    df = df.withColumn("total", total)
    return df.withColumns({
        f"trans_{n}_ratio": ratio(F.col(f"{n}_count"), F.col("total")) for n in names
    })


def _partial(scored: DataFrame, keys, copies: str | None) -> DataFrame:
    """Sums that can be added up again at a coarser grain."""
    rows = class_indicators(scored.filter(F.col("party").isNotNull()))
    n = F.col(copies) if copies else F.lit(1).cast("bigint")
    score = F.col("vader_score")
    return rows.groupBy(*keys).agg(
        F.sum(score * n).alias("score_sum"),
        F.coalesce(F.sum(F.when(score.isNotNull(), n)), F.lit(0)).alias("score_n"),
        *[F.sum(F.col(f"is_{name}") * n).alias(f"{name}_count") for name in _CLASSES],
        F.sum(n).alias("comment_volume"),
    )


def _finish(sums: DataFrame, keys) -> DataFrame:
    table = sums.select(
        *keys,
        F.try_divide("score_sum", "score_n").alias("vader_avg"),
        *[f"{n}_count" for n in _CLASSES],
        "comment_volume",
    )
    return add_ratios(table)


def rollup(scored: DataFrame, keys, copies: str | None = None) -> DataFrame:
    """Mean score, class counts, volume and class ratios per key; a row counts as often as its
    ``copies`` column says, once without one.

    One hash aggregation: each task sends one row per key it met, so a group that holds most of
    the rows costs no more than any other.
    """
    return _finish(_partial(scored, keys, copies), keys)


def rollup_both(scored: DataFrame, copies: str | None = None) -> DataFrame:
    """Weekly and daily series from one scan, told apart by ``grain``.

    The rows are summed once per (party, week, date); only that small table is expanded to the
    two grains.
    """
    base = _partial(scored, ["party", "week", "date"], copies)
    sums = ["score_sum", "score_n", *[f"{n}_count" for n in _CLASSES], "comment_volume"]
    party, week, date = F.col("party"), F.col("week"), F.col("date")
    both = base.groupingSets([[party, week], [party, date]], party, week, date).agg(
        F.grouping("date").alias("_no_date"), *[F.sum(c).alias(c) for c in sums]
    )
    grain = F.when(F.col("_no_date") == 1, "weekly").otherwise("daily").alias("grain")
    return _finish(both.select("*", grain), ["grain", "party", "week", "date"])


def in_order(series: DataFrame, key: str) -> DataFrame:
    """Total order by group and time, as the series are written."""
    return series.orderBy("party", key)
