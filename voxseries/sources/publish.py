"""The series in the layout they are published in: camelCase names, rounded values."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K

# Published name and digits of each column.
_SERIES = {
    "vader_avg": ("vaderAvg", 4),
    "trans_pos_ratio": ("transPosRatio", 4),
    "trans_neg_ratio": ("transNegRatio", 4),
    "trans_neu_ratio": ("transNeuRatio", 4),
    "comment_volume": ("commentVolume", None),
}
_LAYOUTS = {
    "weekly": {"party": ("party", None), "week": ("week", None)} | _SERIES,
    "daily": {"party": ("party", None), "date": ("date", None)} | _SERIES,
    "poll_weekly": {"week": ("week", None)} | {v: (v, 2) for v in K.POLL_VALUES},
    "poll_daily": {"date": ("date", None)} | {v: (v, 2) for v in K.POLL_VALUES}
    | {"freq": ("freq", None), "week": ("week", None)},
    "probability": {"date": ("date", None), "lpc": ("lpc", None), "cpc": ("cpc", None)},
    "correlations": {
        "party": ("party", None), "lag": ("lag", None),
        "vader_avg_pear": ("vaderPearson", 4), "vader_avg_spear": ("vaderSpearman", 4),
        "vader_avg_n": ("vaderN", None),
        "trans_pos_ratio_pear": ("transPearson", 4),
        "trans_pos_ratio_spear": ("transSpearman", 4), "trans_pos_ratio_n": ("transN", None),
    },
}


def publish(df: DataFrame, kind: str) -> DataFrame:
    """Rename, round and order the columns of one published table; dates become ISO text."""
    types = dict(df.dtypes)

    def column(source, name, digits):
        col = F.col(source)
        if types[source] == "date":
            col = col.cast("string")
        return (col if digits is None else F.round(col, digits)).alias(name)

    return df.select(*[column(s, *rule) for s, rule in _LAYOUTS[kind].items()])


def publish_meta(
    summary: DataFrame, comments: DataFrame, submissions: DataFrame, final_results: dict,
    event_day: str = K.EVENT_DAY, model: str = "",
) -> DataFrame:
    """The one-row description of the corpus; ``comments`` and ``submissions`` are audit rows
    of the first filter."""
    def count(audit, name):
        return audit.select(name).scalar()

    return summary.select(
        count(comments, "seen").alias("commentsScanned"),
        count(comments, "kept").alias("commentsKeptAfterFilter"),
        count(submissions, "seen").alias("submissionsScanned"),
        count(submissions, "kept").alias("submissionsKeptAfterFilter"),
        F.col("targeted_rows").alias("targetedSentences"),
        F.array(F.col("first_date").cast("string"), F.col("last_date").cast("string")).alias("dailyDateRange"),
        F.col("daily_buckets").alias("dailyBucketCount"),
        F.array("first_week", "last_week").alias("weeklyWeekRange"),
        F.lit(event_day).alias("electionDay"),
        F.struct(*[F.lit(v).alias(k) for k, v in final_results.items()]).alias("finalResults"),
        F.lit(model).alias("transformerModel"),
    )
