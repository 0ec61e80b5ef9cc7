"""Titles onto comments, and sentiment series onto polls.

Sides are not marked for broadcast unless they were measured. The planner broadcasts one whose
size it knows to be under ``spark.sql.autoBroadcastJoinThreshold``, at run time from measured
shuffle sizes; beyond that the joins are sort-merge and AQE splits a partition that one hot key
has swollen.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.dates import running_week_of
from voxseries.functions.text import strip
from voxseries.operators.clean import drop_blank


def is_small(df: DataFrame, rows: int = 200_000, chars: int = 16_000_000) -> bool:
    """Whether a table is proven small enough to broadcast, by rows and by text length.

    For tables that reach a join without statistics, such as a word list. The check reads no more
    than ``rows`` + 1 rows.
    """
    text = [F.length(c) for c, kind in df.dtypes if kind == "string"]
    found = df.limit(rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(sum(text, F.lit(0))), F.lit(0)).alias("chars")
    ).first()
    return found.rows <= rows and found.chars <= chars


def hot_keys(df: DataFrame, col: str, share: float = 0.01, tracked: int = 10_000) -> dict[str, float]:
    """Values of ``col`` that hold at least ``share`` of its rows each, with the share they hold.

    Counted by a sketch: one pass, one buffer of ``tracked`` values a task. A value with more than a ``tracked``-th of the rows
    cannot slip through it, so ``share`` must be above that; the driver sees at most ``1 / share`` values. Empty and null
    values do not count.
    """
    if share * tracked <= 1:
        raise ValueError("the sketch must track more values than can be hot")
    most = int(1 / share)
    found = drop_blank(df.select(col), col).agg(
        F.expr(f"approx_top_k(`{col}`, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("rows")
    ).first()
    if not found.rows:
        return {}
    return {r["item"]: r["count"] / found.rows for r in found.top if r["count"] >= share * found.rows}


def attach_titles(
    comments: DataFrame, submissions: DataFrame, dedupe: bool = False, salt: int = 1,
    hot: dict[str, float] | None = None,
) -> DataFrame:
    """Every comment with the title of its thread, ``""`` where there is none.

    Duplicate submission ids fan out unless ``dedupe``. ``hot`` holds threads with a large share of all comments
    (``hot_keys``): each is spread over as many join keys as its share of the shuffle partitions, and only its own submission
    is copied; all other threads keep one key. ``salt`` spreads every thread, hot or not, and copies all submissions.
    """
    return _titled(comments, submissions, dedupe, salt, hot).drop("_matched")


def flag_matches(
    comments: DataFrame, submissions: DataFrame, dedupe: bool = False,
    hot: dict[str, float] | None = None,
) -> DataFrame:
    """The same rows with a ``matched`` flag, for the audit."""
    return _titled(comments, submissions, dedupe, 1, hot).withColumn(
        "matched", F.coalesce("_matched", F.lit(False))
    ).drop("_matched")


def _spread(key, shares: dict[str, float], partitions: int):
    """Join keys of each thread: 1, or for a hot one as many as its share of the partitions, twice over so that they even out."""
    by_count: dict[int, list[str]] = {}
    for thread, share in shares.items():
        by_count.setdefault(max(2, round(2 * share * partitions)), []).append(thread)
    out = F.lit(1)
    for count, threads in by_count.items():
        out = F.when(key.isin(threads), count).otherwise(out)
    return out


def _titled(comments, submissions, dedupe, salt, hot):
    left = drop_blank(comments, "link_id_short")
    right = drop_blank(submissions, "id").select(
        F.col("id").alias("_thread"),
        F.coalesce(strip(F.col("title")), F.lit("")).alias("title"),
        F.lit(True).alias("_matched"),
    )
    if dedupe:
        right = right.groupBy("_thread").agg(
            F.min("title").alias("title"), F.lit(True).alias("_matched")
        )
    on = F.col("link_id_short") == F.col("_thread")
    if salt > 1 or hot:
        partitions = int(comments.sparkSession.conf.get("spark.sql.shuffle.partitions"))

        def keys(thread):
            return F.lit(salt) if salt > 1 else _spread(thread, hot, partitions)

        # Numbered by place in the task, so that rows alike in all columns spread too. Any key meets a copy of the title.
        place = F.monotonically_increasing_id()
        left = left.withColumn("_salt", F.pmod(F.xxhash64(place), keys(F.col("link_id_short"))).cast("int"))
        right = right.withColumn("_copy", F.explode(F.sequence(F.lit(0), keys(F.col("_thread")) - 1)))
        on = on & (F.col("_salt") == F.col("_copy"))
    joined = left.join(right, on, "left")
    title = F.coalesce("title", F.lit("")).alias("title")
    return joined.select(*[c for c in comments.columns if c != "title"], title, "_matched")


def join_polls(series: DataFrame, polls: DataFrame, key: str) -> DataFrame:
    """Series rows that have a poll at the same ``key`` (week label or date)."""
    return series.join(_other_columns(series, polls, key), key, "inner")


def _other_columns(series, polls, key):
    clash = [c for c in polls.columns if c in series.columns and c != key]
    return polls.drop(*clash)


def polls_long(polls: DataFrame, keys, mapping=K.POLL_COLUMNS) -> DataFrame:
    """Wide polls to one row per group: keys, ``party``, ``poll``."""
    wide = polls.select(*keys, *[F.col(c).alias(party) for party, c in mapping.items()])
    return wide.unpivot(keys, list(mapping), "party", "poll")


def lagged_pairs(series: DataFrame, polls_by_party: DataFrame, key: str, lags) -> DataFrame:
    """Sentiment at ``t`` beside the poll at ``t - lag``, for all lags in one join.

    ``polls_by_party`` is in long form. Each poll row is copied once per lag onto the key it
    meets; dates move by days, week labels by whole numbers without a year wrap.
    """
    lag = F.explode(F.array(*[F.lit(int(k)) for k in lags])).alias("lag")
    spread = polls_by_party.select("party", F.col(key).alias("_key"), "poll", lag)
    is_date = dict(series.dtypes)[key] == "date"
    moved = F.date_add("_key", F.col("lag")) if is_date else F.col("_key") + F.col("lag")
    spread = spread.select("party", moved.alias(key), "poll", "lag")
    return series.join(spread, ["party", key], "inner")


def lagged_pairs_years(series: DataFrame, polls_by_party: DataFrame, lags) -> DataFrame:
    """Weekly pairs of series that span years: sentiment of one week beside the poll ``lag`` weeks before it, also across a
    new year. Both sides carry ``iso_year`` and ``week``; a running week number joins them."""
    run = running_week_of(F.col("iso_year"), F.col("week")).alias("_run")
    polls = polls_by_party.select("party", run, "poll")
    return lagged_pairs(series.select("*", run), polls, "_run", lags).drop("_run")


def left_series(series: DataFrame, polls_by_party: DataFrame, key: str) -> DataFrame:
    """Every row of the series with its own group's poll, null where no poll was taken."""
    return series.join(polls_by_party.select("party", key, "poll"), ["party", key], "left")
