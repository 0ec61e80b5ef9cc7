"""Registered queries of the whole analysis and its views."""

from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.operators import audit as A
from voxseries.operators import clean
from voxseries.operators import rollup as U
from voxseries.operators import views as V
from voxseries.plans import queries as Q
from voxseries.plans import standins as X
from voxseries.plans.analysis import analyse_scored, tall_tables
from voxseries.plans.views import views_of_scored
from voxseries.sources import publish as W

_LINES_COLUMNS = ("n", "slope", "intercept", "t", "p", "r2", "x_min", "x_max")
_STATS = {"pear": "pearson", "spear": "spearman", "n": "n"}


def _unpivoted(table: str, at: str, source: str, columns: dict[str, str]) -> str:
    """Rows of `tall_tables` from one SQL source: a name and an expression for each number."""
    arms = [f"SELECT '{table}' AS \"table\", party, {at} AS \"at\", '{name}' AS name, CAST({sql} AS DOUBLE) AS value FROM {source}"
            for name, sql in columns.items()]
    return " UNION ALL ".join(arms)


def _grain_sql(grain: str, side: str, lags, zero: str, p_sql: str) -> tuple[str, str]:
    """(common tables, rows of the seven tables of a grain)."""
    g = grain
    with_ = f"""{g}_stats AS (WITH {side}, {Q._stats_sql('pairs', 'party, lag', 3, K.MEASURES)} SELECT * FROM stats),
{g}_tall AS (SELECT party, measure, CASE WHEN n >= 5 THEN pearson END AS pearson, CASE WHEN n >= 5 THEN spearman END AS spearman, n
  FROM {g}_stats WHERE lag = 0),
{g}_lines AS ({p_sql})"""
    wide = {f"{m}_{short}": f"max({col}) FILTER (measure = '{m}')" for m in K.MEASURES for short, col in _STATS.items()}
    parts = [
        _unpivoted(f"{g}_corr", "CAST(lag AS VARCHAR)", f"{g}_stats GROUP BY party, lag", wide),
        _unpivoted(f"{g}_corr_by_model", "measure", f"{g}_tall", {c: c for c in ("pearson", "spearman", "n")}),
        _unpivoted(f"{g}_regression", "measure", f"{g}_lines", {c: c for c in _LINES_COLUMNS}),
        _unpivoted(f"{g}_fit", "concat(measure, '/', i)", f"{g}_lines, range(0, 100) AS r(i)", {
            "x": "x_min + i * ((x_max - x_min) / 99)", "fitted": "intercept + slope * (x_min + i * ((x_max - x_min) / 99))"}),
        _unpivoted(f"{g}_model_grid", "''", f"{g}_tall GROUP BY party",
                   {m: f"max(pearson) FILTER (measure = '{m}')" for m in K.MEASURES}),
    ] + [
        _unpivoted(f"{g}_lag_grid_{m}", "''", f"{g}_stats WHERE measure = '{m}' GROUP BY party",
                   {str(k): f"max(pearson) FILTER (lag = {k})" for k in lags})
        for m in K.MEASURES
    ]
    return with_, " UNION ALL ".join(parts)


def _lines_sql(ols: str) -> str:
    return Q.with_p_value(ols, "party, measure, n, slope, intercept, t, r2, x_min, x_max")


_WEEKLY_WITH, _WEEKLY_ROWS = _grain_sql("weekly", Q._WEEK_PAIRED, K.WEEKLY_LAGS, "range(0, 2)", _lines_sql(Q._WEEK_OLS))
_DAILY_WITH, _DAILY_ROWS = _grain_sql("daily", Q._DAY_PAIRED, K.DAILY_LAGS, "range(0, 6)", _lines_sql(Q._DAY_OLS))


def _tables(spark, sf_dir):
    return analyse_scored(X.scored_events(spark, sf_dir), X.event_polls(spark, sf_dir), mapping=X.POLL_COLUMNS)


@Q.query(f"""WITH {_WEEKLY_WITH}, {_DAILY_WITH}, found AS ({_WEEKLY_ROWS} UNION ALL {_DAILY_ROWS})
SELECT "table", party, "at", name, round(value, 5) AS value FROM found""")
def analysis_tables(spark, sf_dir):
    """K3: all fourteen result tables, from one scan of the scored rows."""
    return tall_tables(_tables(spark, sf_dir)).withColumn("value", F.round("value", 5))


_RAW_COUNTS = f"""
comment_audit AS (WITH {X.COMMENT_LINES}, {Q._PARSED}, {Q._FLAGGED}
  SELECT count(*) AS seen, count(*) FILTER (kept) AS kept FROM flagged),
submission_audit AS (WITH {X.SUBMISSION_LINES}, {Q._CLEAN_SUBMISSIONS}
  SELECT count(*) AS seen, count(*) FILTER (j IS NOT NULL AND lower({Q._text('subreddit')}) IN {Q._members(K.COMMUNITIES)}) AS kept
  FROM sub_parsed)"""
_FACTS = f"""WITH {X.SCORED}, {Q._DAILY}, {Q._WEEKLY}, {Q._SUMMARY}, {_RAW_COUNTS},
counted AS (SELECT facts.*, c.seen AS comments_scanned, c.kept AS comments_kept, s.seen AS submissions_scanned,
  s.kept AS submissions_kept FROM facts, comment_audit c, submission_audit s)"""


def _audits(spark, sf_dir):
    """Counts of the first filter over both kinds of lines."""
    comments = clean.flag_raw(X.comment_lines(spark, sf_dir))
    submissions = clean.flag_raw(X.submission_lines(spark, sf_dir), text_key=None)
    return A.audit(comments, A.raw_counts()), A.audit(submissions, A.raw_counts())


def _counted(spark, sf_dir):
    return A.summary_of(U.rollup_both(X.scored_events(spark, sf_dir)), *_audits(spark, sf_dir))


@Q.query(f"{_FACTS} SELECT * FROM counted")
def corpus_summary_counts(spark, sf_dir):
    """D5 with what was scanned and kept."""
    return _counted(spark, sf_dir)


@Q.query(f"""{_FACTS} SELECT comments_scanned AS "commentsScanned", comments_kept AS "commentsKeptAfterFilter",
  submissions_scanned AS "submissionsScanned", submissions_kept AS "submissionsKeptAfterFilter",
  targeted_rows AS "targetedSentences", CAST(first_date AS VARCHAR) AS first_date, CAST(last_date AS VARCHAR) AS last_date,
  daily_buckets AS "dailyBucketCount", first_week, last_week, '2025-04-27' AS "electionDay", 42 AS lpc, 'linear' AS "transformerModel"
FROM counted""")
def publish_meta(spark, sf_dir):
    """A10, meta: the description of the corpus, its lists and structs taken apart."""
    meta = W.publish_meta(A.summary_of(U.rollup_both(X.scored_events(spark, sf_dir))), *_audits(spark, sf_dir),
                          {"lpc": 42, "cpc": 38, "ndp": 17}, model="linear")
    return meta.select(
        "commentsScanned", "commentsKeptAfterFilter", "submissionsScanned", "submissionsKeptAfterFilter", "targetedSentences",
        F.col("dailyDateRange")[0].alias("first_date"), F.col("dailyDateRange")[1].alias("last_date"), "dailyBucketCount",
        F.col("weeklyWeekRange")[0].alias("first_week"), F.col("weeklyWeekRange")[1].alias("last_week"), "electionDay",
        F.col("finalResults.lpc").alias("lpc"), "transformerModel")


def _compact(column: str) -> str:
    return f"""CASE WHEN {column} >= 1000000 THEN concat(format('{{:.2f}}', {column} / 1e6), 'M')
  ELSE format('{{:,}}', {column}) END"""


@Q.query(f"""{_FACTS} SELECT {_compact('comments_scanned')} AS comments_scanned, {_compact('comments_kept')} AS comments_kept,
  {_compact('targeted_rows')} AS targeted_rows, concat(last_week, ' weeks') AS weeks FROM counted""")
def stat_cards_counts(spark, sf_dir):
    """The cards with scanned and kept comments."""
    return V.stat_cards(_counted(spark, sf_dir))


_VIEW_WIDE = "party, CAST(x_axis AS VARCHAR) AS at, label, vader_avg, trans_pos_ratio, poll, volume"
_VIEW_POLLS = """party, CAST({key} AS VARCHAR) AS at, CAST(NULL AS VARCHAR) AS label, CAST(NULL AS DOUBLE) AS vader_avg,
  CAST(NULL AS DOUBLE) AS trans_pos_ratio, round(poll, 6) AS poll, CAST(NULL AS BIGINT) AS volume"""


@Q.query(f"""SELECT 'weekly' AS view, {_VIEW_WIDE} FROM ({Q._view_sql(
    Q._WEEK_SIDE, "weekly", "week_polls", "week", "DATE '2024-01-01' + (week - 1) * 7", "concat('Week ', week)", "week <= 4")
    .replace("DATE '2024-01-01' + (week - 1) * 7", "CAST(DATE '2025-01-06' + (week - 1) * 7 AS DATE)")})
UNION ALL SELECT 'daily', {_VIEW_WIDE} FROM ({Q._view_sql(
    Q._DAY_SIDE, "daily", "day_polls", "date", "date", "CAST(date AS VARCHAR)", "date <= DATE '2024-01-25'")})
UNION ALL SELECT 'weekly_polls', {_VIEW_POLLS.format(key='week')} FROM (WITH {Q._WEEK_SIDE} SELECT * FROM week_polls) WHERE poll IS NOT NULL
UNION ALL SELECT 'daily_polls', {_VIEW_POLLS.format(key='date')} FROM (WITH {Q._DAY_SIDE} SELECT * FROM day_polls) WHERE poll IS NOT NULL
UNION ALL SELECT 'summary', NULL, concat(first_date, '/', last_date), concat_ws('/', first_week, last_week, daily_buckets), NULL, NULL, NULL,
  targeted_rows FROM (WITH {X.SCORED}, {Q._DAILY}, {Q._WEEKLY}, {Q._SUMMARY} SELECT * FROM facts)""")
def view_tables(spark, sf_dir):
    """K4: charts, polls and summary, from one scan of the scored rows, under each other."""
    views = views_of_scored(X.scored_events(spark, sf_dir), X.event_polls(spark, sf_dir), mapping=X.POLL_COLUMNS,
                            last_week=4, last_day="2024-01-25")
    layout = {"party": "string", "at": "string", "label": "string", "vader_avg": "double", "trans_pos_ratio": "double",
              "poll": "double", "volume": "bigint"}

    def rows(name, df, **given):
        have = given | {c: F.col(c) for c in layout if c in df.columns and c not in given}
        return df.select(F.lit(name).alias("view"), *[have.get(c, F.lit(None)).cast(t).alias(c) for c, t in layout.items()])

    facts = views["summary"]
    out = rows("weekly", views["weekly"], at=F.col("x_axis"))
    out = out.unionByName(rows("daily", views["daily"], at=F.col("x_axis")))
    out = out.unionByName(rows("weekly_polls", views["weekly_polls"], at=F.col("week")))
    out = out.unionByName(rows("daily_polls", views["daily_polls"], at=F.col("date")))
    out = out.unionByName(rows(
        "summary", facts, at=F.concat("first_date", F.lit("/"), "last_date"),
        label=F.concat_ws("/", "first_week", "last_week", "daily_buckets"), volume=F.col("targeted_rows")))
    return Q.r6(out)
