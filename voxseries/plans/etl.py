"""From dumps to titled comments."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.dates import epoch_date
from voxseries.operators.audit import match_counts, observed, raw_counts
from voxseries.operators.clean import clean_comments, clean_submissions, flag_raw
from voxseries.operators.joins import attach_titles, flag_matches, hot_keys
from voxseries.sources.dumps import scan_dump
from voxseries.sources.tables import write_table


def titled_comments(
    comment_lines: DataFrame, submission_lines: DataFrame, values=K.COMMUNITIES,
    legacy_none: bool = False, dedupe: bool = False, hot: dict[str, float] | None = None,
) -> DataFrame:
    """Filter, clean and join in one plan: no files in between, each line parsed once. ``hot`` names threads known to hold
    large shares of the comments."""
    comments = clean_comments(comment_lines, values, legacy_none, trim=False)
    submissions = clean_submissions(submission_lines, values, legacy_none, trim=False)
    return attach_titles(comments, submissions, dedupe, hot=hot)


def run_etl(
    spark: SparkSession, comment_dumps, submission_dumps, out: str, values=K.COMMUNITIES,
    long_window: bool = False, legacy_none: bool = False, dedupe: bool = False,
    hot_share: float | None = 0.01, mode: str = "overwrite",
) -> tuple[DataFrame, dict]:
    """Dumps to Parquet under ``out``; returns the titled comments and the counts of each stage.

    Every stage is written once, and its counts are observed by the job that writes it. All
    months go through together, so a comment finds the submission of an earlier month. The
    result is laid out by month of the comment. Threads with ``hot_share`` of the comments or more are found in the stored
    comments and spread in the join; ``None`` leaves that to AQE. ``mode="errorifexists"`` refuses an existing target.
    """
    def cleaned(dumps, text_key, clean, name):
        """Both passes over one kind of dump, each counted on the way to the same write."""
        flagged, seen = observed(
            flag_raw(scan_dump(spark, *dumps, long_window=long_window), values, text_key),
            raw_counts(), f"{name}_raw",
        )
        lines, total = observed(
            flagged.filter("kept").select("value"), [F.count(F.lit(1)).alias("total")], f"{name}_lines"
        )
        rows, kept = observed(
            clean(lines, values, legacy_none), [F.count(F.lit(1)).alias("kept")], f"{name}_clean"
        )
        stored = write_table(rows, f"{out}/{name}", mode)
        return stored, {name: seen.get, f"{name}_clean": total.get | kept.get}

    comments, counts = cleaned(comment_dumps, "body", clean_comments, "comments")
    submissions, more = cleaned(submission_dumps, None, clean_submissions, "submissions")
    hot = hot_keys(comments, "link_id_short", hot_share) if hot_share else None
    rows, joined_seen = observed(flag_matches(comments, submissions, dedupe, hot), match_counts(), "join")
    month = F.date_format(epoch_date(F.col("created_utc")), "yyyy-MM")
    joined = write_table(
        rows.drop("matched").withColumn("month", month), f"{out}/joined", mode, by=["month"]
    )
    counts |= more | {"join": joined_seen.get}
    return joined.drop("month"), counts
