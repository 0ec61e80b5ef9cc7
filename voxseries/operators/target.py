"""Text about each group: whole sentences that name it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.dates import epoch_date, iso_week
from voxseries.functions.text import full_text, keyword_pattern, sentences


def targeted(
    df: DataFrame,
    text_col: str,
    dictionary=K.GROUP_KEYWORDS,
    group_col: str = "party",
    out_col: str = "targeted_sentence",
) -> DataFrame:
    """One row per (row, group named in it), with the naming sentences joined by ``". "``.

    A sentence may serve several groups; a row that names none disappears. All work is inside
    the row, so nothing is shuffled. The whole text is searched once for any keyword before it
    is cut, which settles most rows.
    """
    anything = keyword_pattern([k for words in dictionary.values() for k in words])
    candidates = df.filter(F.lower(text_col).rlike(anything))
    hits = F.filter(sentences(F.col(text_col)), lambda s: s.rlike(anything))
    per_group = [
        F.struct(F.lit(group).alias(group_col), _named(F.col("_hits"), words).alias(out_col))
        for group, words in dictionary.items()
    ]
    found = F.filter(F.array(*per_group), lambda g: g[out_col] != "")
    return candidates.withColumn("_hits", hits).select(*df.columns, F.inline(found))


def _named(hits: Column, keywords) -> Column:
    pattern = keyword_pattern(keywords)
    return F.array_join(F.filter(hits, lambda s: s.rlike(pattern)), ". ")


def targeted_comments(
    joined: DataFrame, dictionary=K.GROUP_KEYWORDS, zone: str = "UTC"
) -> DataFrame:
    """Targeted rows of titled comments, dated in ``zone``.

    The thread title is part of every comment's text, so a group named in a title matches every
    comment under it.
    """
    text = joined.withColumn("full_text", full_text("title", "body"))
    rows = targeted(text, "full_text", dictionary)
    rows = rows.withColumn("date", epoch_date(F.col("created_utc"), zone))
    return rows.withColumn("week", iso_week(F.col("date")).cast("int"))
