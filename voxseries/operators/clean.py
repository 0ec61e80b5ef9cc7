"""Cleaning of raw JSON records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.numbers import json_text, to_epoch, to_score
from voxseries.functions.text import in_set, is_placeholder, strip, strip_prefix


_SPACES = " \t\r\n"
_OPTIONS = {"columnNameOfCorruptRecord": "_broken", "allowSingleQuotes": "false"}


def _read(lines: DataFrame, keys) -> DataFrame:
    """Each line beside the wanted keys as text, and ``_broken`` where it is not sound JSON.

    The fields leave through a generator: predicates on them then stay above it, so that each
    line is read once however many filters follow.
    """
    layout = ", ".join(f"{k} string" for k in [*keys, "_broken"])
    return lines.select("value", F.inline(F.array(F.from_json("value", layout, _OPTIONS))))


def _sound():
    """A line that holds one JSON object and nothing else.

    The reader stops at the end of the first value of a line, so the line's outer marks are checked too. Where an object ends
    and another begins before the end of the line, the line is read once more inside an array with an end mark, which counts
    its values.
    """
    text = F.btrim("value", F.lit(_SPACES))
    braced = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    values = F.json_array_length(F.concat(F.lit("["), "value", F.lit(', "end"]')))
    after = F.substr("value", F.locate("}", F.col("value")))
    alone = F.when(F.contains(after, F.lit("{")), F.coalesce(values == 2, F.lit(False))).otherwise(True)
    return braced & F.col("_broken").isNull() & F.is_valid_utf8("value") & alone


def _typed(key: str):
    """One value with its JSON type, from a parse of the whole record: for odd rows only."""
    return F.try_variant_get(F.try_parse_json("value"), f"$.{key}", "variant")


def _candidates(lines: DataFrame, values, legacy_none: bool) -> DataFrame:
    """Lines whose community may be wanted, by a read of that one field: nearly every line of
    a dump ends here."""
    if legacy_none and "none" in values:
        return lines
    return _read(lines, ["subreddit"]).filter(in_set(F.col("subreddit"), values)).select("value")


def require_keys(lines: DataFrame, keys) -> DataFrame:
    """``value`` and the keys as text, for records that are objects and carry every key.

    A JSON null counts as carried. The names of a record's keys are only listed where a value
    is null.
    """
    table = _read(lines, keys)
    missing = F.array_except(F.array(*map(F.lit, keys)), F.json_object_keys("value"))
    some_null = F.lit(False)
    for key in keys:
        some_null = some_null | F.col(key).isNull()
    carried = F.when(some_null, F.size(missing) == 0).otherwise(True)
    return table.filter(_sound() & carried).select("value", *keys)


def flag_raw(lines: DataFrame, values=K.COMMUNITIES, text_key: str | None = "body") -> DataFrame:
    """First pass over a dump: each original line with ``kept`` and ``bad`` flags.

    Membership is case-insensitive but not trimmed here. A JSON null counts as a text of its
    own, a missing key as empty. ``text_key=None`` skips the test for removed text, as for
    submissions.
    """
    table = _read(lines, ["subreddit"] + ([text_key] if text_key else []))
    said = F.lit(True)
    if text_key:
        # Only a parse of the whole record tells a null from a missing key.
        text = F.col(text_key)
        said = F.when(text.isNotNull(), ~is_placeholder(text)).otherwise(_typed(text_key).isNotNull())
    # The cheap test comes first; the others then run on few lines unless ``bad`` is asked for.
    kept = F.when(in_set(F.col("subreddit"), values, trim=False), _sound() & said)
    return table.select(
        "value", F.coalesce(kept, F.lit(False)).alias("kept"), (~_sound()).alias("bad")
    )


def filter_raw(lines: DataFrame, values=K.COMMUNITIES, text_key: str | None = "body") -> DataFrame:
    """Original text of the kept lines."""
    return flag_raw(lines, values, text_key).filter("kept").select("value")


def clean_comments(
    lines: DataFrame, values=K.COMMUNITIES, legacy_none: bool = False, trim: bool = True
) -> DataFrame:
    """Typed comments from raw lines.

    With ``legacy_none`` a JSON null in a text field becomes the text ``None`` and the row
    stays; by default it stays null, and a null body drops the row. ``trim=False`` takes the
    community untrimmed, as the first filter does: it then stands for both passes in one.
    """
    if not trim:
        lines = _candidates(lines, values, legacy_none)
    stripped = ["link_id", "author", "body", "permalink"]
    epoch = to_epoch(F.col("created_utc"), _typed("created_utc")).alias("_epoch")
    table = _texts(
        require_keys(lines, K.COMMENT_KEYS), ["id", "parent_id", "subreddit"], stripped,
        legacy_none, keep=["value", "score"], also=[epoch],
    )
    wanted = in_set(F.col("subreddit"), values, trim) & ~is_placeholder(F.col("body"))
    return table.filter(wanted & F.col("_epoch").isNotNull()).select(
        "id",
        strip_prefix(F.col("link_id"), K.THREAD_PREFIX).alias("link_id_short"),
        "parent_id",
        F.lower(strip(F.col("subreddit"))).alias("subreddit"),
        "author",
        F.col("_epoch").alias("created_utc"),
        to_score(F.col("score"), _typed("score")).alias("score"),
        "body",
        "permalink",
    )


def clean_submissions(
    lines: DataFrame, values=K.COMMUNITIES, legacy_none: bool = False, trim: bool = True
) -> DataFrame:
    """Typed submissions from raw lines. Titles are not tested for placeholders."""
    if not trim:
        lines = _candidates(lines, values, legacy_none)
    table = _texts(
        require_keys(lines, K.SUBMISSION_KEYS), ["id", "subreddit"], ["title"], legacy_none
    )
    return table.filter(in_set(F.col("subreddit"), values, trim)).select(
        "id", F.lower(strip(F.col("subreddit"))).alias("subreddit"), "title"
    )


def _texts(raw: DataFrame, plain, stripped, legacy_none: bool, keep=(), also=()) -> DataFrame:
    """Text columns of required records, again through a generator, so that the filters that
    follow do not repeat their making."""
    def text(key):
        return json_text(F.col(key), _typed(key), legacy_none)

    made = [text(k).alias(k) for k in plain] + [strip(text(k)).alias(k) for k in stripped]
    return raw.select(*keep, F.inline(F.array(F.struct(*made, *also))))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose join key is neither null nor empty."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def drop_placeholders(df: DataFrame, col: str, tokens=K.PLACEHOLDERS) -> DataFrame:
    return df.filter(~is_placeholder(F.col(col), tokens))
