"""Column layouts of the datasets that cross a stage boundary."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "date": T.DateType(),
}


def _struct(spec: str) -> T.StructType:
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_LINE = _struct("value string")

CLEAN_COMMENT = _struct(
    "id string, link_id_short string, parent_id string, subreddit string, author string,"
    " created_utc bigint, score bigint, body string, permalink string"
)
CLEAN_SUBMISSION = _struct("id string, subreddit string, title string")
JOINED_COMMENT = T.StructType(CLEAN_COMMENT.fields).add("title", "string")
TARGETED = (
    T.StructType(JOINED_COMMENT.fields)
    .add("full_text", "string").add("party", "string").add("targeted_sentence", "string")
    .add("date", "date").add("week", "integer")
)
SCORED = T.StructType(
    [f for f in TARGETED.fields if f.name != "full_text"]
).add("trans_sentiment", "integer").add("vader_score", "double")

_SERIES_METRICS = (
    "vader_avg double, pos_count bigint, neg_count bigint, neu_count bigint,"
    " comment_volume bigint, total bigint, trans_pos_ratio double, trans_neg_ratio double,"
    " trans_neu_ratio double"
)
WEEKLY_SERIES = _struct(f"party string, week int, {_SERIES_METRICS}")
DAILY_SERIES = _struct(f"party string, date date, {_SERIES_METRICS}")

POLLS = _struct(
    "date date, lpc double, cpc double, ndp double, oth double, freq string, week int"
)
PROBABILITY = _struct("date date, lpc double, cpc double")
LEXICON = _struct("word string, valence double")
