"""The inputs of the chain, derived from the given tables, in Spark and as SQL text.

Nothing here is cut down: every row of the source table becomes a row of the stand-in.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.sources.tables import spread_scan

# Stand-in parameters for the registered queries.
POLL_COLUMNS = {"purchase": "lpc", "view": "cpc", "click": "ndp"}
LANGUAGE_KEYWORDS = {
    "english": ["the", "of"], "german": ["und", "der"], "romance": ["que", "de"],
}
LEXICON = {
    "that": 1.9, "and": -0.7, "is": 2.2, "was": -1.5, "no": -1.2, "die": -0.9, "und": 1.1,
    "mit": 2.4, "la": 1.6, "que": -2.1, "les": 1.4, "et": -1.8, "est": 2.6, "los": 0.6,
}
BOOSTERS = {"the": 0.293, "der": 0.293, "de": -0.293, "of": -0.293, "of the": 0.293}
NEGATORS = ["to", "zu", "le", "el"]
IDIOMS = {"it is": 1.5, "that is": -1.0, "des les": 0.4}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The same, spread over all cores ahead of costly work on each row."""
    return spread_scan(table(spark, sf_dir, name).select(*columns))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows: the event type is the group, which some rows lack."""
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(k != 97, F.col("event_type")).alias("party"), F.col("ts").cast("date").alias("date"),
        F.weekofyear("ts").alias("week"),
        ((k - 50) / F.lit(53.0)).alias("vader_score"),
        F.when(value < 20, 0).when(value < 60, 1).when(value < 300, 2).alias("trans_sentiment"),
    )


SCORED = """
scored AS (
  SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) <> 97 THEN event_type END AS party,
    CAST(ts AS DATE) AS date, CAST(week(ts) AS INTEGER) AS week,
    (CAST(json_extract_string(props, '$.k') AS INTEGER) - 50) / CAST(53 AS DOUBLE) AS vader_score,
    CASE WHEN value < 20 THEN 0 WHEN value < 60 THEN 1 WHEN value < 300 THEN 2 END AS trans_sentiment
  FROM events)"""


def event_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide poll table with one row per day; its week label is not the ISO week."""
    user = F.col("user_id")
    day = F.col("ts").cast("date").alias("date")
    columns = POLL_COLUMNS | {"signup": "oth"}
    values = [F.avg(F.when(F.col("event_type") == t, user)).alias(c) for t, c in columns.items()]
    daily = table(spark, sf_dir, "events").groupBy(day).agg(*values)
    freq = F.when(F.dayofweek("date") == 2, "weekly").otherwise("daily")
    label = F.floor((F.dayofyear("date") + 1) / 7).cast("int") + 1
    return daily.select("date", "lpc", "cpc", "ndp", "oth", freq.alias("freq"), label.alias("week"))


POLLS = """
polls AS (
  SELECT *, CASE WHEN dayofweek(date) = 1 THEN 'weekly' ELSE 'daily' END AS freq,
    CAST(floor((dayofyear(date) + 1) / 7.0) AS INTEGER) + 1 AS week
  FROM (
    SELECT CAST(ts AS DATE) AS date,
      avg(CASE WHEN event_type = 'purchase' THEN user_id END) AS lpc,
      avg(CASE WHEN event_type = 'view' THEN user_id END) AS cpc,
      avg(CASE WHEN event_type = 'click' THEN user_id END) AS ndp,
      avg(CASE WHEN event_type = 'signup' THEN user_id END) AS oth
    FROM events GROUP BY 1))"""

# Pieces of a comment line; shared, because both engines must build the same text.
_COMMUNITY = """
  CASE event_type WHEN 'purchase' THEN ' Canada ' WHEN 'view' THEN 'NDP' WHEN 'click' THEN 'cpc'
    WHEN 'signup' THEN 'CanadaPolitics' ELSE 'gardening' END"""
_CREATED = """
  CASE k WHEN 3 THEN '"x"' WHEN 4 THEN concat('"', secs, '.0"') WHEN 5 THEN 'null'
    ELSE concat(secs, '.5') END"""
_SCORE = """
  CASE k WHEN 6 THEN '"5"' WHEN 7 THEN '"5.7"' WHEN 8 THEN 'null' WHEN 9 THEN 'true'
    ELSE CAST(value AS {text}) END"""
_BODY = """
  CASE WHEN k = 10 THEN 'null' WHEN value < 5 THEN '" [deleted] "' WHEN value < 6 THEN '"  "'
    ELSE concat('" Seen by u', user_id, '. ',
      CASE WHEN k < 30 THEN 'Carney speaks' WHEN k < 55 THEN 'so the right-wing pp lost'
        WHEN k < 80 THEN 'NDP and liberals' ELSE 'nothing here' END,
      '! ok? "') END"""
_COMMENT_LINE = """
  CASE k WHEN 0 THEN '{{bad' WHEN 1 THEN '[1]' ELSE concat(
    '{{"id": "c', event_id, '", "link_id": "', CASE WHEN k < 20 THEN '' ELSE 't3_' END, user_id,
    '", "parent_id": "t1_', k, '", "subreddit": "', community, '", "author": " u', user_id,
    ' ", "created_utc": ', created, ', "score": ', score, ', "body": ', body,
    CASE WHEN k = 2 THEN '' ELSE concat(', "permalink": "/r/', event_id, ' "') END,
    ', "extra": {{"n": [', k, ']}}}}') END"""


# Some lines hold two records, which is one too many.
_MAYBE_TWICE = "rtrim(repeat(concat({line}, ' '), CASE WHEN k = 91 THEN 2 ELSE 1 END))"


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw JSON line per event, malformed and incomplete ones among them."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    events = texts(
        spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "ts", "props"
    ).select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.timestamp_diff("SECOND", start, F.col("ts")).alias("secs"),
    )
    parts = events.select(
        "event_id", "user_id", "k",
        F.expr(_COMMUNITY).alias("community"), F.expr(_CREATED).alias("created"),
        F.expr(_SCORE.format(text="STRING")).alias("score"), F.expr(_BODY).alias("body"),
    )
    return parts.select(F.expr(_MAYBE_TWICE.format(line=_COMMENT_LINE.format())).alias("value"))


COMMENT_LINES = f"""
comment_parts AS (
  SELECT event_id, user_id, k, {_COMMUNITY} AS community, {_CREATED} AS created,
    {_SCORE.format(text="VARCHAR")} AS score, {_BODY} AS body
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
          epoch_us(ts) // 1000000 AS secs FROM events)),
comment_lines AS (
  SELECT {_MAYBE_TWICE.format(line=_COMMENT_LINE.format())} AS value FROM comment_parts)"""

_SUBMISSION_LINE = """
  CASE WHEN c_acctbal < -900 THEN '{{bad' ELSE concat(
    '{{"id": "', c_custkey, '", "subreddit": "',
    CASE c_mktsegment WHEN 'BUILDING' THEN 'canada' WHEN 'MACHINERY' THEN ' LPC ' WHEN 'FURNITURE'
      THEN 'ndp' WHEN 'AUTOMOBILE' THEN 'Cpc' ELSE 'gardening' END, '"',
    CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 200 THEN ', "title": null'
      WHEN c_nationkey < 5 THEN concat(', "title": " Trudeau on ', c_name, '. "')
      ELSE concat(', "title": " ', c_name, '? "') END, '}}') END"""


def submission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw JSON line per customer."""
    return table(spark, sf_dir, "customer").select(F.expr(_SUBMISSION_LINE.format()).alias("value"))


SUBMISSION_LINES = f"""
submission_lines AS (SELECT {_SUBMISSION_LINE.format()} AS value FROM customer)"""


def threads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Replies as comments, and opening user turns as titled submissions."""
    talk = table(spark, sf_dir, "conversations")
    key = F.col("conv_id").cast("string")
    replies = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text").filter("turn > 0").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), key.alias("link_id_short"),
        F.col("text").alias("body"),
    )
    opening = talk.filter("turn = 0 AND role = 'user'").select(
        key.alias("id"), F.col("text").alias("title")
    )
    return replies, opening


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON.items()), "word string, valence double")


# Words for texts that all default rules of the lexicon apply to.
RULE_LEXICON = {
    "good": 1.9, "great": 3.1, "bad": -2.5, "no": -1.2, "shit": -2.6, "bomb": -2.2, "ass": -2.5, "death": -2.9, "die": -2.9,
    "heart": 3.2, "broken": -2.1, "yeah": 1.2, "kiss": 1.8, "kind": 2.4, "doubt": -1.5, "despite": -0.4,
}
RULE_FILLERS = [
    "the", "stop", "bus", "to", "for", "of", "right", "beating", "this", "so", "but", "or", "at", "least", "enough", "just", "it",
]
RULE_WORDS = [*RULE_LEXICON, *RULE_FILLERS, *sorted({w for b in [*K.BOOSTERS, *K.NEGATORS] for w in b.split()} - {*RULE_LEXICON, *RULE_FILLERS})]
_RULE_PLACES = [
    f"(o_orderkey * {a} + o_custkey * {b} + o_orderkey // 7 * {c}) % {n}" for a, b, c, n in (
        (1, 3, 7, 33), (5, 2, 11, len(RULE_WORDS)), (3, 7, 1, 33), (2, 5, 13, 33), (7, 1, 3, len(RULE_WORDS)), (11, 3, 2, 33),
        (13, 2, 5, 33), (1, 11, 17, len(RULE_WORDS)), (3, 13, 5, 33), (17, 5, 1, 33), (2, 7, 19, 33))
]


def rule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text of eleven of these words and now and then a phrase for each order."""
    listed = F.array(*map(F.lit, RULE_WORDS))
    picked = [F.element_at(listed, (F.expr(place.replace("//", "div")) + 1).cast("int")) for place in _RULE_PLACES]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    turn = F.col("o_custkey") % 10
    phrase = F.when(turn < len(_PHRASES), F.element_at(
        F.array(*map(F.lit, _PHRASES)), F.least(turn + 1, F.lit(len(_PHRASES))).cast("int"))).otherwise("")
    return orders.select("o_orderkey", F.concat_ws(" ", *picked[:6], phrase, *picked[6:]).alias("text"))


_PHRASES = ["kiss of death", "to die for", "the bomb", "kind of good", "yeah right", "without doubt", "never so great"]
RULE_TEXTS = f"""
rule_texts AS (
  SELECT o_orderkey, concat_ws(' ', {', '.join(f'w[{p} + 1]' for p in _RULE_PLACES[:6])},
    CASE WHEN o_custkey % 10 < {len(_PHRASES)} THEN {_PHRASES}[o_custkey % 10 + 1] ELSE '' END,
    {', '.join(f'w[{p} + 1]' for p in _RULE_PLACES[6:])}) AS text
  FROM orders, (SELECT [{', '.join("'" + w.replace("'", "''") + "'" for w in RULE_WORDS)}] AS w))"""

# Threads, most replies of which are moved into one of them.
HOT_THREADS = """
hot_replies AS (
  SELECT concat_ws('-', conv_id, turn) AS id, CASE WHEN conv_id % 5 = 0 THEN CAST(conv_id AS VARCHAR) ELSE '0' END AS link_id_short,
    text AS body FROM conversations WHERE turn > 0)"""


def hot_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text").filter("turn > 0")
    thread = F.when(F.col("conv_id") % 5 == 0, F.col("conv_id").cast("string")).otherwise("0")
    return replies.select(F.concat_ws("-", "conv_id", "turn").alias("id"), thread.alias("link_id_short"), F.col("text").alias("body"))


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows over some years: orders of odd customers."""
    day, n = F.col("o_orderdate").cast("date"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").filter(n % 2 == 1).select(
        F.col("o_orderpriority").alias("party"), day.alias("date"), F.weekofyear(day).alias("week"),
        F.extract(F.lit("YEAROFWEEK"), day).alias("iso_year"), ((n % 101 - 50) / F.lit(53.0)).alias("vader_score"),
        (n % 3).cast("int").alias("trans_sentiment"))


def order_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly polls over the same years: mean price of the other orders."""
    day = F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").filter(F.col("o_custkey") % 2 == 0).select(
        F.col("o_orderpriority").alias("party"), F.weekofyear(day).alias("week"),
        F.extract(F.lit("YEAROFWEEK"), day).alias("iso_year"), "o_totalprice")
    return rows.groupBy("party", "iso_year", "week").agg(F.avg("o_totalprice").alias("poll"))


ORDER_SERIES = """
order_rows AS (
  SELECT o_orderpriority AS party, CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, CAST(week(o_orderdate) AS INTEGER) AS week,
    CAST(date_trunc('week', o_orderdate) AS DATE) AS monday, o_custkey, o_totalprice FROM orders),
order_weekly AS (
  SELECT party, iso_year, week, monday, avg((o_custkey % 101 - 50) / CAST(53 AS DOUBLE)) AS vader_avg,
    count(*) FILTER (o_custkey % 3 = 2) / CAST(count(*) AS DOUBLE) AS trans_pos_ratio
  FROM order_rows WHERE o_custkey % 2 = 1 GROUP BY ALL),
order_polls AS (SELECT party, monday, avg(o_totalprice) AS poll FROM order_rows WHERE o_custkey % 2 = 0 GROUP BY ALL),
order_pairs AS (
  SELECT w.*, CAST(lag AS INTEGER) AS lag, poll FROM order_weekly w, range(0, 3) AS l(lag), order_polls p
  WHERE p.party = w.party AND p.monday + CAST(7 * lag AS INTEGER) = w.monday)"""

# Weights of a linear model: a stand-in for a trained one.
WEIGHTS = {
    "that": (0.2458, 0.4836, 0.5904),
    "and": (0.8849, 0.4798, 0.8446),
    "is": (-0.942, -0.0688, 0.8867),
    "und": (0.2979, 0.8018, -0.7736),
    "der": (-0.0619, -0.5069, 0.0875),
    "que": (0.1479, -0.9738, -0.5665),
    "de": (-0.441, 0.8327, 0.5315),
    "les": (-0.6808, 0.5943, -0.7225),
    "los": (0.2349, -0.7466, -0.9965),
    "in": (0.7428, -0.5811, -0.569),
}
INTERCEPTS = [0.2, 0.6, -0.1]


def weights(spark: SparkSession) -> DataFrame:
    rows = [(w, c, v) for w, values in WEIGHTS.items() for c, v in enumerate(values)]
    return spark.createDataFrame(rows, "term string, class int, weight double")
