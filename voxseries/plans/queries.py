"""Registered queries over the given tables, each with the SQL that must agree with it."""

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.dates import epoch_date, iso_week, iso_year
from voxseries.functions.numbers import clean_percent, ratio
from voxseries.functions.text import compact_number, in_set, is_placeholder
from voxseries.operators import audit as A
from voxseries.operators import classify as C
from voxseries.operators import clean
from voxseries.operators import correlate as R
from voxseries.operators import joins as J
from voxseries.operators import polls as P
from voxseries.operators import regress as G
from voxseries.operators import rollup as U
from voxseries.operators import sample as S
from voxseries.operators import views as V
from voxseries.operators.lexicon import lexicon_score
from voxseries.operators.target import targeted, targeted_comments
from voxseries.plans import standins as X
from voxseries.plans.analysis import split_grains
from voxseries.plans.etl import titled_comments
from voxseries.plans.scoring import COPIES, series_rows
from voxseries.sources import publish as W
from voxseries.sources.reference_series import PROBABILITY_HEADER, parse_percent_table
from voxseries.sources.tables import coerce_series, to_json_lines, union_parts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return register


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for comparison with another engine's sums."""
    return df.select(*[
        F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes
    ])


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
_EDGE = r"[^\p{L}\p{N}_]"
_MAPPING = "(VALUES ('purchase', 'lpc'), ('view', 'cpc'), ('click', 'ndp')) AS m(party, col)"


def _strip(sql: str) -> str:
    return f"trim({sql}, {_SPACE})"


# ---------------------------------------------------------------- records

_RECORDS = f"""
parsed AS (
  SELECT value, CASE WHEN json_valid(value) AND starts_with(ltrim(value), '{{{{') THEN CAST(value AS JSON) END AS j
  FROM {{lines}})""".replace("{{{{", "{")


def _text(key: str) -> str:
    raw = f"json_extract_string(j, '$.{key}')"
    return f"CASE WHEN json_type(j, '$.{key}') = 'BOOLEAN' THEN concat(upper({raw}[1]), {raw}[2:]) ELSE {raw} END"


def _members(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _text_or_none(key: str) -> str:
    return f"CASE WHEN json_type(j, '$.{key}') = 'NULL' THEN 'None' ELSE {_text(key)} END"


def _clean_comments_sql(_text) -> str:
    return f"""
checked AS (
  SELECT *, {_strip(_text('subreddit'))} AS community, {_strip(_text('body'))} AS body,
    {_strip(_text('link_id'))} AS link, json_type(j, '$.created_utc') AS ct, json_type(j, '$.score') AS st,
    {_strip("json_extract_string(j, '$.created_utc')")} AS cv, {_strip("json_extract_string(j, '$.score')")} AS sv
  FROM parsed WHERE j IS NOT NULL
    AND len(list_intersect(json_keys(j), {list(K.COMMENT_KEYS)})) = {len(K.COMMENT_KEYS)}),
typed AS (
  SELECT *, CASE WHEN ct IN ('NULL', 'ARRAY', 'OBJECT') THEN NULL
      WHEN ct = 'VARCHAR' AND NOT regexp_full_match(cv, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN NULL
      WHEN ct = 'BOOLEAN' THEN CAST(cv = 'true' AS BIGINT)
      ELSE CAST(trunc(TRY_CAST(cv AS DOUBLE)) AS BIGINT) END AS created_utc,
    coalesce(CASE WHEN st IN ('NULL', 'ARRAY', 'OBJECT') THEN NULL
      WHEN st = 'VARCHAR' THEN CASE WHEN regexp_full_match(sv, '[+-]?\\d+') THEN TRY_CAST(sv AS BIGINT) END
      WHEN st = 'BOOLEAN' THEN CAST(sv = 'true' AS BIGINT)
      ELSE CAST(trunc(TRY_CAST(sv AS DOUBLE)) AS BIGINT) END, 0) AS score
  FROM checked
  WHERE lower(community) IN {_members(K.COMMUNITIES)} AND body NOT IN ('', '[deleted]', '[removed]')),
comments AS (
  SELECT {_text('id')} AS id,
    CASE WHEN starts_with(link, 't3_') THEN substr(link, 4) ELSE link END AS link_id_short,
    {_text('parent_id')} AS parent_id, lower(community) AS subreddit, {_strip(_text('author'))} AS author,
    created_utc, score, body, {_strip(_text('permalink'))} AS permalink
  FROM typed WHERE created_utc IS NOT NULL)"""


_CLEAN_COMMENTS = _clean_comments_sql(_text)

_CLEAN_SUBMISSIONS = f"""
sub_parsed AS (
  SELECT CASE WHEN json_valid(value) AND starts_with(ltrim(value), '{{') THEN CAST(value AS JSON) END AS j
  FROM submission_lines),
submissions AS (
  SELECT {_text('id')} AS id, lower({_strip(_text('subreddit'))}) AS subreddit, {_strip(_text('title'))} AS title
  FROM sub_parsed
  WHERE j IS NOT NULL AND len(list_intersect(json_keys(j), ['id', 'subreddit', 'title'])) = 3
    AND lower({_strip(_text('subreddit'))}) IN {_members(K.COMMUNITIES)})"""

_FLAGGED = f"""
flagged AS (
  SELECT value, j IS NULL AS bad,
    coalesce(lower({_text('subreddit')}) IN {_members(K.COMMUNITIES)}
      AND (json_type(j, '$.body') = 'NULL' OR {_strip(_text('body'))} NOT IN ('', '[deleted]', '[removed]')),
      false) AS kept
  FROM parsed)"""

_PARSED = _RECORDS.format(lines="comment_lines")


@query(f"WITH {X.COMMENT_LINES}, {_PARSED}, {_CLEAN_COMMENTS} SELECT * FROM comments")
def clean_comments(spark, sf_dir):
    """Raw lines to typed comments."""
    return clean.clean_comments(X.comment_lines(spark, sf_dir))


@query(f"WITH {X.COMMENT_LINES}, {_PARSED}, {_clean_comments_sql(_text_or_none)} SELECT * FROM comments")
def clean_comments_legacy(spark, sf_dir):
    """A JSON null becomes the text None, and its row stays."""
    return clean.clean_comments(X.comment_lines(spark, sf_dir), legacy_none=True)


@query(f"WITH {X.SUBMISSION_LINES}, {_CLEAN_SUBMISSIONS} SELECT * FROM submissions")
def clean_submissions(spark, sf_dir):
    return clean.clean_submissions(X.submission_lines(spark, sf_dir))


@query(f"WITH {X.COMMENT_LINES}, {_PARSED}, {_FLAGGED} SELECT value FROM flagged WHERE kept")
def filter_raw_lines(spark, sf_dir):
    """First pass: original text of the kept lines."""
    return clean.filter_raw(X.comment_lines(spark, sf_dir))


@query(f"""WITH {X.COMMENT_LINES}, {_PARSED}, {_FLAGGED}
SELECT count(*) AS seen, count(*) FILTER (kept) AS kept, count(*) FILTER (bad) AS bad FROM flagged""")
def audit_raw_lines(spark, sf_dir):
    """D4 over the first pass."""
    return A.audit(clean.flag_raw(X.comment_lines(spark, sf_dir)), A.raw_counts())


@query(f"""WITH {X.COMMENT_LINES}, {_PARSED}, {_CLEAN_COMMENTS}
SELECT (SELECT count(*) FROM comment_lines) AS total, (SELECT count(*) FROM comments) AS kept""")
def audit_clean(spark, sf_dir):
    """D4 over the second pass."""
    lines = X.comment_lines(spark, sf_dir)
    return A.clean_counts(lines, clean.clean_comments(lines))


@query(f"""WITH {X.COMMENT_LINES}, {_PARSED}
SELECT json_extract_string(j, '$.id') AS id, json_extract_string(j, '$.permalink') AS permalink
FROM parsed WHERE j IS NOT NULL AND len(list_intersect(json_keys(j), ['id', 'permalink'])) = 2""")
def require_keys(spark, sf_dir):
    return clean.require_keys(X.comment_lines(spark, sf_dir), ["id", "permalink"]).drop("value")


@query(f"""SELECT doc_id, source, lang FROM documents
WHERE lower({_strip('source')}) IN ('src1', 'src3', 'src7', 'src19')
  AND {_strip('text')} NOT IN ('', '[deleted]', '[removed]')""")
def filter_sources(spark, sf_dir):
    """Membership and removed text."""
    docs = X.table(spark, sf_dir, "documents")
    wanted = in_set(F.col("source"), ["src1", "src3", "src7", "src19"])
    return docs.filter(wanted & ~is_placeholder(F.col("text"))).select("doc_id", "source", "lang")


# ---------------------------------------------------------------- joins of records

_THREADS = """
replies AS (
  SELECT concat_ws('-', conv_id, turn) AS id, CAST(conv_id AS VARCHAR) AS link_id_short, text AS body
  FROM conversations WHERE turn > 0),
opening AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, text AS title FROM conversations WHERE turn = 0 AND role = 'user')"""


@query(f"""WITH {_THREADS}
SELECT r.id, r.link_id_short, r.body, coalesce({_strip('o.title')}, '') AS title
FROM replies r LEFT JOIN opening o ON r.link_id_short = o.id""")
def attach_titles(spark, sf_dir):
    """Replies with the opening text of their thread."""
    return J.attach_titles(*X.threads(spark, sf_dir))


@query(f"""WITH {_THREADS}, {X.HOT_THREADS}
SELECT r.id, r.link_id_short, r.body, coalesce({_strip('o.title')}, '') AS title
FROM hot_replies r LEFT JOIN opening o ON r.link_id_short = o.id""")
def attach_titles_hot(spark, sf_dir):
    """C1 where one thread holds most replies: found by a sketch, and spread over several join keys."""
    replies = X.hot_replies(spark, sf_dir)
    return J.attach_titles(replies, X.threads(spark, sf_dir)[1], hot=J.hot_keys(replies, "link_id_short"))


@query(f"""WITH {_THREADS}
SELECT count(*) AS inputs, count(o.id) AS matched, count(*) - count(o.id) AS unmatched
FROM replies r LEFT JOIN opening o ON r.link_id_short = o.id""")
def audit_titles(spark, sf_dir):
    """D4 over the join."""
    return A.audit(J.flag_matches(*X.threads(spark, sf_dir)), A.match_counts())


# ---------------------------------------------------------------- text


def _targeted_sql(source: str, keys: str, text: str, dictionary) -> str:
    arms = []
    for group, words in dictionary.items():
        pattern = f"(?:^|{_EDGE})(?:{'|'.join(words)})(?:$|{_EDGE})"
        arms.append(f"""
  SELECT {keys}, '{group}' AS party,
    array_to_string(list_filter(s, lambda x: regexp_matches(x, '{pattern}')), '. ') AS targeted_sentence
  FROM cut""")
    return f"""cut AS (
  SELECT {keys}, list_filter(list_transform(regexp_split_to_array(lower({text}), '[.!?]'),
    lambda x: {_strip('x')}), lambda x: x <> '') AS s FROM {source}),
named AS ({' UNION ALL '.join(arms)}),
hits AS (SELECT * FROM named WHERE targeted_sentence <> '')"""


@query(f"WITH {_targeted_sql('documents', 'doc_id', 'text', X.LANGUAGE_KEYWORDS)} SELECT * FROM hits")
def targeted_documents(spark, sf_dir):
    """Sentences of each document that name a group."""
    docs = X.texts(spark, sf_dir, "documents", "doc_id", "text")
    return targeted(docs, "text", X.LANGUAGE_KEYWORDS).select("doc_id", "party", "targeted_sentence")


@query(f"""WITH {_THREADS}, titled AS (
  SELECT r.id, concat_ws(' ', coalesce({_strip('o.title')}, ''), r.body) AS full_text
  FROM replies r LEFT JOIN opening o ON r.link_id_short = o.id),
{_targeted_sql('titled', 'id', 'full_text', X.LANGUAGE_KEYWORDS)} SELECT * FROM hits""")
def targeted_replies(spark, sf_dir):
    """A word in the opening text counts for every reply."""
    titled = J.attach_titles(*X.threads(spark, sf_dir))
    text = titled.select("id", F.concat_ws(" ", "title", "body").alias("full_text"))
    return targeted(text, "full_text", X.LANGUAGE_KEYWORDS).drop("full_text")


def _case(column: str, mapping) -> str:
    arms = " ".join(f"WHEN {_sql_text(k)} THEN {v}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE 0 END"


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _quoted(values) -> str:
    return ", ".join(map(_sql_text, values))


def _lexicon_sql(
    source: str = "documents", key: str = "doc_id", lexicon=X.LEXICON, boosters=X.BOOSTERS, negators=X.NEGATORS,
    idioms=X.IDIOMS, before: str = "",
) -> str:
    """The same rules over token positions, with window functions."""
    punctuation = K.PUNCTUATION.replace("'", "''")
    marks = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
    steps, score = [], "start"
    for k, damp in enumerate(K.DISTANCE_DAMPING, 1):
        near = f"p{k}"
        acts = f"({near} IS NOT NULL AND {near}_v IS NULL)"
        between = [f"p{i}" for i in range(1, k)]
        negates = f"({near} IN ({_quoted(negators)}) OR contains({near}, 'n''t'))"
        rules = ""
        if between:
            so = " OR ".join(f"coalesce({b} IN ('so', 'this'), false)" for b in between)
            doubt = " OR ".join(f"coalesce({b} = 'doubt', false)" for b in between)
            rules = f"WHEN {near} = 'never' AND ({so}) THEN {K.NEVER_SO_WEIGHT} WHEN {near} = 'without' AND ({doubt}) THEN 1.0 "
        steps.append(f"""
stepped{k} AS (
  SELECT *, (({score}) + CASE WHEN {acts} THEN {_case(near, boosters)} * sign_{k} * {damp} ELSE 0 END)
    * CASE WHEN NOT {acts} THEN 1.0 {rules}WHEN {negates} THEN {K.NEGATION_WEIGHT} ELSE 1.0 END AS score{k}
  FROM (SELECT *, CASE WHEN {score} < 0 THEN -1.0 ELSE 1.0 END AS sign_{k}
        FROM {'started' if k == 1 else f'stepped{k - 1}'}))""")
        score = f"score{k}"
    idiom = " ".join(f"WHEN {{p}} = {_sql_text(p)} THEN {v}" for p, v in idioms.items())

    def phrase(*names):
        return "(" + " || ' ' || ".join(names) + ")"

    order = [("w", "n1", "n2"), ("w", "n1"), ("p1", "w"), ("p2", "p1", "w"), ("p2", "p1"), ("p3", "p2", "p1"), ("p3", "p2")]
    own = ", ".join(f"CASE {idiom.format(p=phrase(*names))} END" for names in order)
    degree = " + ".join(_case(phrase(*n), boosters) for n in [("p3", "p2", "p1"), ("p3", "p2"), ("p2", "p1")])
    values = ", ".join(f"({_sql_text(w)}, CAST({v} AS DOUBLE))" for w, v in lexicon.items())
    single = _quoted([b for b in boosters if " " not in b])
    windows = ", ".join(
        f"{fn}({what}, {d}) OVER o AS {name}{suffix}"
        for name, fn, d in (("p1", "lag", 1), ("p2", "lag", 2), ("p3", "lag", 3), ("n1", "lead", 1), ("n2", "lead", 2))
        for what, suffix in (("w", ""), ("valence", "_v"))
    )
    return f"""WITH {before}lexicon(word, valence) AS (VALUES {values}),
split AS (
  SELECT {key}, list_filter(string_split_regex(translate(lower(text), {marks}, '{' ' * 11}'), ' +'), lambda t: t <> '') AS l
  FROM {source}),
raw AS (SELECT {key}, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS pos FROM split),
token AS (
  SELECT {key}, pos, CASE WHEN length(trim(t, '{punctuation}')) > 2 THEN trim(t, '{punctuation}') ELSE t END AS w
  FROM raw),
valued AS (SELECT token.*, valence FROM token LEFT JOIN lexicon ON w = word),
near AS (
  SELECT *, {windows}, min(CASE WHEN w = 'but' THEN pos END) OVER (PARTITION BY {key}) AS but
  FROM valued WINDOW o AS (PARTITION BY {key} ORDER BY pos)),
started AS (
  SELECT *, CASE WHEN coalesce(p1 = 'no', false) OR coalesce(p2 = 'no', false)
        OR coalesce(p3 = 'no' AND p1 IN ('or', 'nor'), false) THEN valence * {K.NEGATION_WEIGHT}
      WHEN w = 'no' AND n1_v IS NOT NULL THEN 0.0 ELSE valence END AS start
  FROM near
  WHERE valence IS NOT NULL AND w NOT IN ({single}) AND NOT coalesce(w = 'kind' AND n1 = 'of', false)),
{','.join(steps)},
phrased AS (
  SELECT *, CASE WHEN p3 IS NOT NULL AND p3_v IS NULL
    THEN coalesce({own}, score3) + ({degree}) ELSE score3 END AS score4 FROM stepped3),
total AS (
  SELECT {key}, sum(score4
    * CASE WHEN p1 = 'least' AND p1_v IS NULL AND (p2 IS NULL OR p2 NOT IN ('at', 'very'))
        THEN {K.NEGATION_WEIGHT} ELSE 1.0 END
    * CASE WHEN pos < but THEN {K.BEFORE_BUT_WEIGHT} WHEN pos > but THEN {K.AFTER_BUT_WEIGHT} ELSE 1.0 END) AS s
  FROM phrased GROUP BY {key})
SELECT {key}, round(coalesce(s / sqrt(s * s + {K.NORMALISER}), 0.0), 4) AS vader_score
FROM {source} d LEFT JOIN total USING ({key})"""


@query(_lexicon_sql())
def lexicon_documents(spark, sf_dir):
    """Compound score of every document's whole text."""
    return lexicon_score(
        X.texts(spark, sf_dir, "documents", "doc_id", "text"), "text", X.lexicon(spark), ["doc_id"],
        boosters=X.BOOSTERS, negators=X.NEGATORS, idioms=X.IDIOMS,
    )


@query(_lexicon_sql(
    "rule_texts", "o_orderkey", X.RULE_LEXICON, K.BOOSTERS, K.NEGATORS, K.IDIOMS, X.RULE_TEXTS + ", "))
def lexicon_default_rules(spark, sf_dir):
    """E2 with all default rule tables, over texts that make use of them."""
    words = spark.createDataFrame(list(X.RULE_LEXICON.items()), "word string, valence double")
    return lexicon_score(X.rule_texts(spark, sf_dir), "text", words, ["o_orderkey"])


_LINEAR = ", ".join(f"({_sql_text(w)}, {', '.join(f'CAST({x} AS DOUBLE)' for x in v)})" for w, v in X.WEIGHTS.items())
_TOKENS = f"""list_filter(string_split_regex(translate(lower(text), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28)
  || chr(29) || chr(30) || chr(31) || chr(133) || chr(160), '{' ' * 11}'), ' +'), lambda t: t <> '')"""


@query(f"""WITH weights(term, w0, w1, w2) AS (VALUES {_LINEAR}),
raw AS (SELECT doc_id, unnest({_TOKENS}) AS t FROM documents),
token AS (SELECT doc_id, CASE WHEN length(trim(t, '{K.PUNCTUATION.replace("'", "''")}')) > 2
    THEN trim(t, '{K.PUNCTUATION.replace("'", "''")}') ELSE t END AS term FROM raw),
sums AS (
  SELECT doc_id, {X.INTERCEPTS[0]} + coalesce(sum(w0), 0) AS s0, {X.INTERCEPTS[1]} + coalesce(sum(w1), 0) AS s1,
    {X.INTERCEPTS[2]} + coalesce(sum(w2), 0) AS s2
  FROM documents LEFT JOIN token USING (doc_id) LEFT JOIN weights USING (term) GROUP BY doc_id)
SELECT doc_id, CASE WHEN {_strip("coalesce(text, '')")} = '' THEN 1 WHEN round(s0, 9) >= round(greatest(s1, s2), 9) THEN 0
  WHEN round(s1, 9) >= round(s2, 9) THEN 1 ELSE 2 END AS trans_sentiment
FROM documents JOIN sums USING (doc_id)""")
def classify_linear(spark, sf_dir):
    """A linear model as joins and sums."""
    docs = X.texts(spark, sf_dir, "documents", "doc_id", "text")
    return C.classify_linear(docs, "text", X.weights(spark), X.INTERCEPTS, ["doc_id"])


def _training_rows(spark, sf_dir):
    labels = X.table(spark, sf_dir, "labels")
    label = F.when(F.col("toxic") == 1, K.NEGATIVE).when(F.col("quality") == 1, K.POSITIVE).otherwise(K.NEUTRAL)
    docs = X.texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.join(labels.select("doc_id", label.alias("label")), "doc_id")


@query()
def classify_documents(spark, sf_dir):
    """The default classifier, trained on the labelled documents, over all of them."""
    model = C.train_classifier(_training_rows(spark, sf_dir), "text", "label")
    docs = X.texts(spark, sf_dir, "documents", "doc_id", "text")
    return C.classify_with(docs, "text", model).select("doc_id", "trans_sentiment")


def load_length_model():
    """A stand-in model: longer texts lean positive, texts with more digits negative."""
    def scores(texts):
        size = np.array([len(t) for t in texts], dtype=float)
        digits = np.array([sum(c in "0123456789" for c in t) for t in texts], dtype=float)
        return np.stack([digits * 50, np.full(len(texts), 1000.0), size], axis=1)
    return scores


@query("""SELECT doc_id, CASE WHEN trim(text) = '' OR text IS NULL THEN 1
  WHEN 50 * d >= greatest(1000, n) THEN 0 WHEN 1000 >= n THEN 1 ELSE 2 END AS trans_sentiment
FROM (SELECT doc_id, text, length(text) AS n, length(regexp_replace(text, '[^0-9]', '', 'g')) AS d FROM documents)""")
def classify_with_hook(spark, sf_dir):
    """Any batch model through the hook."""
    docs = X.texts(spark, sf_dir, "documents", "doc_id", "text")
    return C.classify(docs, "text", load_length_model).select("doc_id", "trans_sentiment")


# ---------------------------------------------------------------- series

_METRICS = """avg(vader_score) AS vader_avg,
  CAST(count(*) FILTER (trans_sentiment = 2) AS BIGINT) AS pos_count,
  CAST(count(*) FILTER (trans_sentiment = 0) AS BIGINT) AS neg_count,
  CAST(count(*) FILTER (trans_sentiment = 1) AS BIGINT) AS neu_count,
  count(*) AS comment_volume, CAST(count(trans_sentiment) AS BIGINT) AS total,
  count(*) FILTER (trans_sentiment = 2) / nullif(CAST(count(trans_sentiment) AS DOUBLE), 0) AS trans_pos_ratio,
  count(*) FILTER (trans_sentiment = 0) / nullif(CAST(count(trans_sentiment) AS DOUBLE), 0) AS trans_neg_ratio,
  count(*) FILTER (trans_sentiment = 1) / nullif(CAST(count(trans_sentiment) AS DOUBLE), 0) AS trans_neu_ratio"""
_ROUNDED = """round(vader_avg, 6) AS vader_avg, pos_count, neg_count, neu_count, comment_volume, total,
  round(trans_pos_ratio, 6) AS trans_pos_ratio, round(trans_neg_ratio, 6) AS trans_neg_ratio,
  round(trans_neu_ratio, 6) AS trans_neu_ratio"""
_DAILY = f"daily AS (SELECT party, date, {_METRICS} FROM scored WHERE party IS NOT NULL GROUP BY party, date)"
_WEEKLY = f"weekly AS (SELECT party, week, {_METRICS} FROM scored WHERE party IS NOT NULL GROUP BY party, week)"


def _daily(spark, sf_dir):
    return U.rollup(X.scored_events(spark, sf_dir), ["party", "date"])


def _weekly(spark, sf_dir):
    return U.rollup(X.scored_events(spark, sf_dir), ["party", "week"])


@query(f"WITH {X.SCORED}, {_DAILY} SELECT party, date, {_ROUNDED} FROM daily")
def rollup_daily(spark, sf_dir):
    """D2 with B13-B15, in the order it is written (H1)."""
    return r6(U.in_order(_daily(spark, sf_dir), "date"))


@query(f"WITH {X.SCORED}, {_WEEKLY} SELECT party, week, {_ROUNDED} FROM weekly")
def rollup_weekly(spark, sf_dir):
    """D1."""
    return r6(U.in_order(_weekly(spark, sf_dir), "week"))


@query(f"""WITH {X.SCORED}, {_DAILY}, {_WEEKLY}
SELECT 'weekly' AS grain, party, week, CAST(NULL AS DATE) AS date, {_ROUNDED} FROM weekly UNION ALL
SELECT 'daily', party, NULL, date, {_ROUNDED} FROM daily""")
def rollup_both(spark, sf_dir):
    """D1 and D2 from one scan."""
    return r6(U.rollup_both(X.scored_events(spark, sf_dir)))


@query(f"""WITH {X.SCORED}
SELECT event_id, CASE WHEN trans_sentiment = 2 THEN 1 ELSE 0 END AS is_pos,
  CASE WHEN trans_sentiment = 0 THEN 1 ELSE 0 END AS is_neg,
  CASE WHEN trans_sentiment = 1 THEN 1 ELSE 0 END AS is_neu FROM scored""")
def class_indicators(spark, sf_dir):
    """B14."""
    rows = U.class_indicators(X.scored_events(spark, sf_dir))
    return rows.select("event_id", "is_pos", "is_neg", "is_neu")


@query("""SELECT event_id, CAST(timezone('America/Vancouver', timezone('UTC', ts)) AS DATE) AS date,
  CAST(week(CAST(timezone('America/Vancouver', timezone('UTC', ts)) AS DATE)) AS INTEGER) AS week,
  CAST(isoyear(CAST(timezone('America/Vancouver', timezone('UTC', ts)) AS DATE)) AS INTEGER) AS iso_year
FROM events""")
def local_dates(spark, sf_dir):
    """Epoch seconds to the date, week and week's year of another zone."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    rows = X.table(spark, sf_dir, "events").select(
        "event_id", epoch_date(F.timestamp_diff("SECOND", start, F.col("ts")), "America/Vancouver").alias("date")
    )
    return rows.select(
        "event_id", "date", iso_week(F.col("date")).alias("week"), iso_year(F.col("date")).alias("iso_year")
    )


# ---------------------------------------------------------------- polls

_POLL_WEEKLY = """poll_weekly AS (
  SELECT week, avg(lpc) AS lpc, avg(cpc) AS cpc, avg(ndp) AS ndp, avg(oth) AS oth FROM polls GROUP BY week)"""
_POLL_DAILY = "poll_daily AS (SELECT * FROM polls WHERE freq = 'daily')"


def _long_sql(name: str, source: str, key: str) -> str:
    return f"""{name} AS (
  SELECT {key}, party, CASE col WHEN 'lpc' THEN lpc WHEN 'cpc' THEN cpc ELSE ndp END AS poll
  FROM {source}, {_MAPPING})"""


_WEEK_LONG = _long_sql("week_polls", "poll_weekly", "week")
_DAY_LONG = _long_sql("day_polls", "poll_daily", "date")
_WEEK_SIDE = f"{X.SCORED}, {_WEEKLY}, {X.POLLS}, {_POLL_WEEKLY}, {_WEEK_LONG}"
_DAY_SIDE = f"{X.SCORED}, {_DAILY}, {X.POLLS}, {_POLL_DAILY}, {_DAY_LONG}"


def _week_polls(spark, sf_dir):
    return J.polls_long(P.poll_weekly(X.event_polls(spark, sf_dir)), ["week"], X.POLL_COLUMNS)


def _day_polls(spark, sf_dir):
    return J.polls_long(P.poll_daily(X.event_polls(spark, sf_dir)), ["date"], X.POLL_COLUMNS)


@query(f"""WITH {X.POLLS}, {_POLL_WEEKLY}
SELECT week, round(lpc, 6) AS lpc, round(cpc, 6) AS cpc, round(ndp, 6) AS ndp, round(oth, 6) AS oth FROM poll_weekly""")
def poll_weekly(spark, sf_dir):
    """D3: mean per week label over polls of both granularities."""
    return r6(P.poll_weekly(X.event_polls(spark, sf_dir)))


@query(f"""WITH {X.POLLS}
SELECT CAST(week(date) AS INTEGER) AS week, round(avg(lpc), 6) AS lpc, round(avg(cpc), 6) AS cpc,
  round(avg(ndp), 6) AS ndp, round(avg(oth), 6) AS oth FROM polls GROUP BY 1""")
def poll_weekly_iso(spark, sf_dir):
    """D3 by ISO week instead of the label."""
    return r6(P.poll_weekly(X.event_polls(spark, sf_dir), week_source="iso"))


@query(f"""WITH {X.POLLS}, {_POLL_DAILY}
SELECT date, round(lpc, 6) AS lpc, round(cpc, 6) AS cpc, round(ndp, 6) AS ndp, round(oth, 6) AS oth, freq, week
FROM poll_daily""")
def poll_daily(spark, sf_dir):
    """B18."""
    return r6(P.poll_daily(X.event_polls(spark, sf_dir)))


@query(f"WITH {X.POLLS}, {_POLL_DAILY}, {_DAY_LONG} SELECT date, party, round(poll, 6) AS poll FROM day_polls")
def polls_long(spark, sf_dir):
    """C6."""
    return r6(_day_polls(spark, sf_dir))


def _percent_lines(spark, sf_dir):
    """Daily means as whitespace-delimited text with percent signs, and some spoiled cells."""
    rows = X.event_polls(spark, sf_dir).select(
        F.col("date").cast("string").alias("date"), "freq", "week",
        *[F.round(c, 2).cast("string").alias(c) for c in ("lpc", "cpc", "ndp")],
    )
    return rows.select(F.concat(
        "date", F.lit(" \t"), "lpc", F.lit("%\t"),
        F.when(F.col("freq") == "weekly", "n/a").otherwise(F.concat("cpc", F.lit("%​"))),
        F.lit("  "), "ndp", F.lit("0%\t5%  "), "freq", F.lit("   "), "week",
    ).alias("value"))


@query(f"""WITH {X.POLLS}
SELECT date, round(lpc, 2) AS lpc, CASE WHEN freq <> 'weekly' THEN round(cpc, 2) END AS cpc,
  round(ndp, 2) AS ndp, CAST(5 AS DOUBLE) AS oth, freq, week FROM polls""")
def parse_poll_table(spark, sf_dir):
    """Text rows to a poll table; spoiled cells become null."""
    return parse_percent_table(_percent_lines(spark, sf_dir))


@query(f"""WITH {X.POLLS}
SELECT date, round(lpc, 2) AS lpc, round(cpc, 2) AS cpc FROM polls""")
def parse_probability_table(spark, sf_dir):
    """A7."""
    rows = X.event_polls(spark, sf_dir).select(F.concat(
        F.col("date").cast("string"), F.lit("\t"), F.round("lpc", 2).cast("string"), F.lit("%  "),
        F.round("cpc", 2).cast("string"), F.lit("%"),
    ).alias("value"))
    return parse_percent_table(rows, PROBABILITY_HEADER)


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN NULL ELSE o_totalprice END AS percent FROM orders""")
def clean_percent_cells(spark, sf_dir):
    """A6 on its own: padded, signed, invisible and spoiled characters."""
    text = F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("%​ "))
    cell = F.when(F.col("o_orderstatus") == "F", "missing").otherwise(text)
    return X.table(spark, sf_dir, "orders").select("o_orderkey", clean_percent(cell).alias("percent"))


# ---------------------------------------------------------------- series beside polls


@query(f"""WITH {X.SCORED}, {_WEEKLY}, {X.POLLS}, {_POLL_WEEKLY}
SELECT w.party, week, round(vader_avg, 6) AS vader_avg, round(trans_pos_ratio, 6) AS trans_pos_ratio,
  round(lpc, 6) AS lpc, round(cpc, 6) AS cpc, round(ndp, 6) AS ndp, round(oth, 6) AS oth
FROM weekly w JOIN poll_weekly USING (week)""")
def join_week(spark, sf_dir):
    """C2."""
    joined = J.join_polls(_weekly(spark, sf_dir), P.poll_weekly(X.event_polls(spark, sf_dir)), "week")
    return r6(joined.select("party", "week", *K.MEASURES, *K.POLL_VALUES))


@query(f"""WITH {X.SCORED}, {_DAILY}, {X.POLLS}, {_POLL_DAILY}
SELECT d.party, date, round(vader_avg, 6) AS vader_avg, round(trans_pos_ratio, 6) AS trans_pos_ratio,
  round(lpc, 6) AS lpc, round(cpc, 6) AS cpc, round(ndp, 6) AS ndp, round(oth, 6) AS oth
FROM daily d JOIN poll_daily USING (date)""")
def join_date(spark, sf_dir):
    """C3."""
    joined = J.join_polls(_daily(spark, sf_dir), P.poll_daily(X.event_polls(spark, sf_dir)), "date")
    return r6(joined.select("party", "date", *K.MEASURES, *K.POLL_VALUES))


@query(f"""WITH {_DAY_SIDE}
SELECT party, date, round(vader_avg, 6) AS vader_avg, comment_volume, round(poll, 6) AS poll
FROM daily LEFT JOIN day_polls USING (party, date)""")
def left_series(spark, sf_dir):
    """All days, polled or not."""
    rows = J.left_series(_daily(spark, sf_dir), _day_polls(spark, sf_dir), "date")
    return r6(rows.select("party", "date", "vader_avg", "comment_volume", "poll"))


_DAY_PAIRS = """pairs AS (
  SELECT d.party, d.date, lag, vader_avg, trans_pos_ratio, poll
  FROM daily d, range(0, 6) AS l(lag), day_polls p
  WHERE p.party = d.party AND p.date + CAST(lag AS INTEGER) = d.date)"""
_WEEK_PAIRS = """pairs AS (
  SELECT w.party, w.week, lag, vader_avg, trans_pos_ratio, poll
  FROM weekly w, range(0, 2) AS l(lag), week_polls p
  WHERE p.party = w.party AND p.week + lag = w.week)"""
_DAY_PAIRED = f"{_DAY_SIDE}, {_DAY_PAIRS}"
_WEEK_PAIRED = f"{_WEEK_SIDE}, {_WEEK_PAIRS}"


def _day_pairs(spark, sf_dir, lags=K.DAILY_LAGS):
    return J.lagged_pairs(_daily(spark, sf_dir), _day_polls(spark, sf_dir), "date", lags)


def _week_pairs(spark, sf_dir, lags=K.WEEKLY_LAGS):
    return J.lagged_pairs(_weekly(spark, sf_dir), _week_polls(spark, sf_dir), "week", lags)


def _lagged_sql(side: str, key: str) -> str:
    return f"""WITH {side}
SELECT party, {key}, CAST(lag AS INTEGER) AS lag, round(vader_avg, 6) AS vader_avg, round(poll, 6) AS poll FROM pairs"""


@query(_lagged_sql(_DAY_PAIRED, "date"))
def lagged_pairs_daily(spark, sf_dir):
    """C4, lags 0 to 5 days."""
    return r6(_day_pairs(spark, sf_dir).select("party", "date", "lag", "vader_avg", "poll"))


@query(_lagged_sql(_WEEK_PAIRED, "week"))
def lagged_pairs_weekly(spark, sf_dir):
    """C4, lags 0 and 1 week."""
    return r6(_week_pairs(spark, sf_dir).select("party", "week", "lag", "vader_avg", "poll"))


def _year_series(spark, sf_dir):
    return U.rollup(X.scored_orders(spark, sf_dir), ["party", "iso_year", "week"])


@query(f"""WITH {X.ORDER_SERIES}
SELECT party, iso_year, week, round(vader_avg, 6) AS vader_avg, round(trans_pos_ratio, 6) AS trans_pos_ratio FROM order_weekly""")
def rollup_weekly_years(spark, sf_dir):
    """D1 over years: weeks of different years stay apart."""
    return r6(_year_series(spark, sf_dir).select("party", "iso_year", "week", *K.MEASURES))


@query(f"""WITH {X.ORDER_SERIES}
SELECT party, iso_year, week, lag, round(vader_avg, 6) AS vader_avg, round(poll, 6) AS poll FROM order_pairs""")
def lagged_pairs_years(spark, sf_dir):
    """C4 over years: lags reach back across new year."""
    pairs = J.lagged_pairs_years(_year_series(spark, sf_dir), X.order_polls(spark, sf_dir), [0, 1, 2])
    return pairs.select("party", "iso_year", "week", "lag", F.round("vader_avg", 6).alias("vader_avg"), F.round("poll", 6).alias("poll"))


# ---------------------------------------------------------------- statistics


def _stats_sql(source: str, by: str, min_n: int, measures) -> str:
    arms = " UNION ALL ".join(
        f"SELECT {by}, '{m}' AS measure, CAST({m} AS DOUBLE) AS x, CAST(poll AS DOUBLE) AS y FROM {source}"
        for m in measures
    )

    def r(x, y):
        return f"""CASE WHEN count(*) >= {min_n} THEN
    (count(*) * sum({x} * {y}) - sum({x}) * sum({y}))
    / nullif(sqrt(count(*) * sum({x} * {x}) - sum({x}) * sum({x}))
      * sqrt(count(*) * sum({y} * {y}) - sum({y}) * sum({y})), 0) END"""

    return f"""long AS ({arms}),
complete AS (SELECT * FROM long WHERE x IS NOT NULL AND y IS NOT NULL),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY {by}, measure ORDER BY x)
      + (count(*) OVER (PARTITION BY {by}, measure, x) - 1) / 2.0 AS rx,
    rank() OVER (PARTITION BY {by}, measure ORDER BY y)
      + (count(*) OVER (PARTITION BY {by}, measure, y) - 1) / 2.0 AS ry,
    x - avg(x) OVER (PARTITION BY {by}, measure) AS cx, y - avg(y) OVER (PARTITION BY {by}, measure) AS cy
  FROM complete),
stats AS (
  SELECT {by}, measure, {r('cx', 'cy')} AS pearson, {r('CAST(rx AS DOUBLE)', 'CAST(ry AS DOUBLE)')} AS spearman,
    count(*) AS n
  FROM ranked GROUP BY {by}, measure)"""


def _wide_sql(side: str) -> str:
    cells = ", ".join(
        f"round(max({col}) FILTER (measure = '{m}'), 6) AS {m}_{short}"
        for m in K.MEASURES for short, col in (("pear", "pearson"), ("spear", "spearman"))
    )
    counts = ", ".join(f"max(n) FILTER (measure = '{m}') AS {m}_n" for m in K.MEASURES)
    return f"""WITH {side}, {_stats_sql('pairs', 'party, lag', 3, K.MEASURES)}
SELECT party, CAST(lag AS INTEGER) AS lag, {cells}, {counts} FROM stats GROUP BY party, lag"""


@query(_wide_sql(_DAY_PAIRED))
def corr_daily(spark, sf_dir):
    """G1, G3-G5 over lagged days."""
    return r6(R.corr_table(_day_pairs(spark, sf_dir)))


@query(_wide_sql(_WEEK_PAIRED))
def corr_weekly(spark, sf_dir):
    """G1 over lagged weeks."""
    return r6(R.corr_table(_week_pairs(spark, sf_dir)))


_TALL = f"""WITH {_DAY_PAIRED.replace('range(0, 6)', 'range(0, 1)')},
{_stats_sql('pairs', 'party', 5, K.MEASURES)}"""


@query(f"""{_TALL} SELECT party, measure, round(pearson, 6) AS pearson, round(spearman, 6) AS spearman, n FROM stats
UNION ALL SELECT DISTINCT party, 'absent', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(0 AS BIGINT) FROM pairs""")
def corr_by_model(spark, sf_dir):
    """Same-day correlations, one of the measures not in the table."""
    return r6(R.corr_long(_day_pairs(spark, sf_dir, [0]), measures=[*K.MEASURES, "absent"]))


_RAW_PAIRS = """pairs AS (
  SELECT event_type AS party, value AS level, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
    user_id AS poll FROM events)"""


@query(f"""WITH {_RAW_PAIRS}, {_stats_sql('pairs', 'party', 5, ['level', 'k'])}
SELECT party, measure, round(pearson, 6) AS pearson, round(spearman, 6) AS spearman, n FROM stats""")
def corr_raw_rows(spark, sf_dir):
    """G3, G4 over raw rows, with ranks that never sort a whole group in one task."""
    rows = X.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("party"), F.col("value").alias("level"),
        F.get_json_object("props", "$.k").cast("double").alias("k"), F.col("user_id").alias("poll"),
    )
    return r6(R.corr_long(rows, measures=["level", "k"], large_groups=True))


def _ols_sql(side: str) -> str:
    arms = " UNION ALL ".join(
        f"SELECT party, '{m}' AS measure, {m} AS x, poll AS y FROM pairs WHERE {m} IS NOT NULL AND poll IS NOT NULL"
        for m in K.MEASURES
    )
    return f"""WITH {side}, long AS ({arms}),
moments AS (
  SELECT party, measure, count(*) AS n, avg(x) AS mx, avg(y) AS my, min(x) AS x_min, max(x) AS x_max
  FROM long GROUP BY party, measure HAVING count(*) >= 5),
sums AS (
  SELECT m.*, s.sxx, s.syy, s.sxy FROM moments m JOIN (
    SELECT party, measure, sum((x - mx) * (x - mx)) AS sxx, sum((y - my) * (y - my)) AS syy,
      sum((x - mx) * (y - my)) AS sxy
    FROM long JOIN moments USING (party, measure) GROUP BY party, measure) s USING (party, measure)),
lines AS (
  SELECT *, sxy / nullif(sxx, 0) AS slope, my - sxy / nullif(sxx, 0) * mx AS intercept,
    sxy * sxy / nullif(sxx * syy, 0) AS r2,
    (sxy / nullif(sxx, 0)) / nullif(sqrt((syy - sxy * sxy / nullif(sxx, 0)) / (n - 2) / nullif(sxx, 0)), 0) AS t
  FROM sums)"""


_DAY_OLS = _ols_sql(_DAY_PAIRED.replace("range(0, 6)", "range(0, 1)"))
_WEEK_OLS = _ols_sql(_WEEK_PAIRED.replace("range(0, 2)", "range(0, 1)"))
_OLS_COLUMNS = """party, measure, n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(t, 6) AS t,
  round(r2, 6) AS r2, round(x_min, 6) AS x_min, round(x_max, 6) AS x_max"""


@query(f"{_DAY_OLS} SELECT {_OLS_COLUMNS} FROM lines")
def ols_daily(spark, sf_dir):
    """G6 without the p-value."""
    return r6(G.ols(_day_pairs(spark, sf_dir, [0]), pvalue=False))


@query(f"{_WEEK_OLS} SELECT {_OLS_COLUMNS} FROM lines")
def ols_weekly(spark, sf_dir):
    return r6(G.ols(_week_pairs(spark, sf_dir, [0]), pvalue=False))


def with_p_value(lines: str, columns: str) -> str:
    """The lines with their p-value. For whole degrees of freedom it is a finite sum of even powers of a cosine."""
    return f"""{lines},
angles AS (SELECT *, n - 2 AS f, atan(abs(t) / sqrt(n - 2)) AS a FROM lines),
powers AS (
  SELECT party, measure, exp(sum(ln(CASE WHEN i = 0 THEN 1.0 WHEN f % 2 = 0 THEN (2.0 * i - 1) / (2 * i)
      ELSE 2.0 * i / (2 * i + 1) END)) OVER (PARTITION BY party, measure ORDER BY i)) * cos(a) ** (2 * i) AS term
  FROM angles, range(0, 500) AS g(i) WHERE 2 * i <= f - CASE WHEN f % 2 = 0 THEN 2 ELSE 3 END),
series AS (SELECT party, measure, sum(term) AS s FROM powers GROUP BY party, measure),
tailed AS (
  SELECT angles.*, 1 - CASE WHEN f % 2 = 0 THEN sin(a) * s ELSE 2 / pi() * (a + sin(a) * cos(a) * coalesce(s, 0)) END AS p
  FROM angles LEFT JOIN series USING (party, measure))
SELECT {columns}, {'round(p, 6)' if 'round' in columns else 'p'} AS p FROM tailed"""


@query(with_p_value(_DAY_OLS, _OLS_COLUMNS))
def ols_daily_p(spark, sf_dir):
    """G6 with the p-value."""
    return r6(G.ols(_day_pairs(spark, sf_dir, [0])))


@query(f"""{_DAY_OLS}
SELECT party, measure, CAST(i AS INTEGER) AS point, round(x_min + i * ((x_max - x_min) / 99), 6) AS x,
  round(intercept + slope * (x_min + i * ((x_max - x_min) / 99)), 6) AS fitted
FROM lines, range(0, 100) AS g(i)""")
def fit_line(spark, sf_dir):
    """G7."""
    return r6(G.fit_line(G.ols(_day_pairs(spark, sf_dir, [0]), pvalue=False)))


_GRID = ", ".join(f"round(max(pearson) FILTER (lag = {k}), 6) AS \"{k}\"" for k in K.DAILY_LAGS)


@query(f"""WITH {_DAY_PAIRED}, {_stats_sql('pairs', 'party, lag', 3, ['vader_avg'])}
SELECT party, {_GRID} FROM stats GROUP BY party""")
def corr_lag_grid(spark, sf_dir):
    """Groups down, lags across."""
    return r6(R.corr_grid(R.corr_table(_day_pairs(spark, sf_dir)), "lag", "vader_avg_pear", K.DAILY_LAGS))


_MODELS = ", ".join(f"round(max(pearson) FILTER (measure = '{m}'), 6) AS {m}" for m in K.MEASURES)


@query(f"{_TALL} SELECT party, {_MODELS} FROM stats GROUP BY party")
def corr_model_grid(spark, sf_dir):
    """Groups down, measures across."""
    return r6(R.corr_grid(R.corr_long(_day_pairs(spark, sf_dir, [0])), "measure", "pearson", K.MEASURES))


@query(f"""{_TALL} SELECT party, measure, round(pearson, 6) AS pearson, round(spearman, 6) AS spearman, n,
  round(least(abs(pearson), 1.0), 6) AS strength FROM stats""")
def corr_strength(spark, sf_dir):
    """Colour strength of each correlation cell."""
    return r6(V.cell_strength(R.corr_long(_day_pairs(spark, sf_dir, [0])), "pearson"))


# ---------------------------------------------------------------- summary, order, samples

_SUMMARY = """facts AS (
  SELECT CAST((SELECT sum(comment_volume) FROM daily) AS BIGINT) AS targeted_rows,
    (SELECT min(date) FROM daily) AS first_date, (SELECT max(date) FROM daily) AS last_date,
    (SELECT count(DISTINCT date) FROM daily) AS daily_buckets,
    (SELECT min(week) FROM weekly) AS first_week, (SELECT max(week) FROM weekly) AS last_week)"""


def _facts(spark, sf_dir):
    return A.summary_of(U.rollup_both(X.scored_events(spark, sf_dir)))


@query(f"WITH {X.SCORED}, {_DAILY}, {_WEEKLY}, {_SUMMARY} SELECT * FROM facts")
def corpus_summary(spark, sf_dir):
    """D5."""
    return _facts(spark, sf_dir)


@query(f"""WITH {X.SCORED}, {_DAILY}
SELECT party, min(date) AS first, max(date) AS last, count(*) AS points FROM daily GROUP BY party""")
def series_extent(spark, sf_dir):
    """D8."""
    return A.extent(_daily(spark, sf_dir), "date")


@query(f"""WITH {X.SCORED}, {_DAILY}
SELECT party, date, {_ROUNDED} FROM daily ORDER BY party, date LIMIT 50""")
def head_rows(spark, sf_dir):
    """H3: first rows of the ordered series."""
    return r6(S.head(_daily(spark, sf_dir), ["party", "date"]))


@query(f"""WITH {X.SCORED}, {_DAILY}
SELECT party, date, {_ROUNDED} FROM daily WHERE party = 'purchase' AND date <= DATE '2024-01-20'""")
def clip_group(spark, sf_dir):
    """One group's series up to a day, in time order."""
    one = V.for_group(_daily(spark, sf_dir), "purchase")
    return r6(V.clip(one, "date", "2024-01-20").orderBy("date"))


@query("""SELECT doc_id, source FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(concat(doc_id, '/7')), doc_id) AS i FROM documents)
WHERE i <= 10""")
def sample_per_group(spark, sf_dir):
    """H4 per group, B20: a fixed draw of ten rows of each language."""
    rows = S.sample_n(X.table(spark, sf_dir, "documents"), 10, "doc_id", seed=7, by="lang")
    return V.select_existing(rows, ["doc_id", "source", "no_such_column"])


@query("SELECT doc_id, lang FROM documents ORDER BY md5(concat(doc_id, '/3')), doc_id LIMIT 25")
def sample_rows(spark, sf_dir):
    """H4 over the whole table."""
    return S.sample_n(X.table(spark, sf_dir, "documents").select("doc_id", "lang"), 25, "doc_id", seed=3)


_SHARE = "CAST(CAST(concat('0x', substr(md5(concat(event_id, '/1')), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0"


@query(f"SELECT event_id, event_type FROM events WHERE {_SHARE} < 0.001")
def sample_share(spark, sf_dir):
    """H5: a fixed 0.1% draw."""
    return S.sample_fraction(X.table(spark, sf_dir, "events"), 0.001, "event_id", seed=1).select("event_id", "event_type")


@query(f"SELECT count(*) AS scanned, count(*) FILTER ({_SHARE} < 0.001) AS kept FROM events")
def audit_sample(spark, sf_dir):
    """D4 for the sample."""
    rows = S.flag_sampled(X.table(spark, sf_dir, "events"), 0.001, "event_id", seed=1)
    return A.audit(rows, [F.count(F.lit(1)).alias("scanned"), F.count_if("kept").alias("kept")])


# ---------------------------------------------------------------- views and publishing


def _view_sql(side: str, series: str, polls: str, key: str, axis: str, label: str, where: str) -> str:
    return f"""WITH {side}
SELECT party, {axis} AS x_axis, {label} AS label, round(vader_avg, 6) AS vader_avg,
  round(trans_pos_ratio, 6) AS trans_pos_ratio, round(poll, 6) AS poll, comment_volume AS volume
FROM {series} LEFT JOIN {polls} USING (party, {key}) WHERE {where}"""


@query(_view_sql(
    _WEEK_SIDE, "weekly", "week_polls", "week", "DATE '2024-01-01' + (week - 1) * 7",
    "concat('Week ', week)", "week <= 4"))
def weekly_view(spark, sf_dir):
    """C5 with clip, axis date and label."""
    return r6(V.weekly_view(_weekly(spark, sf_dir), _week_polls(spark, sf_dir), 4, "2024-01-01"))


@query(_view_sql(
    _DAY_SIDE, "daily", "day_polls", "date", "date", "CAST(date AS VARCHAR)", "date <= DATE '2024-01-25'"))
def daily_view(spark, sf_dir):
    return r6(V.daily_view(_daily(spark, sf_dir), _day_polls(spark, sf_dir), "2024-01-25"))


@query(f"""WITH {X.SCORED}, {_DAILY}
SELECT party, min(date) AS first, max(date) AS last,
  DATE '2024-01-31' BETWEEN min(date) - 1 AND max(date) + 1 AS shown FROM daily GROUP BY party""")
def event_marker(spark, sf_dir):
    """Whether an event day lies in a drawn series."""
    return V.event_marker(V.daily_view(_daily(spark, sf_dir), _day_polls(spark, sf_dir), None), "2024-01-31")


def _published(key: str, key_sql: str) -> str:
    return f"""party, {key_sql} AS {key}, round(vader_avg, 4) AS "vaderAvg", round(trans_pos_ratio, 4) AS "transPosRatio",
  round(trans_neg_ratio, 4) AS "transNegRatio", round(trans_neu_ratio, 4) AS "transNeuRatio",
  comment_volume AS "commentVolume" """


@query(f"WITH {X.SCORED}, {_WEEKLY} SELECT {_published('week', 'week')} FROM weekly")
def publish_weekly(spark, sf_dir):
    """A10."""
    return W.publish(_weekly(spark, sf_dir), "weekly")


@query(f"WITH {X.SCORED}, {_DAILY} SELECT {_published('date', 'CAST(date AS VARCHAR)')} FROM daily")
def publish_daily(spark, sf_dir):
    return W.publish(_daily(spark, sf_dir), "daily")


@query(f"""WITH {X.POLLS}, {_POLL_WEEKLY}
SELECT week, round(lpc, 2) AS lpc, round(cpc, 2) AS cpc, round(ndp, 2) AS ndp, round(oth, 2) AS oth FROM poll_weekly""")
def publish_poll_weekly(spark, sf_dir):
    return W.publish(P.poll_weekly(X.event_polls(spark, sf_dir)), "poll_weekly")


@query(f"""WITH {X.POLLS}, {_POLL_DAILY}
SELECT CAST(date AS VARCHAR) AS date, round(lpc, 2) AS lpc, round(cpc, 2) AS cpc, round(ndp, 2) AS ndp,
  round(oth, 2) AS oth, freq, week FROM poll_daily""")
def publish_poll_daily(spark, sf_dir):
    return W.publish(P.poll_daily(X.event_polls(spark, sf_dir)), "poll_daily")


_PUBLISHED_CORR = ", ".join(
    f"round(max({col}) FILTER (measure = '{m}'), 4) AS \"{name}{label}\""
    for m, name in zip(K.MEASURES, ("vader", "trans"))
    for col, label in (("pearson", "Pearson"), ("spearman", "Spearman"))
) + ", " + ", ".join(
    f"max(n) FILTER (measure = '{m}') AS \"{name}N\"" for m, name in zip(K.MEASURES, ("vader", "trans"))
)


@query(f"""WITH {_DAY_PAIRED}, {_stats_sql('pairs', 'party, lag', 3, K.MEASURES)}
SELECT party, CAST(lag AS INTEGER) AS lag, {_PUBLISHED_CORR} FROM stats GROUP BY party, lag""")
def publish_correlations(spark, sf_dir):
    return W.publish(R.corr_table(_day_pairs(spark, sf_dir)), "correlations")


@query("""SELECT l_orderkey, l_linenumber,
  CASE WHEN x >= 1000000000 THEN concat(format('{:.2f}', CASE WHEN x % 125000000 = 0 THEN round(x / 1e9, 2) ELSE x / 1e9 END), 'B')
    WHEN x >= 1000000 THEN concat(format('{:.2f}', CASE WHEN x % 125000 = 0 THEN round(x / 1e6, 2) ELSE x / 1e6 END), 'M')
    ELSE format('{:,}', x) END AS compact
FROM (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) * l_partkey AS x FROM lineitem)""")
def compact_numbers(spark, sf_dir):
    """Short texts for large counts."""
    big = F.floor("l_extendedprice") * F.col("l_partkey")
    return X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", compact_number(big).alias("compact")
    )


@query(f"""WITH {X.SCORED}, {_DAILY}, {_WEEKLY}, {_SUMMARY}
SELECT CASE WHEN targeted_rows >= 1000000 THEN concat(format('{{:.2f}}', targeted_rows / 1e6), 'M')
  ELSE format('{{:,}}', targeted_rows) END AS targeted_rows, concat(last_week, ' weeks') AS weeks FROM facts""")
def stat_cards(spark, sf_dir):
    return V.stat_cards(_facts(spark, sf_dir))


@query("""SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value FROM events""")
def union_parts_by_name(spark, sf_dir):
    """Parts with different columns and column order, stacked by name."""
    events = X.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    clicks = events.filter("event_type = 'click'").select("event_type", "event_id")
    return union_parts(events.filter("event_type <> 'click'"), clicks)


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
  CASE o_orderstatus WHEN 'O' THEN NULL ELSE o_custkey END AS week, o_orderpriority AS party FROM orders""")
def coerce_series_types(spark, sf_dir):
    """A4: text columns to dates and whole numbers, bad cells to null."""
    status = F.col("o_orderstatus")
    rows = X.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "P", "soon").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date"),
        F.when(status == "O", "w?").otherwise(F.col("o_custkey").cast("string")).alias("week"),
        F.col("o_orderpriority").alias("party"),
    )
    return coerce_series(rows, "date", ["week"])


@query("""SELECT concat('{"o_orderkey":', o_orderkey, ',"o_orderstatus":',
  CASE o_orderstatus WHEN 'P' THEN 'null' ELSE concat('"', o_orderstatus, '"') END,
  ',"o_custkey":', o_custkey, '}') AS value FROM orders""")
def json_lines(spark, sf_dir):
    """Rows as the JSON text that is written, nulls spelled out."""
    orders = X.table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus")
    return to_json_lines(orders.select("o_orderkey", status, "o_custkey"))


@query("""SELECT lang, count(*) AS volume, CAST(sum(CASE WHEN source = 'src1' THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  round(sum(CASE WHEN source = 'src1' THEN 1 ELSE 0 END) / CAST(nullif(sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END), 0) AS DOUBLE), 6) AS share
FROM documents GROUP BY lang""")
def ratio_of_nothing(spark, sf_dir):
    """A ratio whose whole may be zero."""
    rows = X.table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("volume"), F.count_if(F.col("source") == "src1").alias("hits"),
        F.count_if(F.col("lang") == "en").alias("_whole"),
    )
    return r6(rows.select("lang", "volume", "hits", ratio(F.col("hits"), F.col("_whole")).alias("share")))


# ---------------------------------------------------------------- chains

_TITLED = """joined AS (
  SELECT c.*, coalesce(s.title, '') AS title
  FROM comments c LEFT JOIN (SELECT * FROM submissions WHERE id <> '') s ON c.link_id_short = s.id
  WHERE link_id_short <> '')"""
_RAW_KEPT = _RECORDS.format(lines="comment_lines")
# The first pass keeps untrimmed communities only, so padded ones are gone before cleaning.
_CHAIN = f"""{X.COMMENT_LINES}, {_RAW_KEPT}, {_FLAGGED}, {X.SUBMISSION_LINES},
parsed_kept AS (SELECT p.value, p.j FROM parsed p JOIN (SELECT DISTINCT value FROM flagged WHERE kept) USING (value)),
{_CLEAN_COMMENTS.replace('FROM parsed WHERE', 'FROM parsed_kept WHERE')},
{_CLEAN_SUBMISSIONS.replace("WHERE j IS NOT NULL", f"WHERE lower({_text('subreddit')}) IN {_members(K.COMMUNITIES)} AND j IS NOT NULL")},
{_TITLED}"""


def _joined(spark, sf_dir):
    return titled_comments(X.comment_lines(spark, sf_dir), X.submission_lines(spark, sf_dir))


@query(f"WITH {_CHAIN} SELECT * FROM joined")
def dump_to_titled(spark, sf_dir):
    """K1: raw lines of both kinds to titled comments."""
    return _joined(spark, sf_dir)


_CHAIN_TARGETED = f"""{_CHAIN}, texts AS (
  SELECT id, concat_ws(' ', title, body) AS full_text, created_utc FROM joined),
{_targeted_sql('texts', 'id, created_utc', 'full_text', K.GROUP_KEYWORDS)}"""


@query(f"""WITH {_CHAIN_TARGETED}
SELECT id, party, targeted_sentence, CAST(epoch_ms(created_utc * 1000) AS DATE) AS date,
  CAST(week(CAST(epoch_ms(created_utc * 1000) AS DATE)) AS INTEGER) AS week FROM hits""")
def titled_to_targeted(spark, sf_dir):
    """K1 then E1: the fixed group keywords over titled comments, dated."""
    return targeted_comments(_joined(spark, sf_dir)).select("id", "party", "targeted_sentence", "date", "week")


def _chain_scored(spark, sf_dir):
    words = spark.createDataFrame(
        [("right-wing", -1.2), ("lost", -1.3), ("speaks", 0.8), ("liberals", 0.5)], "word string, valence double")
    return series_rows(
        _joined(spark, sf_dir), words, lambda rows, text: C.classify(rows, text, load_tail_model)
    )


def load_tail_model():
    """A stand-in model that reads one word."""
    def scores(texts):
        return np.array([[float("lost" in t), 0.5, float("speaks" in t)] for t in texts])
    return scores


_CHAIN_SCORED = f"""{_CHAIN_TARGETED},
scored AS (
  SELECT party, CAST(epoch_ms(created_utc * 1000) AS DATE) AS date,
    CAST(week(CAST(epoch_ms(created_utc * 1000) AS DATE)) AS INTEGER) AS week,
    CASE WHEN contains(targeted_sentence, 'lost') THEN 0 WHEN contains(targeted_sentence, 'speaks') THEN 2 ELSE 1 END AS trans_sentiment,
    coalesce(round(s / sqrt(s * s + 15), 4), 0.0) AS vader_score
  FROM (SELECT *,
      -- "so" strengthens a hit one to three words on, more weakly the farther it is.
      CAST(CASE WHEN contains(targeted_sentence, 'right-wing')
          THEN (-1.2 - 0.293 * 0.95) + -1.3 ELSE 0 END
        + CASE WHEN contains(targeted_sentence, 'speaks') THEN 0.8 ELSE 0 END
        + CASE WHEN contains(targeted_sentence, 'liberals') THEN 0.5 ELSE 0 END AS DOUBLE) AS s
    FROM hits))"""


@query(f"WITH {_CHAIN_SCORED}, {_DAILY} SELECT party, date, {_ROUNDED} FROM daily")
def dump_to_series(spark, sf_dir):
    """Raw lines all the way to the daily series."""
    return r6(U.rollup(_chain_scored(spark, sf_dir), ["party", "date"], COPIES))
