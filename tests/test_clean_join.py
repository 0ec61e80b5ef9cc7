import json

import pytest

from voxseries.operators.audit import audit, match_counts, observed, raw_counts
from voxseries.operators.clean import (
    clean_comments, clean_submissions, drop_placeholders, filter_raw, flag_raw, require_keys,
)
from voxseries.operators.joins import attach_titles, flag_matches

GOOD = {
    "id": "c1", "link_id": "t3_s1", "parent_id": "t1_x", "subreddit": " Canada ", "author": " ann ",
    "created_utc": 1735689600.9, "score": "5", "body": " hello ", "permalink": " /r/x ", "extra": [1],
}


def lines(spark, *records):
    texts = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


def test_clean_comment(spark):
    row = clean_comments(lines(spark, GOOD)).first().asDict()
    assert row == {
        "id": "c1", "link_id_short": "s1", "parent_id": "t1_x", "subreddit": "canada", "author": "ann",
        "created_utc": 1735689600, "score": 5, "body": "hello", "permalink": "/r/x",
    }


def test_unusable_lines_drop(spark):
    bad = ["{bad", "[1]", "3", "", "null", without("permalink"), GOOD | {"subreddit": "other"},
           GOOD | {"subreddit": "  "}, GOOD | {"body": " [deleted] "}, GOOD | {"created_utc": "x"},
           GOOD | {"created_utc": None}]
    assert clean_comments(lines(spark, *bad)).count() == 0
    assert clean_comments(lines(spark, *bad), legacy_none=True).count() == 0
    trailing = json.dumps(GOOD) + " x"
    assert clean_comments(lines(spark, trailing)).count() == 0
    assert flag_raw(lines(spark, trailing.replace(" Canada ", "canada"))).first().bad


def test_invalid_bytes_are_bad(spark):
    raw = spark.createDataFrame([(b'{"subreddit":"ndp","body":"a\xff"}',)], "b binary")
    raw = raw.selectExpr("cast(b as string) as value")
    flags = flag_raw(raw).first()
    assert flags.bad and not flags.kept


def test_null_community(spark):
    record = GOOD | {"subreddit": None}
    assert clean_comments(lines(spark, record), ["none"], legacy_none=True).count() == 1
    assert clean_comments(lines(spark, record), ["none"]).count() == 0


def test_null_body_and_key(spark):
    assert clean_comments(lines(spark, GOOD | {"body": None})).count() == 0
    kept = clean_comments(lines(spark, GOOD | {"body": None, "author": None}), legacy_none=True).first()
    assert (kept.body, kept.author) == ("None", "None")
    assert require_keys(lines(spark, GOOD | {"body": None}), ["id", "body"]).count() == 1
    assert clean_comments(lines(spark, GOOD | {"author": True, "permalink": "true"})).first().author == "True"
    assert clean_comments(lines(spark, GOOD | {"permalink": "true"})).first().permalink == "true"


def test_repeated_key_keeps_last(spark):
    line = json.dumps(GOOD)[:-1] + ', "id": "c2"}'
    assert clean_comments(lines(spark, line)).first().id == "c2"


def test_clean_submission(spark):
    rows = clean_submissions(lines(
        spark, {"id": "s1", "subreddit": "NDP", "title": " [removed] "}, {"id": "s2", "subreddit": "ndp"},
        {"id": 7, "subreddit": "ndp", "title": None},
    )).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("7", "ndp", None), ("s1", "ndp", "[removed]")]


def test_first_filter_and_counts(spark):
    raw = lines(
        spark, GOOD | {"subreddit": "Canada"}, GOOD, {"subreddit": "ndp"}, {"body": "x"}, "{bad", "[1]",
        {"subreddit": "ndp", "body": None}, {"subreddit": "ndp", "body": "[removed]"},
    )
    flagged = flag_raw(raw)
    assert audit(flagged, raw_counts()).first().asDict() == {"seen": 8, "kept": 2, "bad": 2}
    texts = [r.value for r in filter_raw(raw).collect()]
    assert json.dumps(GOOD | {"subreddit": "Canada"}, ensure_ascii=False) in texts and len(texts) == 2
    assert filter_raw(raw, text_key=None).count() == 4
    watched, seen = observed(flagged, raw_counts(), "t")
    assert watched.filter("kept").count() == 2
    assert seen.get == {"seen": 8, "kept": 2, "bad": 2}


def test_each_line_is_read_once(spark):
    """One read in the generator; the whole-record parses sit in branches for odd rows."""
    plan = clean_comments(lines(spark, GOOD))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("Generate inline(array(from_json") == 1


def test_placeholders(spark):
    df = lines(spark, " [deleted] ", "[DELETED]", "  ", "ok")
    assert {r.value for r in drop_placeholders(df, "value").collect()} == {"[DELETED]", "ok"}


@pytest.fixture
def tables(spark):
    comments = spark.createDataFrame(
        [("c1", "s1"), ("c2", "s1"), ("c3", "s9"), ("c4", ""), ("c5", None), ("c6", "s2")],
        "id string, link_id_short string")
    submissions = spark.createDataFrame(
        [("s1", " a "), ("s2", "b"), ("s2", "b2"), ("", "blank"), (None, "none")], "id string, title string")
    return comments, submissions


def test_titles(tables):
    rows = sorted(tuple(r) for r in attach_titles(*tables).collect())
    assert rows == [("c1", "s1", "a"), ("c2", "s1", "a"), ("c3", "s9", ""), ("c6", "s2", "b"), ("c6", "s2", "b2")]
    salted = sorted(tuple(r) for r in attach_titles(*tables, salt=5).collect())
    assert salted == rows
    assert attach_titles(*tables, dedupe=True).count() == 4


def test_match_counts_add_up(tables):
    flagged = flag_matches(*tables, dedupe=True)
    counts = audit(flagged, match_counts()).first()
    assert (counts.inputs, counts.matched, counts.unmatched) == (4, 3, 1)


def test_titles_without_broadcast(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(tuple(r) for r in attach_titles(*tables).collect())
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert sorted(tuple(r) for r in attach_titles(*tables).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
