"""Chains that store a grain once, and scorers that have two ways to the same result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.operators import classify as C
from voxseries.operators import lexicon as L
from voxseries.operators.correlate import corr_long
from voxseries.operators.joins import lagged_pairs, lagged_pairs_years
from voxseries.operators.rollup import rollup
from voxseries.plans import standins as X
from voxseries.plans.analysis import analyse_scored, tall_tables
from voxseries.plans.views import views_of_scored

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_all_tables_come_from_one_scan_of_the_rows(spark):
    tables = analyse_scored(X.scored_events(spark, SF), X.event_polls(spark, SF), mapping=X.POLL_COLUMNS)
    assert len(tables) == 14
    assert not any("events.parquet" in plan(t) for t in tables.values())
    assert {r["table"] for r in tall_tables(tables).select("table").distinct().collect()} == set(tables)
    views = views_of_scored(X.scored_events(spark, SF), X.event_polls(spark, SF), mapping=X.POLL_COLUMNS)
    assert not any("events.parquet" in plan(v) for v in views.values())


def test_scored_rows_are_read_once(spark):
    """An accumulator in the rows counts each of them once, however many tables are made."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = X.scored_events(spark, SF).withColumn("vader_score", counted("vader_score"))
    tables = analyse_scored(rows, X.event_polls(spark, SF), mapping=X.POLL_COLUMNS)
    for t in tables.values():
        t.collect()
    assert seen.value == rows.filter("party IS NOT NULL").drop("vader_score").count()


def test_same_day_tables_without_lag_zero(spark):
    day = dt.date(2025, 1, 1)
    scored = spark.createDataFrame([("a", day + dt.timedelta(i), 1 + i // 7, float(i % 5), i % 3) for i in range(12)],
                                   "party string, date date, week int, vader_score double, trans_sentiment int")
    polls = spark.createDataFrame([(day + dt.timedelta(i), 1.0 * (i * i % 7), None, "daily", 1) for i in range(12)],
                                  "date date, lpc double, cpc double, freq string, week int")
    tables = analyse_scored(scored, polls, mapping={"a": "lpc", "b": "cpc"}, daily_lags=[2, 3], weekly_lags=[1])
    assert {r.lag for r in tables["daily_corr"].collect()} == {2, 3}
    assert {r.measure: r.n for r in tables["daily_corr_by_model"].collect()} == {m: 12 for m in K.MEASURES}
    assert tables["daily_lag_grid_vader_avg"].columns == ["party", "2", "3"]


def test_weeks_of_different_years_stay_apart(spark):
    days = [dt.date(2020, 12, 21) + dt.timedelta(7 * i) for i in range(5)]  # 2020-W52, W53, 2021-W01 ...
    scored = spark.createDataFrame([("a", d, 0.1 * i, 2) for i, d in enumerate(days)],
                                   "party string, date date, vader_score double, trans_sentiment int").select(
        "*", F.extract(F.lit("YEAROFWEEK"), F.col("date")).alias("iso_year"), F.weekofyear("date").alias("week"))
    series = rollup(scored, ["party", "iso_year", "week"])
    polls = series.select("party", "iso_year", "week", F.col("vader_avg").alias("poll"))
    got = {(r.iso_year, r.week, r.lag): round(r.poll, 6) for r in lagged_pairs_years(series, polls, [0, 1]).collect()}
    weeks = [(d.isocalendar().year, d.isocalendar().week) for d in days]
    assert got == {(*w, 0): round(0.1 * i, 6) for i, w in enumerate(weeks)} | {
        (*weeks[i], 1): round(0.1 * (i - 1), 6) for i in range(1, 5)}
    # By week number alone the first week of the new year finds no week before it.
    plain = lagged_pairs(series, polls.drop("iso_year"), "week", [1])
    assert {r.week for r in plain.collect()} == {53, 2, 3}


def test_large_lexicon_is_joined_with_the_same_result(spark, monkeypatch):
    words = spark.createDataFrame(list(X.RULE_LEXICON.items()), "word string, valence double")
    texts = X.rule_texts(spark, SF).unionByName(spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "good " * 3000), (-4, "but but no good"), (-5, "good"), (-6, "xx yy")], "o_orderkey long, text string"))
    inside = {r.o_orderkey: r.vader_score for r in L.lexicon_score(texts, "text", words, ["o_orderkey"]).collect()}
    monkeypatch.setattr(L, "LITERAL", 1)
    joined = {r.o_orderkey: r.vader_score for r in L.lexicon_score(texts, "text", words, ["o_orderkey"]).collect()}
    assert inside == joined and len(inside) == 1506
    assert inside[-1] == inside[-2] == inside[-6] == 0.0


def test_only_hits_leave_their_row(spark):
    df = spark.createDataFrame([(1, "a b good c bad"), (2, "a"), (3, None)], "k int, t string")
    rows = L.hit_contexts(df, "t", ["k"], ["good", "bad"]).orderBy("k", "pos").collect()
    assert [(r.k, r.w, r.p1, r.n1) for r in rows] == [
        (1, "good", "b", "c"), (1, "bad", "c", None), (1, "", None, None), (2, "", None, None), (3, "", None, None)]


def test_linear_scorer_agrees_with_the_model(spark):
    rows = [(i, ("good fine", "so so", "bad awful")[i % 3] + f" w{i % 5} w{i % 7}", i % 3) for i in range(60)]
    train = spark.createDataFrame(rows, "id int, text string, label int")
    model = C.train_linear(train, "text", "label")
    weights, intercepts = C.linear_weights(model)
    odd = train.select("id", "text").union(spark.createDataFrame(
        [(100, None), (101, "  "), (102, "unknown words"), (103, "bad " * 400)], "id int, text string"))
    want = {r.id: int(r.prediction) for r in model.transform(C._tokens(odd, "text", None)).collect()}
    want |= {100: K.NEUTRAL, 101: K.NEUTRAL}
    got = C.classify_linear(odd, "text", weights, intercepts, ["id"])
    assert {r.id: r.trans_sentiment for r in got.collect()} == want
    assert C.classify_linear(odd.limit(0), "text", weights, intercepts, ["id"]).count() == 0


def test_linear_scorer_trims_a_text_once(spark):
    """A text that went through the explode with its words would be copied and trimmed for each of them."""
    rows = spark.createDataFrame(
        [(1, "que " + "is " * 5000), (2, "is " + "que " * 5000), (3, "\u3000 \t"), (4, None), (None, "is"), (None, "is"), (None, "")], "id int, body string")
    got = C.classify_linear(rows, "body", X.weights(spark), X.INTERCEPTS, ["id"])
    exploded = [line for line in got._jdf.queryExecution().sparkPlan().toString().splitlines() if "Generate " in line]
    assert len(exploded) == 1 and "id#" in exploded[0] and "body#" not in exploded[0]
    # Rows of one key are one row, but for the blank ones.
    assert sorted((r.id or 0, r.trans_sentiment) for r in got.collect()) == [(0, 1), (0, 2), (1, 2), (2, 0), (3, 1), (4, 1)]


def test_worker_keeps_the_latest_model():
    made = []
    for name in ("a", "a", "b", "a"):
        C.kept_model(name, lambda: made.append(name) or len)
    assert made == ["a", "b", "a"]


def test_large_groups_with_constants_and_null_groups(spark):
    rows = [(g, 5.0 if g == "const" else float(i % 50), float((i * 7) % 31)) for g in ("a", None, "const") for i in range(400)]
    rows += [("few", 1.0, None), ("few", None, 2.0)]
    df = spark.createDataFrame(rows, "party string, level double, poll double")
    got, want = ({(r.party, r.measure): r for r in corr_long(df, measures=["level"], large_groups=large).collect()} for large in (True, False))
    assert set(got) == set(want) and len(got) == 4
    for key, r in got.items():
        assert r.n == want[key].n
        for c in ("pearson", "spearman"):
            assert r[c] == (None if want[key][c] is None else pytest.approx(want[key][c], abs=1e-10))
    assert got["const", "level"].spearman is None and got["few", "level"].n == 0
