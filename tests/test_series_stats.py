import datetime as dt

import numpy as np
import pandas as pd
import pytest
from golden import CORRELATIONS, POLLS, REGRESSIONS, WEEKLY, rows
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.operators import correlate as R
from voxseries.operators import joins as J
from voxseries.operators.audit import extent, summary
from voxseries.operators.polls import poll_daily, poll_weekly
from voxseries.operators.regress import fit_line, ols
from voxseries.operators.rollup import in_order, rollup, rollup_both
from voxseries.plans.analysis import analyse, split_grains
from voxseries.sources.publish import publish


@pytest.fixture(scope="module")
def weekly(spark):
    data = [(p, int(w), float(v), int(a) / int(n)) for p, w, v, a, n in rows(WEEKLY)]
    return spark.createDataFrame(data, "party string, week int, vader_avg double, trans_pos_ratio double")


@pytest.fixture(scope="module")
def week_polls(spark):
    data = [(int(w), *map(float, v)) for w, *v in rows(POLLS)]
    return spark.createDataFrame(data, "week int, lpc double, cpc double, ndp double")


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def test_published_weekly_correlations(weekly, week_polls):
    series = rounded(weekly, 4, *K.MEASURES)
    polls = J.polls_long(rounded(week_polls, 2, "lpc", "cpc", "ndp"), ["week"])
    table = R.corr_table(J.lagged_pairs(series, polls, "week", K.WEEKLY_LAGS))
    got = {(r.party, r.lag): r for r in publish(table, "correlations").collect()}
    assert len(got) == 6
    for party, lag, vp, vs, tp, ts in rows(CORRELATIONS):
        r = got[party, int(lag)]
        assert (r.vaderPearson, r.vaderSpearman, r.transPearson, r.transSpearman) == (
            float(vp), float(vs), float(tp), float(ts))
        assert r.vaderN == r.transN == 17


def test_weekly_regressions(weekly, week_polls):
    pairs = J.lagged_pairs(weekly, J.polls_long(week_polls, ["week"]), "week", [0])
    got = {(r.party, r.measure): r for r in ols(pairs).collect()}
    assert len(got) == 6
    for party, measure, *want in rows(REGRESSIONS):
        r, (slope, intercept, t, p, r2) = got[party, measure], map(float, want)
        assert r.n == 17
        assert (r.slope, r.intercept) == pytest.approx((slope, intercept), rel=1e-6)
        assert (r.t, r.r2) == pytest.approx((t, r2), abs=1e-4)
        assert r.p == pytest.approx(p, rel=2e-2, abs=1e-4)


def test_lag_pairs(spark):
    s = spark.createDataFrame([("NDP", w, 1.0) for w in range(1, 19)], "party string, week int, vader_avg double")
    p = spark.createDataFrame([("NDP", w, float(w)) for w in range(1, 18)], "party string, week int, poll double")
    pairs = J.lagged_pairs(s, p, "week", [1]).collect()
    assert sorted((r.week, r.poll) for r in pairs) == [(w, w - 1.0) for w in range(2, 19)]
    plain = J.lagged_pairs(s, p, "week", [0]).drop("lag")
    assert plain.exceptAll(s.join(p, ["party", "week"])).count() == 0 and plain.count() == 17


def test_lag_moves_dates(spark):
    day = dt.date(2025, 2, 27)
    s = spark.createDataFrame([("NDP", dt.date(2025, 3, 4), 1.0)], "party string, date date, vader_avg double")
    p = spark.createDataFrame([("NDP", day, 9.0)], "party string, date date, poll double")
    assert [(r.lag, r.poll) for r in J.lagged_pairs(s, p, "date", range(6)).collect()] == [(5, 9.0)]


def pair_frame(spark, data):
    return spark.createDataFrame(data, "party string, lag int, vader_avg double, trans_pos_ratio double, poll double")


@pytest.mark.parametrize("large", [False, True])
def test_degenerate_groups(spark, large):
    df = pair_frame(spark, (
        [("const", 0, 1.0, float(i), float(i)) for i in range(6)]
        + [("few", 0, float(i), None, float(i)) for i in range(2)]
        + [("ties", 0, x, None, y) for x, y in zip([1.0, 2.0, 2.0, 3.0], [1.0, 2.0, 3.0, 4.0])]
    ))
    got = {r.party: r for r in R.corr_table(df, large_groups=large).collect()}
    assert got["const"].vader_avg_pear is None and got["const"].vader_avg_spear is None
    assert got["const"].trans_pos_ratio_pear == pytest.approx(1.0)
    assert got["few"].vader_avg_pear is None and got["few"].vader_avg_n == 2 and got["few"].trans_pos_ratio_n == 0
    assert got["ties"].vader_avg_spear == pytest.approx(0.9486832980505138)


@pytest.mark.parametrize("large", [False, True])
def test_against_pandas(spark, large):
    rng = np.random.default_rng(3)
    n = 3000
    frame = pd.DataFrame({
        # One group holds most rows.
        "party": rng.choice(["a", "b", "c"], n, p=[0.8, 0.15, 0.05]),
        "lag": rng.integers(0, 2, n), "vader_avg": np.round(rng.normal(size=n), 1),
        "trans_pos_ratio": rng.exponential(size=n), "poll": rng.integers(0, 40, n) / 1.0,
    })
    frame.loc[rng.random(n) < 0.1, "vader_avg"] = np.nan
    df = pair_frame(spark, [tuple(None if v != v else v for v in r) for r in frame.astype(object).itertuples(index=False)])
    got = {(r.party, r.lag, r.measure): r for r in R.corr_long(df, ["party", "lag"], large_groups=large).collect()}
    assert len(got) == 12
    for (party, lag), g in frame.groupby(["party", "lag"]):
        for m in K.MEASURES:
            c = g[[m, "poll"]].dropna()
            ranks = c.rank()
            r = got[party, lag, m]
            assert r.n == len(c)
            assert r.pearson == pytest.approx(c[m].corr(c["poll"]), abs=1e-10)
            assert r.spearman == pytest.approx(ranks[m].corr(ranks["poll"]), abs=1e-10)


def test_missing_measure_is_null(spark):
    df = pair_frame(spark, [("a", 0, float(i), 1.0, float(i * i)) for i in range(6)]).drop("trans_pos_ratio")
    got = {r.measure: r for r in R.corr_long(df).collect()}
    assert got["trans_pos_ratio"].pearson is None and got["trans_pos_ratio"].n == 0
    assert got["vader_avg"].pearson is not None


def test_ranks_share_one_shuffle(spark):
    df = pair_frame(spark, [("a", 0, 1.0, 1.0, 1.0)])
    plan = R.pair_stats(R.measures_long(df, ["party", "lag"]), ["party", "lag"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_grids(spark):
    table = spark.createDataFrame([("a", 0, 0.5), ("a", 1, None), ("b", 1, -0.25)], "party string, lag int, r double")
    got = {r.party: (r["0"], r["1"]) for r in R.corr_grid(table, "lag", "r", [0, 1]).collect()}
    assert got == {"a": (0.5, None), "b": (None, -0.25)}


def test_regression_edges(spark):
    df = pair_frame(spark, (
        [("few", 0, float(i), None, float(i)) for i in range(4)]
        + [("const", 0, 2.0, None, float(i)) for i in range(6)]
        + [("exact", 0, float(i), None, 3.0 + 2.0 * i) for i in range(6)]
    ))
    got = {(r.party, r.measure): r for r in ols(df).collect()}
    assert set(got) == {("const", "vader_avg"), ("exact", "vader_avg")}
    assert got["const", "vader_avg"].slope is None and got["const", "vader_avg"].p is None
    exact = got["exact", "vader_avg"]
    assert (exact.slope, exact.intercept, exact.r2) == pytest.approx((2.0, 3.0, 1.0))
    line = fit_line(ols(df).filter("party = 'exact'")).orderBy("point").collect()
    assert len(line) == 100 and (line[0].x, line[99].x) == pytest.approx((0.0, 5.0))
    assert line[99].fitted == pytest.approx(13.0)


SCORED = [
    ("a", dt.date(2025, 1, 6), 2, 0.5, 2), ("a", dt.date(2025, 1, 6), 2, -0.1, 0), ("a", dt.date(2025, 1, 7), 2, 0.2, None),
    ("a", dt.date(2025, 1, 14), 3, None, 1), ("b", dt.date(2025, 1, 14), 3, 0.4215, None), (None, dt.date(2025, 1, 6), 2, 1.0, 2),
]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(SCORED, "party string, date date, week int, vader_score double, trans_sentiment int")


def test_rollup(scored):
    got = {(r.party, r.week): r for r in rollup(scored, ["party", "week"]).collect()}
    assert set(got) == {("a", 2), ("a", 3), ("b", 3)}
    a2, b3 = got["a", 2], got["b", 3]
    assert a2.vader_avg == pytest.approx(0.2) and (a2.pos_count, a2.neg_count, a2.neu_count) == (1, 1, 0)
    assert (a2.comment_volume, a2.total, a2.trans_pos_ratio) == (3, 2, 0.5)
    assert got["a", 3].vader_avg is None and got["a", 3].trans_neu_ratio == 1.0
    assert b3.vader_avg == 0.4215 and b3.total == 0 and b3.trans_pos_ratio is None


def test_both_grains_agree_with_each(scored):
    weekly, daily = split_grains(rollup_both(scored))
    for got, keys in ((weekly, ["party", "week"]), (daily, ["party", "date"])):
        want = rollup(scored, keys).select(got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    ordered = [(r.party, r.week) for r in in_order(weekly, "week").collect()]
    assert ordered == sorted(ordered)


def test_copies_weigh(spark, scored):
    doubled = scored.union(scored)
    folded = scored.withColumn("n", F.lit(2))

    def table(df):
        return sorted(map(str, df.withColumn("vader_avg", F.round("vader_avg", 9)).collect()))

    want = table(rollup(doubled, ["party", "week"]))
    assert table(rollup(folded, ["party", "week"], "n")) == want


def test_properties(scored):
    for r in rollup(scored, ["party", "date"]).collect():
        assert r.total <= r.comment_volume
        if r.total:
            assert r.trans_pos_ratio + r.trans_neg_ratio + r.trans_neu_ratio == pytest.approx(1.0)


def test_summary_and_extent(scored):
    weekly, daily = split_grains(rollup_both(scored))
    s = summary(daily, weekly).first()
    assert (s.targeted_rows, str(s.first_date), str(s.last_date), s.daily_buckets, s.first_week, s.last_week) == (
        5, "2025-01-06", "2025-01-14", 3, 2, 3)
    assert {r.party: r.points for r in extent(weekly, "week").collect()} == {"a": 2, "b": 1}


def polls(spark):
    return spark.createDataFrame([
        (dt.date(2025, 2, 27), 30.8, 40.2, 14.4, 14.6, "weekly", 9),
        (dt.date(2025, 3, 5), 30.8, 40.3, None, 14.5, "weekly", 9),
        (dt.date(2025, 3, 18), 35.9, 38.1, 12.4, 13.6, "daily", 12),
    ], "date date, lpc double, cpc double, ndp double, oth double, freq string, week int")


def test_polls(spark):
    got = {r.week: r for r in poll_weekly(polls(spark)).collect()}
    assert (got[9].lpc, got[9].cpc, got[9].ndp) == pytest.approx((30.8, 40.25, 14.4))
    assert {r.week for r in poll_weekly(polls(spark), week_source="iso").collect()} == {9, 10, 12}
    assert [str(r.date) for r in poll_daily(polls(spark)).collect()] == ["2025-03-18"]


def test_whole_analysis(spark, scored):
    weekly, daily = split_grains(rollup_both(scored))
    tables = analyse(weekly, daily, polls(spark), {"a": "lpc", "b": "cpc"})
    assert {"weekly_corr", "daily_corr", "weekly_regression", "daily_lag_grid_vader_avg", "weekly_fit"} <= set(tables)
    for table in tables.values():
        table.collect()
