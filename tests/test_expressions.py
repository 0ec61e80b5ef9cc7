import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from voxseries.functions import dates, numbers, stats, text


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c")).alias("r")).first().r


def variant(spark, token, expr):
    """``expr`` of a JSON value, given as text and as a variant."""
    def of(c):
        typed = F.try_parse_json(c)
        return expr(F.try_variant_get(typed, "$", "string"), typed)

    return one(spark, token, of)


def test_strip_removes_all_unicode_space(spark):
    assert one(spark, " \tx\t\u001c 　\n", text.strip) == "x"
    assert one(spark, None, text.strip) is None


@pytest.mark.parametrize("given,want", [("t3_abc", "abc"), ("abc", "abc"), ("t3_t3_a", "t3_a"), ("", "")])
def test_strip_prefix(spark, given, want):
    assert one(spark, given, lambda c: text.strip_prefix(c, "t3_")) == want


def test_membership(spark):
    assert one(spark, " Canada ", lambda c: text.in_set(c, ["canada"]))
    assert not one(spark, " Canada ", lambda c: text.in_set(c, ["canada"], trim=False))
    assert not one(spark, " ", lambda c: text.in_set(c, ["canada", ""]))


@pytest.mark.parametrize("given,want", [(" [deleted] ", True), ("[DELETED]", False), ("  ", True), ("x", False)])
def test_placeholder(spark, given, want):
    assert one(spark, given, text.is_placeholder) is want


@pytest.mark.parametrize("given,want", [
    ("1735689600.9", 1735689600), ('"1735689600.0"', 1735689600), ('" 12 "', 12), ('"x"', None),
    ("null", None), ('"NaN"', None), ('"1.0d"', None), ("-1.9", -1), ("1e30", 2**63 - 1), ("true", 1), ('"true"', None),
    ("1735689600", 1735689600), ('"1e3"', 1000), ("[1]", None),
])
def test_epoch(spark, given, want):
    assert variant(spark, given, numbers.to_epoch) == want


@pytest.mark.parametrize("given,want", [
    ("5.7", 5), ('"5"', 5), ('"5.7"', 0), ("null", 0), ('"junk"', 0), ("-2.9", -2), ('" -3 "', -3),
    ("false", 0), ("{}", 0), ("true", 1), ('"true"', 0), ("1e3", 1000), ('"1e3"', 0), ("-0.5", 0),
])
def test_score(spark, given, want):
    assert variant(spark, given, numbers.to_score) == want


@pytest.mark.parametrize("given,legacy,want", [
    ("null", False, None), ("null", True, "None"), ("true", True, "True"), ("5", False, "5"),
    ('" a "', False, " a "), ('"true"', False, "true"),
])
def test_json_text(spark, given, legacy, want):
    assert variant(spark, given, lambda c, v: numbers.json_text(c, v, legacy)) == want


@pytest.mark.parametrize("given,want", [
    ("20.10%", 20.1), (" 11.450%​", 11.45), ("n/a", None), (None, None), ("7", 7.0), ("", None),
])
def test_percent(spark, given, want):
    assert one(spark, given, numbers.clean_percent) == want


def test_percent_strict_raises(spark):
    with pytest.raises(Exception):
        one(spark, "n/a", lambda c: numbers.clean_percent(c, strict=True))


@pytest.mark.parametrize("n,want", [
    (1272871484, "1.27B"), (2120406, "2.12M"), (55696, "55,696"), (7, "7"),
])
def test_compact(spark, n, want):
    assert one(spark, n, text.compact_number, "bigint") == want


def test_ratio_of_nothing(spark):
    assert one(spark, 0, lambda c: numbers.ratio(c, c), "bigint") is None


@pytest.mark.parametrize("zone,want", [("UTC", dt.date(2025, 1, 1)), ("America/Vancouver", dt.date(2024, 12, 31))])
def test_epoch_date_depends_on_zone_only(spark, zone, want):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert one(spark, 1735689600, lambda c: dates.epoch_date(c, zone), "bigint") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert one(spark, want, dates.iso_week, "date") == 1


def test_iso_year_belongs_to_week(spark):
    assert one(spark, dt.date(2024, 12, 31), dates.iso_year, "date") == 2025


def test_week_axis_and_event(spark):
    assert one(spark, 3, dates.week_axis_date, "int") == dt.date(2025, 1, 20)
    first, last = dt.date(2025, 1, 6), dt.date(2025, 1, 20)
    for day, want in ((5, True), (4, False), (21, True), (22, False)):
        got = one(spark, dt.date(2025, 1, day),
                  lambda c: dates.within_series(c, F.lit(first), F.lit(last)), "date")
        assert got is want


def test_keyword_edges(spark):
    def hit(value, *keys):
        return one(spark, value, lambda c: c.rlike(text.keyword_pattern(keys)))

    assert not hit("éndp x", "ndp")
    assert hit("ndp's", "ndp")
    assert hit("the right-wing", "right-wing")
    assert not hit("ppx", "pp")
    assert not hit("a_pp", "pp")
    assert not hit("axb", "a.b")


def test_words(spark):
    got = one(spark, 'He\'s  "GREAT", :) (ok) a.\n', text.words)
    assert got == ["he's", "great", ":)", "(ok)", "a."]


def test_student_t(spark):
    # Closed forms: df 1 is Cauchy, df 2 is algebraic.
    known = [(t, 1.0, 1 - 2 / math.pi * math.atan(abs(t)), 1e-10) for t in (0.5, 2.0, -3.0, 40.0)]
    known += [(t, 2.0, 1 - abs(t) / math.sqrt(2 + t * t), 1e-9) for t in (0.5, 2.0, -3.0, 40.0)]
    known += [(2.13144955, 15.0, 0.05, 1e-7), (0.0, 9.0, 1.0, 1e-12), (1.959963985, 4e6, 0.05, 2e-5),
              (1.0, 1e9, math.erfc(math.sqrt(0.5)), 1e-8), (40.0, 500.0, 6.29064e-158, 1e-4)]
    unknown = [(float("nan"), 9.0), (None, 9.0), (2.0, None), (float("inf"), 9.0), (2.0, 0.0), (2.0, -1.0)]
    rows = [r[:2] for r in known] + unknown
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t double, f double")
    got = [r.p for r in df.select("i", stats.t_pvalue(F.col("t"), F.col("f")).alias("p")).orderBy("i").collect()]
    for (_, _, want, rtol), p in zip(known, got):
        assert p == pytest.approx(want, rel=rtol)
    assert got[len(known):] == [None] * len(unknown)
