import datetime as dt
import glob
import json
import os

import pytest
import zstandard
from golden import WEEKLY, rows
from pyspark.sql import functions as F

from voxseries import schemas
from voxseries.operators import sample as S
from voxseries.operators import views as V
from voxseries.plans.etl import run_etl, titled_comments
from voxseries.plans.scoring import run_scoring, series_rows
from voxseries.plans.views import build_views, first_rows, sample_rows
from voxseries.sources import tables as T
from voxseries.sources.dumps import read_lines, scan_dump
from voxseries.sources.publish import publish, publish_meta
from voxseries.sources.reference_series import read_lexicon, read_polls, read_probability


def put(folder, name, data):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def values(df):
    return sorted(r.value for r in df.collect())


def compressed(data, window_log):
    params = zstandard.ZstdCompressionParameters(window_log=window_log)
    # Streamed without a known size, so that the frame declares its full window.
    packer = zstandard.ZstdCompressor(compression_params=params).compressobj()
    return packer.compress(data) + packer.flush()


def test_lines(spark, scratch):
    path = put(scratch, "a.json", "one\r\ntwo\n\nlast")
    assert values(read_lines(spark, path)) == ["", "last", "one\r", "two"]


def test_dump_reader_and_long_window(spark, scratch):
    text = "".join(f"line {i} é\n" for i in range(45_000)) + "last"
    want = sorted(text.split("\n"))
    short = put(scratch, "short.zst", compressed(text.encode(), 20))
    assert values(scan_dump(spark, short)) == want
    assert values(scan_dump(spark, short, long_window=True)) == want
    long = put(scratch, "long.zst", compressed(text.encode(), 31))
    with pytest.raises(Exception):
        scan_dump(spark, long).count()
    assert values(scan_dump(spark, long, long_window=True)) == want
    both = scan_dump(spark, os.path.join(scratch, "*.zst"), long_window=True)
    assert both.count() == 2 * len(want)


def test_two_frames_in_one_file(spark, scratch):
    path = put(scratch, "two.zst", compressed(b"a\nb", 20) + compressed(b"c\nd\n", 20))
    assert values(scan_dump(spark, path, long_window=True)) == ["a", "bc", "d"]


def test_read_table_months(spark, scratch):
    for month, line in (("2025-01", '{"id":"a","title":"t"}'), ("2025-02", '{"title":"u","id":"b","x":1}')):
        os.mkdir(os.path.join(scratch, month))
        put(os.path.join(scratch, month), "part-0.json", line + "\n{bad\n")
    df = T.read_table(spark, os.path.join(scratch, "2025-*"), schemas.CLEAN_SUBMISSION)
    got = {r.id: (r.title, r.subreddit) for r in df.collect() if r.id}
    assert got == {"a": ("t", None), "b": ("u", None)}
    glob_path = os.path.join(scratch, "2025-*")
    assert df.count() == 4 and T.read_table(spark, glob_path, schemas.CLEAN_SUBMISSION, True).count() == 2


def test_read_series(spark, scratch):
    put(scratch, "part-0.json", '{"party":"NDP","date":"2025-01-06","vader_avg":0.5,"comment_volume":"7"}\n')
    put(scratch, "part-1.json", '{"party":"NDP","date":"soon","vader_avg":0.25,"comment_volume":"x"}\n')
    put(scratch, "other.json", '{"party":"no"}\n')
    df = T.read_series(spark, scratch, schemas.DAILY_SERIES, "date", ["comment_volume"])
    got = sorted((r.vader_avg, r.date, r.comment_volume) for r in df.collect())
    assert got == [(0.25, None, None), (0.5, dt.date(2025, 1, 6), 7)]
    os.mkdir(os.path.join(scratch, "empty"))
    empty = T.read_series(spark, os.path.join(scratch, "empty"), schemas.WEEKLY_SERIES, None, ["week"])
    assert empty.count() == 0 and "vader_avg" in empty.columns


def test_polls_and_probability(spark, scratch):
    path = put(scratch, "polls.txt", (
        "date\t    lpc\t    cpc\t    ndp\t    oth\t    freq    week\n"
        "2025-01-06\t20.10%\t44.20%\t19.30%\t16.40%\tweekly  1\n"
        "2025-03-20\t37.75%\t37.30%\t11.450%\t13.00%\tdaily   12\n\n"))
    got = [tuple(r) for r in read_polls(spark, path, strict=True).orderBy("date").collect()]
    assert got == [
        (dt.date(2025, 1, 6), 20.1, 44.2, 19.3, 16.4, "weekly", 1),
        (dt.date(2025, 3, 20), 37.75, 37.3, 11.45, 13.0, "daily", 12),
    ]
    assert read_polls(spark, path).schema == schemas.POLLS
    spoiled = put(scratch, "spoiled.txt", "date lpc cpc ndp oth freq week\nsoon 1% x% 3% 4% daily w\n")
    assert tuple(read_polls(spark, spoiled).first()) == (None, 1.0, None, 3.0, 4.0, "daily", None)
    with pytest.raises(Exception):
        read_polls(spark, spoiled, strict=True).collect()
    chances = put(scratch, "p.txt", "date\t    lpc\tcpc\n2025-01-06\t1%\t99%\n")
    assert tuple(read_probability(spark, chances).first()) == (dt.date(2025, 1, 6), 1.0, 99.0)


def test_lexicon_file(spark, scratch):
    path = put(scratch, "lexicon.txt", "good\t1.9\t0.9\t[1, 2]\n:)\t2.0\t1.1\t[2]\nbroken\n")
    assert {r.word: r.valence for r in read_lexicon(spark, path).collect()} == {"good": 1.9, ":)": 2.0}


def test_writers(spark, scratch):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    out = os.path.join(scratch, "out")
    T.write_jsonl(df, out)
    with pytest.raises(Exception):
        T.write_jsonl(df, out)
    T.write_jsonl(df, out, mode="overwrite")
    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(out + "/part-*"))
    assert text == '{"a":"é","b":null}\n'
    T.write_jsonl(df, out, mode="overwrite", keep_nulls=False)
    assert json.loads("".join(open(p, encoding="utf-8").read() for p in glob.glob(out + "/part-*"))) == {"a": "é"}
    lines = os.path.join(scratch, "lines")
    T.write_lines(T.to_json_lines(df), lines)
    assert values(read_lines(spark, lines)) == ['{"a":"é","b":null}']


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    assert sorted(map(tuple, T.union_parts(a, b).collect()), key=str) == [(1, "x", None), (None, "y", 2.0)]


def test_spread_only_when_short_of_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    assert T.spread_scan(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    assert T.spread_scan(spark.range(10, numPartitions=cores + 3)).rdd.getNumPartitions() == cores + 3


def test_published_rounding(spark):
    party, week, vader, positive, total = rows(WEEKLY)[0]
    df = spark.createDataFrame(
        [(party, int(week), float(vader), int(positive) / int(total), 0.6047578325429527, 0.365078131073622, int(total))],
        "party string, week int, vader_avg double, trans_pos_ratio double, trans_neg_ratio double,"
        " trans_neu_ratio double, comment_volume long")
    assert publish(df, "weekly").toJSON().first() == json.dumps({
        "party": "Conservative", "week": 1, "vaderAvg": 0.0531, "transPosRatio": 0.0302, "transNegRatio": 0.6048,
        "transNeuRatio": 0.3651, "commentVolume": 12863}, separators=(",", ":"))


def test_publish_other_kinds(spark):
    day = dt.date(2025, 3, 20)
    polls = spark.createDataFrame([(day, 37.755, 37.3, 11.45, 13.0, "daily", 12)], schemas.POLLS)
    assert tuple(publish(polls, "poll_daily").first()) == ("2025-03-20", 37.76, 37.3, 11.45, 13.0, "daily", 12)
    chance = spark.createDataFrame([(day, 1.0, 99.0)], schemas.PROBABILITY)
    assert tuple(publish(chance, "probability").first()) == ("2025-03-20", 1.0, 99.0)
    facts = spark.createDataFrame(
        [(5, day, day, 1, 12, 12)],
        "targeted_rows long, first_date date, last_date date, daily_buckets long, first_week int, last_week int")
    seen = spark.createDataFrame([(10, 4, 1)], "seen long, kept long, bad long")
    meta = json.loads(publish_meta(facts, seen, seen, {"lpc": 42, "cpc": 38, "ndp": 17}, model="m").toJSON().first())
    assert meta["commentsScanned"] == 10 and meta["dailyDateRange"] == ["2025-03-20", "2025-03-20"]
    assert meta["finalResults"] == {"lpc": 42, "cpc": 38, "ndp": 17} and meta["weeklyWeekRange"] == [12, 12]


def test_samples(spark):
    df = spark.range(5000).withColumn("party", F.when(F.col("id") < 20, "b").otherwise("a"))
    assert S.sample_n(df, 9000, "id").count() == 5000
    one = {r.id for r in S.sample_n(df, 10, "id", seed=1).collect()}
    assert len(one) == 10 and one == {r.id for r in S.sample_n(df.repartition(7), 10, "id", seed=1).collect()}
    assert one != {r.id for r in S.sample_n(df, 10, "id", seed=2).collect()}
    per = {r.party: r["count"] for r in S.sample_n(df, 30, "id", by="party").groupBy("party").count().collect()}
    assert per == {"a": 30, "b": 20}
    large = S.sample_n(df, 1500, "id", by="party")
    plain = S.sample_n(df.filter("party = 'a'"), 1500, "id")
    assert {r.id for r in large.filter("party = 'a'").collect()} == {r.id for r in plain.collect()}
    kept = S.sample_fraction(df, 0.1, "id", 4).count()
    assert 380 < kept < 620
    assert S.flag_sampled(df, 0.1, "id", 4).filter("kept").count() == kept
    assert S.sample_fraction(df, 0.1).count() < 1000


def series(spark):
    weekly = spark.createDataFrame(
        [("NDP", w, 0.1 * w, 0.5, 10) for w in range(1, 19)],
        "party string, week int, vader_avg double, trans_pos_ratio double, comment_volume long")
    daily = spark.createDataFrame(
        [("NDP", dt.date(2025, 4, d), 0.1, 0.5, 10) for d in range(20, 31)],
        "party string, date date, vader_avg double, trans_pos_ratio double, comment_volume long")
    polls = spark.createDataFrame(
        [(dt.date(2025, 4, 21), 42.0, 38.0, 8.0, 1.0, "daily", 17), (dt.date(2025, 4, 22), 42.0, 38.0, None, 1.0, "daily", 17)],
        schemas.POLLS)
    return weekly, daily, polls


def test_views(spark):
    views = build_views(*series(spark))
    weekly = {r.label: r for r in views["weekly"].collect()}
    assert len(weekly) == 17 and weekly["Week 17"].poll == 8.0 and weekly["Week 16"].poll is None
    assert str(weekly["Week 1"].x_axis) == "2025-01-06"
    daily = {str(r.x_axis): r.poll for r in views["daily"].collect()}
    assert len(daily) == 8 and daily["2025-04-21"] == 8.0 and daily["2025-04-27"] is None
    assert views["daily_polls"].filter("party = 'NDP'").count() == 1
    assert views["cards"].first().weeks == "18 weeks"
    marker = V.event_marker(views["daily"], "2025-04-28").first()
    assert marker.shown is True and V.event_marker(views["daily"], "2025-04-29").first().shown is False
    assert V.event_marker(views["daily"]).first().last == dt.date(2025, 4, 27)


def test_small_views(spark):
    weekly, daily, _ = series(spark)
    assert V.for_group(weekly, "NDP").count() == 18 and V.for_group(weekly, "x").count() == 0
    assert V.clip(weekly, "week", 3).count() == 3
    assert V.select_existing(weekly, ["week", "nothing"]).columns == ["week"]
    assert [r.week for r in first_rows(weekly, "week", 2).collect()] == [1, 2]
    cells = spark.createDataFrame([(-2.0,), (0.25,), (None,)], "r double")
    assert [r.strength for r in V.cell_strength(cells, "r").collect()] == [1.0, 0.25, None]


def comment(i, **changes):
    return json.dumps({
        "id": f"c{i}", "link_id": "t3_s1", "parent_id": "p", "subreddit": "canada", "author": "a",
        "created_utc": 1735689600 + 86400 * i, "score": 1, "body": "Good NDP day. Bad pp.", "permalink": "/x"} | changes)


def test_dumps_to_scored_rows(spark, scratch):
    comments = [comment(0), comment(1, link_id="t3_none"), comment(2, subreddit="x"), "{bad", comment(3, subreddit=" canada")]
    subs = [json.dumps({"id": "s1", "subreddit": "NDP", "title": " Carney "}), json.dumps({"id": "s2", "subreddit": "x", "title": ""})]
    c = put(scratch, "RC.zst", compressed("\n".join(comments).encode(), 20))
    s = put(scratch, "RS.zst", compressed("\n".join(subs).encode(), 20))
    joined, counts = run_etl(spark, [c], [s], os.path.join(scratch, "etl"))
    assert counts["comments"] == {"seen": 5, "kept": 2, "bad": 1}
    assert counts["submissions"] == {"seen": 2, "kept": 1, "bad": 0}
    assert counts["comments_clean"] == {"total": 2, "kept": 2}
    assert counts["submissions_clean"] == {"total": 1, "kept": 1}
    assert counts["join"] == {"inputs": 2, "matched": 1, "unmatched": 1}
    assert {r.id: r.title for r in joined.collect()} == {"c0": "Carney", "c1": ""}
    assert os.path.isdir(os.path.join(scratch, "etl", "joined", "month=2025-01"))

    direct = titled_comments(read_lines(spark, c), read_lines(spark, s))
    assert sorted(map(str, direct.select(joined.columns).collect())) == sorted(map(str, joined.collect()))

    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")

    def add_class(rows, text):
        return rows.withColumn("trans_sentiment", F.when(F.col(text).contains("good"), 2).otherwise(0))

    scored = run_scoring(joined, lexicon, add_class, os.path.join(scratch, "scored"))
    assert set(schemas.SCORED.names) == set(scored.columns)
    got = sorted((r.id, r.party, r.trans_sentiment, r.vader_score) for r in scored.collect())
    assert got == [("c0", "Conservative", 0, -0.5423), ("c0", "Liberal", 2, 0.4404), ("c0", "NDP", 2, 0.4404),
                   ("c1", "Conservative", 0, -0.5423), ("c1", "NDP", 2, 0.4404)]
    narrow = series_rows(joined, lexicon, add_class)
    assert narrow.agg(F.sum("copies")).first()[0] == 5
    assert sample_rows(scored, "id", 1).columns == ["date", "party", "targeted_sentence", "trans_sentiment", "vader_score"]
