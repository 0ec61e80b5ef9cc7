"""Edges that once ended a job or changed an answer silently."""

import datetime

import pytest
from pyspark.sql import functions as F

from voxseries.functions.dates import epoch_date
from voxseries.functions.numbers import to_epoch, to_score
from voxseries.operators.correlate import pair_stats
from voxseries.sources.reference_series import POLL_HEADER, parse_percent_table


def test_epochs_beyond_the_calendar_are_null(spark):
    rows = spark.createDataFrame([(0,), (1735689600,), (1735689600000,), (2**63 - 1,), (-2**63,), (None,)], "s long")
    got = [r[0] for r in rows.select(epoch_date(F.col("s"))).collect()]
    assert got == [datetime.date(1970, 1, 1), datetime.date(2025, 1, 1), None, None, None, None]


def test_large_numbers_stay_at_the_bound(spark):
    texts = ["1e19", str(2**70), "9" * 25, str(-2**70), "1735689600.9", "9223372036854775807", "1e400", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("v", F.try_parse_json(F.lit("1")))
    got = rows.select(to_epoch(F.col("t"), F.col("v")), to_score(F.col("t"), F.col("v"))).collect()
    most = 2**63 - 1
    assert [r[0] for r in got] == [most, most, most, -2**63, 1735689600, most, None, None]
    assert [r[1] for r in got] == [most, most, most, -2**63, 1735689600, most, 0, 0]


def test_both_spearman_paths_agree_on_constants_and_null_groups(spark):
    base = spark.range(20000).select(
        F.expr("case when id % 3 = 0 then null else 'g' || id % 3 end").alias("g"), F.lit("m").alias("measure"),
        (F.col("id") * 7919 % 101).cast("double").alias("x"), (F.col("id") * 31 % 17).cast("double").alias("y"))
    level = base.withColumn("measure", F.lit("level")).withColumn("x", F.lit(3.0))
    rows = base.union(level)
    one, two = ({(r["g"], r["measure"]): r for r in pair_stats(rows, ["g"], 3, big).collect()} for big in (False, True))
    assert one.keys() == two.keys() and (None, "m") in one
    for key in one:
        assert one[key]["n"] == two[key]["n"]
        for stat in ("pearson", "spearman"):
            assert one[key][stat] == pytest.approx(two[key][stat]) if one[key][stat] is not None else two[key][stat] is None
        assert (one[key]["spearman"] is None) == (key[1] == "level")


def test_poll_columns_go_by_the_header(spark):
    lines = spark.createDataFrame([("cpc date lpc ndp week oth freq",), ("40% 2025-01-06 20% 10% 3 5% weekly",)], "value string")
    row = parse_percent_table(lines).first()
    assert (row["lpc"], row["cpc"], row["week"], row["freq"]) == (20.0, 40.0, 3, "weekly")
    short = spark.createDataFrame([("date lpc",), ("2025-01-06 20%",)], "value string")
    assert parse_percent_table(short).first()["cpc"] is None
    with pytest.raises(ValueError):
        parse_percent_table(short, POLL_HEADER, strict=True)


def test_two_values_on_a_line_are_bad(spark):
    one = '{"subreddit": "ndp", "body": "a", "n": [{"x": 1}, {"y": {}}], "t": "} {"}'
    lines = [one, one + " " + one, one + "," + one, one + " 5 " + one, one + "]" + one, " " + one + "\t", one + one]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    from voxseries.operators.clean import flag_raw
    got = {r.value: (r.kept, r.bad) for r in flag_raw(df).collect()}
    assert [got[t] for t in lines] == [(True, False)] + [(False, True)] * 4 + [(True, False), (False, True)]


def test_running_weeks_cross_new_year(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from voxseries.functions.dates import iso_week, iso_year, running_week, running_week_of
    days = [(dt.date(2019, 12, 20) + dt.timedelta(k),) for k in range(800)]
    d = F.col("d")
    rows = spark.createDataFrame(days, "d date").select(
        "d", running_week(d).alias("run"), running_week_of(iso_year(d), iso_week(d)).alias("of")).orderBy("d").collect()
    assert all(r.run == r.of == (r.d.toordinal() - dt.date(1969, 12, 29).toordinal()) // 7 for r in rows)


def test_spoiled_series_file_is_left_out_and_reported(spark, scratch):
    from voxseries import schemas
    from voxseries.sources.tables import read_series, spoiled_files
    row = '{"party": "a", "week": %s, "comment_volume": "x"}'
    for name, lines in {
        "part-0.json": [row % 1, row % '"two"'], "part-1.json": [row % 3, '{"party": "a", "we', row % 4],
        "part-2.json": [row % 5], "other.json": ["junk"], "part-3.json": [],
    }.items():
        (__import__("pathlib").Path(scratch) / name).write_text("".join(x + "\n" for x in lines))
    got = read_series(spark, scratch, schemas.WEEKLY_SERIES, None, ["week", "comment_volume"])
    assert got.columns == schemas.WEEKLY_SERIES.names
    assert sorted((r.week for r in got.collect()), key=str) == [1, 5, None]
    report = spoiled_files(spark, scratch, schemas.WEEKLY_SERIES).collect()
    assert [(r.file.rsplit("/", 1)[1], r.lines, r.bad, r.example) for r in report] == [("part-1.json", 3, 1, '{"party": "a", "we')]


def test_each_dump_file_has_a_task_of_its_own(spark, scratch):
    import os

    import zstandard

    from voxseries.sources import zstd_source
    from voxseries.sources.dumps import scan_dump
    long = "x" * 9_000_000
    for i in range(5):
        with open(os.path.join(scratch, f"d{i}.zst"), "wb") as f:
            f.write(zstandard.compress(("\n".join(f"{i}-{k}" for k in range(1000)) + ("\n" + long if i == 3 else "")).encode()))
    df = scan_dump(spark, os.path.join(scratch, "*.zst"), long_window=True)
    from pyspark.sql import functions as F
    got = df.select(F.spark_partition_id().alias("p"), F.substring("value", 1, 1).alias("file"), F.length("value").alias("n"))
    got = got.groupBy("p", "file").agg(F.count("*").alias("lines"), F.max("n").alias("n")).collect()
    assert len({r.p for r in got}) == 5
    assert {r.file: (r.lines, r.n) for r in got if r.file != "x"} == {str(i): (1000, 5) for i in range(5)}
    assert [(r.lines, r.n) for r in got if r.file == "x"] == [(1, len(long))]
    sizes = [sum(map(len, b)) for b in zstd_source.batches("file://" + os.path.join(scratch, "d3.zst"))]
    assert len(sizes) == 1 and sizes[0] > zstd_source.BATCH_BYTES  # one line is never cut


def test_hot_threads_are_spread(spark):
    from pyspark.sql import functions as F

    from voxseries.operators.joins import attach_titles, flag_matches, hot_keys
    comments = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 30 == 0, "").when(F.col("id") % 31 == 0, None)
        .otherwise(F.concat(F.lit("t"), F.col("id") % 97)).alias("link_id_short"))
    comments = comments.unionAll(spark.createDataFrame([("same", "hot")] * 500, comments.schema))
    subs = spark.createDataFrame([("hot", " Hot ", 1), ("t1", "one", 2), ("t1", "uno", 3), ("t3", None, 4), ("", "x", 5)],
                                 "id string, title string, n int")
    hot = hot_keys(comments, "link_id_short", share=0.2, tracked=100)
    assert list(hot) == ["hot"] and 0.7 < hot["hot"] < 0.9
    assert hot_keys(comments.limit(0), "link_id_short") == {}
    plain = sorted(map(str, attach_titles(comments, subs).collect()))
    spread = attach_titles(comments, subs, hot=hot)
    assert sorted(map(str, spread.collect())) == plain
    assert flag_matches(comments, subs, hot=hot).filter("matched").count() == flag_matches(comments, subs).filter("matched").count()
    # No join key holds more than some of the hot thread's comments.
    from voxseries.operators import joins as J
    salted = comments.withColumn("k", F.pmod(F.xxhash64(F.monotonically_increasing_id()), J._spread(F.col("link_id_short"), hot, 4)))
    counts = [r["count"] for r in salted.filter("link_id_short = 'hot'").groupBy("k").count().collect()]
    assert len(counts) == round(8 * hot["hot"]) and max(counts) < 2 * min(counts)
    with pytest.raises(ValueError):
        hot_keys(comments, "link_id_short", share=0.001, tracked=100)
