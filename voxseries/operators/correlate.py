"""Correlation of sentiment with polls, for every group at once."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.numbers import clamp
from voxseries.functions.stats import pearson
from voxseries.sources.tables import staged


def measures_long(pairs: DataFrame, by, measures=K.MEASURES, y: str = "poll") -> DataFrame:
    """One row per (pair, measure): ``by``, ``measure``, ``x``, ``y``, with incomplete pairs
    still in. A measure the table does not have is all null."""
    have = [
        (F.col(m) if m in pairs.columns else F.lit(None)).cast("double").alias(m) for m in measures
    ]
    wide = pairs.select(*by, F.col(y).cast("double").alias("y"), *have)
    return wide.unpivot([*by, "y"], list(measures), "measure", "x")


def match(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on keys that may be null; each key once in the result."""
    renamed = right.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_other_{k}" for k in keys])


def rank_series(df: DataFrame, by, cols) -> DataFrame:
    """Average rank of each column inside its group, ties sharing their mean rank.

    For series, where a group has one row per calendar step: each group is sorted in one task,
    and the aggregation that follows needs no further shuffle. Null values have no rank and do
    not count.
    """
    for c in cols:
        ahead = Window.partitionBy(*by).orderBy(F.col(c).asc_nulls_last())
        ties = Window.partitionBy(*by, c)
        mean = F.rank().over(ahead) + (F.count(F.lit(1)).over(ties) - 1) / 2
        df = df.withColumn(f"{c}_rank", F.when(F.col(c).isNotNull(), mean))
    return df


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, with the weight before each value, of this task only, and the weight of its ties."""
    before = 0
    for batch in batches:
        weights = batch.column("_n").to_numpy()
        upto = before + np.cumsum(weights)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto)], names=[*batch.schema.names, "_upto"])
        before = int(upto[-1]) if len(upto) else before


def value_ranks(counts: DataFrame, by) -> DataFrame:
    """Average rank of each value in its group, for groups of any size; ties are folded already.

    ``counts`` has one row for each ``by``, ``_value`` and the number ``_n`` of rows with it. One exchange by ranges puts the
    values in order; every task adds up its own, and what lies before a task is the total of the tasks before it: one number
    a task, known once the sums are stored. The rank of a group's values starts at the group's first row.
    """
    order = [*by, "_value"]
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    layout = counts.select(*order, "_n").schema.simpleString()[7:-1].replace(":", " ")
    ordered = counts.select(*order, "_n").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = staged(ordered.mapInArrow(_running, f"{layout}, _upto bigint").withColumn("_task", F.spark_partition_id()), "ranks")
    # Totals of the tasks, a row for each, are added up in their order.
    tasks = {r["_task"]: r["n"] for r in placed.groupBy("_task").agg(F.max("_upto").alias("n")).collect()}
    ahead, total = [], 0
    for task in range(max(tasks, default=-1) + 1):
        ahead.append(total)
        total += tasks.get(task, 0)
    start = F.get(F.array(*map(F.lit, ahead)).cast("array<bigint>"), F.col("_task"))
    placed = placed.select(*order, "_n", (F.col("_upto") + start).alias("_upto"))
    groups = placed.groupBy(*by).agg(F.min(F.col("_upto") - F.col("_n")).alias("_start"), F.sum("_n").alias("_all"))
    ranked = match(placed, groups, list(by))
    # Ranks are centred on their known mean before they are multiplied: a constant column is exactly 0.
    centred = F.col("_upto") - F.col("_start") - (F.col("_n") - 1) / 2 - (F.col("_all") + 1) / 2
    return ranked.select(*order, centred.alias("_rank"))


def _large_stats(long: DataFrame, keys, min_n: int) -> DataFrame:
    """Both correlations of groups of any size from one scan: equal pairs are folded and stored, all else comes from them."""
    complete = F.col("x").isNotNull() & F.col("y").isNotNull()
    pairs = long.select(*keys, F.when(complete, F.col("x")).alias("x"), F.when(complete, F.col("y")).alias("y"))
    folded = staged(pairs.groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).alias("_n")), "pairs")
    sound = folded.filter(F.col("x").isNotNull())
    axes = F.explode(F.array(F.struct(F.lit("x").alias("_axis"), F.col("x").alias("_value")),
                             F.struct(F.lit("y").alias("_axis"), F.col("y").alias("_value")))).alias("_v")
    values = sound.select(*keys, "_n", axes).select(*keys, "_n", "_v.*")
    counts = values.groupBy(*keys, "_axis", "_value").agg(F.sum("_n").alias("_n"))
    ranks = value_ranks(counts, [*keys, "_axis"])

    def axis(name: str) -> DataFrame:
        return ranks.filter(F.col("_axis") == name).select(
            *keys, F.col("_value").alias(name), F.col("_rank").alias(f"_{name}_rank"))

    ranked = match(match(sound, axis("x"), [*keys, "x"]), axis("y"), [*keys, "y"])
    means = sound.groupBy(*keys).agg(*[(F.sum(F.col(v) * F.col("_n")) / F.sum("_n")).alias(f"_{v}_mean") for v in ("x", "y")])
    ranked = match(ranked, means, keys)
    w = F.col("_n")
    sides = {"pearson": (F.col("x") - F.col("_x_mean"), F.col("y") - F.col("_y_mean")),
             "spearman": (F.col("_x_rank"), F.col("_y_rank"))}
    sums = ranked.groupBy(*keys).agg(F.sum(w).alias("n"), *[
        F.sum(w * p * q).alias(f"_{name}_{label}")
        for name, (a, b) in sides.items() for label, p, q in (("aa", a, a), ("bb", b, b), ("ab", a, b))])

    def r(name: str):
        spread = F.sqrt(f"_{name}_aa") * F.sqrt(f"_{name}_bb")
        return F.when(F.col("n") >= min_n, clamp(F.try_divide(F.col(f"_{name}_ab"), spread), -1.0, 1.0)).alias(name)

    found = sums.select(*keys, r("pearson"), r("spearman"), "n")
    # Groups without a complete pair are still groups.
    groups = folded.select(*keys).distinct()
    return match(groups, found, keys, "left").select(*keys, "pearson", "spearman", F.coalesce("n", F.lit(0)).alias("n"))


def pair_stats(long: DataFrame, by, min_n: int = 3, large_groups: bool = False) -> DataFrame:
    """Pearson, Spearman and pair count per group and measure.

    Nulls are set aside before anything is ranked. ``large_groups`` is for raw rows, where one
    group may hold any share of the table; it stores folded pairs in the shared folder right away.
    A null group is a group like any other.
    """
    keys = [*by, "measure"]
    if large_groups:
        return _large_stats(long, keys, min_n)
    complete = F.col("x").isNotNull() & F.col("y").isNotNull()
    stats = [
        pearson(F.col("x"), F.col("y"), min_n).alias("pearson"),
        F.count_if(complete).alias("n"),
    ]
    pairs = long.withColumns({
        "x": F.when(complete, F.col("x")), "y": F.when(complete, F.col("y"))
    })
    ranked = rank_series(pairs, keys, ["x", "y"])
    spearman = pearson(F.col("x_rank"), F.col("y_rank"), min_n).alias("spearman")
    return ranked.groupBy(*keys).agg(stats[0], spearman, stats[1])


def corr_long(
    pairs: DataFrame, by=("party",), measures=K.MEASURES, min_n: int = 5, y: str = "poll",
    large_groups: bool = False,
) -> DataFrame:
    """One row per group and measure: ``measure, pearson, spearman, n``."""
    return pair_stats(measures_long(pairs, by, measures, y), list(by), min_n, large_groups)


def corr_table(
    pairs: DataFrame, by=("party", "lag"), measures=K.MEASURES, min_n: int = 3, y: str = "poll",
    large_groups: bool = False,
) -> DataFrame:
    """One row per group: ``<measure>_pear``, ``<measure>_spear``, ``<measure>_n``."""
    return corr_wide(corr_long(pairs, by, measures, min_n, y, large_groups), by, measures)


def corr_wide(tall: DataFrame, by=("party", "lag"), measures=K.MEASURES) -> DataFrame:
    """The same from the rows per measure."""
    stats = {"pear": "pearson", "spear": "spearman", "n": "n"}
    return tall.groupBy(*by).agg(*[
        F.max(F.when(F.col("measure") == m, F.col(source))).alias(f"{m}_{short}")
        for m in measures for short, source in stats.items()
    ])


def corr_grid(table: DataFrame, across: str, value: str, columns, down: str = "party") -> DataFrame:
    """Cross-tab: one row per ``down``, one column per listed value of ``across``."""
    return table.groupBy(down).pivot(across, list(columns)).agg(F.first(value))
