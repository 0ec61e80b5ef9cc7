"""Heads and samples."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest n for which Spark itself trims each task's rows to n before the shuffle.
_TRIMMED_BY_SPARK = 1000


def draw(key: str, seed: int = 0) -> Column:
    """A fixed pseudo-random text for a row key; its order is a shuffle of the rows."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))


def head(df: DataFrame, order, n: int = 50) -> DataFrame:
    """First ``n`` rows in ``order``: each task keeps n, the driver never sees more."""
    return df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0, by: str | None = None) -> DataFrame:
    """``n`` rows drawn without replacement, all of them if there are fewer; per ``by`` value
    if given. The same seed draws the same rows."""
    marked = df.withColumn("_draw", draw(key, seed))
    if by is None:
        return marked.orderBy("_draw", key).limit(n).drop("_draw")
    order = [F.col("_draw"), F.col(key)]
    if n > _TRIMMED_BY_SPARK:
        # A group's n smallest are among the n smallest of each of its 256 shares.
        share = Window.partitionBy(by, F.substring("_draw", -2, 2)).orderBy(*order)
        marked = marked.withColumn("_place", F.row_number().over(share)).filter(F.col("_place") <= n)
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return marked.withColumn("_place", place).filter(F.col("_place") <= n).drop("_draw", "_place")


def sample_fraction(df: DataFrame, fraction: float, key: str | None = None, seed: int = 0) -> DataFrame:
    """Each row kept with probability ``fraction``, independently of the others.

    With a ``key`` the choice depends on it and the seed alone, so a rerun or a lost executor
    does not change the sample.
    """
    if key is None:
        return df.sample(False, fraction, seed)
    return df.filter(_share(key, seed) < fraction)


def flag_sampled(df: DataFrame, fraction: float, key: str, seed: int = 0) -> DataFrame:
    """All rows with a ``kept`` flag, for counting scanned and kept rows."""
    return df.withColumn("kept", _share(key, seed) < fraction)


def _share(key: str, seed: int) -> Column:
    """Uniform number in [0, 1) from the first eight hex digits of the draw."""
    return F.conv(F.substring(draw(key, seed), 1, 8), 16, 10).cast("double") / 2.0**32
