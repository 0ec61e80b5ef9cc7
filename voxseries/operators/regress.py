"""Simple regression of polls on sentiment, for every group at once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.stats import t_pvalue
from voxseries.operators.correlate import measures_long


def ols(
    pairs: DataFrame, by=("party",), measures=K.MEASURES, min_n: int = 5, y: str = "poll",
    pvalue: bool = True,
) -> DataFrame:
    """poll = intercept + slope * measure per group and measure.

    Groups with fewer than ``min_n`` complete pairs give no row. A constant measure gives null
    coefficients; a perfect fit has no finite t and no p-value. The moments come from one partial and
    final aggregation, the rest is expressions over the finished lines.
    """
    x_, y_ = F.col("x"), F.col("y")
    moments = measures_long(pairs, by, measures, y).groupBy(*by, "measure").agg(
        F.regr_count(y_, x_).alias("n"),
        F.regr_sxx(y_, x_).alias("sxx"), F.regr_syy(y_, x_).alias("syy"),
        F.regr_sxy(y_, x_).alias("sxy"),
        F.regr_avgx(y_, x_).alias("mean_x"), F.regr_avgy(y_, x_).alias("mean_y"),
        F.min(F.when(y_.isNotNull(), x_)).alias("x_min"),
        F.max(F.when(y_.isNotNull(), x_)).alias("x_max"),
    ).filter(F.col("n") >= min_n)
    lines = moments.withColumn("slope", F.try_divide("sxy", "sxx"))
    lines = lines.withColumns({
        "intercept": F.col("mean_y") - F.col("slope") * F.col("mean_x"),
        "r2": F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy")),
        "_rest": F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)),
    })
    error = F.sqrt(F.try_divide(F.try_divide("_rest", F.col("n") - 2), F.col("sxx")))
    lines = lines.withColumn("t", F.try_divide("slope", error))
    kept = [*by, "measure", "n", "slope", "intercept", "t"]
    if pvalue:
        freedom = (F.col("n") - 2).cast("double")
        lines = lines.withColumn("p", t_pvalue(F.col("t"), freedom))
        kept.append("p")
    return lines.select(*kept, "r2", "x_min", "x_max")


def fit_line(lines: DataFrame, by=("party",), points: int = 100) -> DataFrame:
    """Evenly spaced points of each fitted line, from the least to the greatest x seen."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    spread = lines.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    spread = spread.withColumn("x", F.col("x_min") + F.col("point") * step)
    fitted = (F.col("intercept") + F.col("slope") * F.col("x")).alias("fitted")
    return spread.select(*by, "measure", "point", "x", fitted)
