"""Session settings the operators rely on."""

from pyspark.sql import SparkSession

# AQE sizes shuffles, splits skewed join partitions and turns a join into a broadcast once
# the shuffled side has been measured; no operator here hints a broadcast of its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # The JVM does not compile methods over 8000 bytes of bytecode; operator by operator is then
    # faster than one fused method that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "voxseries", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults above; ``conf`` keys (dots as ``__``) override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
