"""Typed readers of JSON-lines tables, and the writers."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path, schema: T.StructType, drop_unreadable: bool = False
) -> DataFrame:
    """JSON lines under a directory, glob or list of both, with a declared schema: no
    inference pass, months aligned by name, absent columns null. An unreadable line is a row of
    nulls, or dropped on request."""
    mode = "DROPMALFORMED" if drop_unreadable else "PERMISSIVE"
    return spark.read.schema(schema).json(path, mode=mode)


def coerce_series(df: DataFrame, time_col: str | None = None, int_cols=()) -> DataFrame:
    """Bad dates and bad whole numbers become null; the group column becomes text."""
    casts = {c: F.col(c).cast("string").try_cast("double").cast("bigint") for c in int_cols if c in df.columns}
    if time_col in df.columns:
        casts[time_col] = F.col(time_col).cast("string").try_cast("date")
    if "party" in df.columns:
        casts["party"] = F.col("party").cast("string")
    return df.withColumns(casts) if casts else df


def read_series(
    spark: SparkSession, path, schema: T.StructType, time_col: str | None = None, int_cols=()
) -> DataFrame:
    """Every sound part file of a series folder, its cells coerced. A file with a line that is no JSON object is left out
    whole, as is one that cannot be read; ``spoiled_files`` names them. A folder without part files gives an empty table of
    the same layout."""
    raw = _marked_lines(spark, path, schema)
    bad = raw.filter(_BAD).select(F.col(_FILE).alias("_spoiled")).distinct()
    sound = raw.join(bad, F.col(_FILE) == F.col("_spoiled"), "left_anti")
    loose = (time_col, *int_cols)
    cells = [F.col(f.name) if f.name in loose else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return coerce_series(sound.select(*cells), time_col, int_cols)


def spoiled_files(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Report of the part files that ``read_series`` leaves out: ``file``, lines, bad lines, and one of the bad lines."""
    return _marked_lines(spark, path, schema).groupBy(F.col(_FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(_BAD).alias("bad"), F.min(F.when(F.col(_BAD), F.col("_line"))).alias("example"),
    ).filter("bad > 0")


_BAD, _FILE = "_bad_line", "_source_file"


def _marked_lines(spark, path, schema) -> DataFrame:
    """Records as text cells, with the file they come from; a line that is no object is marked. Blank lines do not count."""
    lines = (
        spark.read.option("ignoreCorruptFiles", "true").option("pathGlobFilter", "part-*.json").text(path)
        .select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias(_FILE)).filter(F.trim("_line") != "")
    )
    layout = ", ".join(f"`{name}` string" for name in [*schema.names, "_broken"])
    read = F.from_json("_line", layout, {"columnNameOfCorruptRecord": "_broken"})
    table = lines.select("_line", _FILE, F.inline(F.array(read)))
    bad = F.col("_broken").isNotNull() | ~F.startswith(F.ltrim("_line"), F.lit("{"))
    return table.withColumn(_BAD, bad).drop("_broken")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it. Where it is unset, a local master gets a folder
    of its own; on a cluster that would lose rows, so it raises."""
    known = spark.conf.get("spark.checkpoint.dir", None) or _own_dirs.get(spark.sparkContext.applicationId)
    if not known:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        known = _own_dirs[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="voxseries-")
    return known.rstrip("/")


_own_dirs: dict[str, str] = {}


def staged(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read back: one computation for all its readers, which survives the loss of
    the executor that wrote it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_scan(scan: DataFrame) -> DataFrame:
    """A scan that has fewer splits than the cluster has cores, dealt out to all of them.

    For small tables and files that cannot be split, ahead of costly work on each row. A scan
    with splits enough is returned as it is, so nothing is shuffled at scale. Select the needed
    columns first.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def union_parts(*parts: DataFrame) -> DataFrame:
    """Parts stacked by column name; a column missing from one part is null there."""
    first, *others = parts
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def to_json_lines(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """One JSON object per row in ``value``, as the writer below lays it down."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def write_jsonl(
    df: DataFrame, path: str, mode: str = "errorifexists", keep_nulls: bool = True
) -> None:
    """JSON lines, UTF-8 unescaped. The default refuses an existing target."""
    writer = df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower())
    writer.json(path)


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The ``value`` column as it is, one line per row."""
    df.select("value").write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by=()) -> DataFrame:
    """Parquet hand-over between stages; returns the table read back, with a short lineage.

    With ``by``, rows are first brought together per partition value, so that a value gets few
    files; AQE splits a value that is too large for one task.
    """
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)
