"""Exact deduplication against a persistent digest index, in DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxseries.llm.common import Stages


def normalised(text: Column) -> Column:
    """A text with each run of blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """A table of digests, bucketed and sorted by digest: one row for each distinct text ever taken in.

    The files under `path` are the index; opening it again registers them in the session's catalog under `table`.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, id_type: T.DataType | None = None, buckets: int = 64):
        self.spark, self.table, self.path, self.buckets = spark, table, path, buckets
        kind = (id_type or T.LongType()).simpleString()
        if not spark.catalog.tableExists(table):
            spark.sql(f"CREATE TABLE {table} (digest BINARY, keep_id {kind}, ingest STRING) USING parquet "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def ingest(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text", ingest: str | None = None) -> DataFrame:
        """Take documents in; returns one row per document: id, digest, keep_id, group_size, kept.

        Each digest carries the name of the call that brought it (`ingest`, a new one unless given). A row is kept only if its
        digest came with this call, so a row that is delivered again is dropped; a call that is repeated under its name, for
        example because it died after the append, answers as the first time.

        Texts are equal when their normalised forms are; null is the empty text. A text the index knows is dropped in
        favour of the row it was taken in with; of new equal texts the row with the smallest id stays (null ids last, one
        row of a repeated id). `group_size` counts the equal rows of this call. Texts never move: only digests are
        shuffled, first summed per task. Other columns are ignored. An empty table gives an empty result.

        The digests are staged, so the scan and the hashing happen once, and a row number given before the stage is fixed
        by it. New digests are found by a sort-merge anti-join against the buckets and appended to them.
        """
        stages, ingest = Stages(self.spark, "digests"), ingest or uuid.uuid4().hex
        rows = stages.write(docs.select(
            F.col(id_column).alias("id"), digest(F.col(text)).alias("digest"),
            F.monotonically_increasing_id().alias("row")), "rows")
        first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))
        groups = stages.write(rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
        known = self.spark.table(self.table)
        fresh = groups.join(known.hint("merge"), "digest", "left_anti")
        (fresh.select("digest", F.col("first.id").alias("keep_id"), F.lit(ingest).alias("ingest"))
         .repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)
        # The index holds exactly one row per digest. It is read as plain files here, so that both sides of this join are
        # shuffled and a digest with a third of the rows can be split.
        kept = self.spark.read.schema(known.schema).parquet(self.path)
        settled = stages.write(groups.join(kept.hint("merge"), "digest"), "settled")
        new = (F.col("ingest") == ingest) & (F.col("first.row") == F.col("row"))
        return rows.join(settled, "digest").select(
            F.col("id").alias(id_column), "digest", "keep_id", "group_size", new.alias("kept"))


def drop_copies(index: DigestIndex, docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns. One shuffle of the documents, by digest."""
    kept = index.ingest(docs, id_column, text)
    same = kept.filter(F.col(id_column).eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(
        F.count("*").alias("__same"), F.max("kept").alias("__new"), F.first("keep_id").alias("__id"))
    same = same.filter("__new").withColumnRenamed("digest", "__digest")
    tagged = docs.withColumn("__mark", digest(F.col(text)))
    joined = tagged.join(same, (tagged["__mark"] == same["__digest"]) & tagged[id_column].eqNullSafe(same["__id"]))
    # Repeated rows (same id, same text) all match; one of them stays. Ids that occur once never meet the second branch.
    once = joined.filter("__same = 1").select(*docs.columns)
    return once.unionByName(joined.filter("__same > 1").dropDuplicates(["__digest"]).select(*docs.columns))
