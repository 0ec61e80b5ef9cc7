"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring has `cells` equal arcs. Each shard owns `nodes` of their starts; a key belongs to the last owned start at or
before its cell. A shard's load is bounded by its share of the rows, and the shares add up to the rows: counts differ by
one at most. Keys beyond a full shard go on clockwise to the next owner with room.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxseries.llm.common import Stages

#: Alike rows that one task numbers in one go.
RUN = 4096


def ring(shards: int, nodes: int = 64, cells: int = 1 << 16) -> list[int]:
    """The owner of each cell. A shard's places depend on its number alone; a taken place is passed on clockwise."""
    owner = [-1] * cells
    for node in range(nodes):
        for shard in range(shards):
            at = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8], "big") % cells
            while owner[at] >= 0:
                at = (at + 1) % cells
            owner[at] = shard
    last = next(o for o in reversed(owner) if o >= 0)
    for at in range(cells):
        last = owner[at] = owner[at] if owner[at] >= 0 else last
    return owner


def spill(owner: list[int], counts: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """(cell, first rank, shard, first slot) of the pieces: own keys first, then the overflow clockwise.

    Its input is one number per cell, whatever the rows; so is its work, but for one step per piece.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slot, pieces, over = [0] * shards, [], []

    def place(cell: int, rank: int, shard: int, n: int) -> None:
        pieces.append((cell, rank, shard, slot[shard]))
        slot[shard] += n
        room[shard] -= n

    for cell, n in enumerate(counts):
        take = min(n, room[owner[cell]])
        if take:
            place(cell, 0, owner[cell], take)
        if n > take:
            over.append((cell, take, n - take))
    starts = [c for c in range(len(owner)) if owner[c] != owner[c - 1]] or [0]
    after = 0
    for cell, rank, n in over:
        while after < len(starts) and starts[after] <= cell:
            after += 1
        step = after
        while n:
            shard = owner[starts[step % len(starts)]]
            take = min(n, room[shard])
            if take:
                place(cell, rank, shard, take)
                rank, n = rank + take, n - take
            step += 1
    return pieces


def assign(docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text", nodes: int = 64,
           cells: int = 1 << 16) -> DataFrame:
    """One row per document: id, size (UTF-8 bytes + 8), text_crc32, shard, slot.

    A key is the hash of id and text checksum, so repeated ids spread too; a null id or text is a value like any other
    (null text: empty). Ties on the ring are ordered by id, size and checksum; rows equal in all of them are
    interchangeable, so they are counted before any shuffle and numbered from their count, in runs of RUN rows that spread
    over tasks. Texts are read once and do not move. Distinct rows are ranked per cell, a 1/65536 of them; the driver sees one
    count per cell. An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    stages = Stages(docs.sparkSession, "ring")
    rows = docs.select(F.col(id_column).alias("id"), (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
    point = F.xxhash64("id", "text_crc32")
    alike = rows.groupBy("id", "size", "text_crc32").agg(F.count("*").alias("n"))
    alike = stages.write(alike.withColumn("cell", F.pmod(point, F.lit(cells)).cast("int")).withColumn("point", point), "keys")
    counts = [0] * cells
    for row in alike.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    pieces = spill(ring(shards, nodes, cells), counts, shards)
    table = docs.sparkSession.createDataFrame(
        pieces, T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("rank", T.LongType()),
                              T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]))
    table = table.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("rank", "shard", "slot"))).alias("pieces"))
    order = Window.partitionBy("cell").orderBy("point", F.col("id").asc_nulls_last(), "size", "text_crc32")
    ranked = alike.withColumn("end", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = ranked.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))).alias("from"))
    first = F.col("end") - F.col("n")
    numbered = runs.repartition("cell", "id", "text_crc32", "from").withColumn("at", F.explode(F.sequence(
        first + F.col("from"), F.least(first + F.col("from") + F.lit(RUN), F.col("end")) - 1)))
    piece = F.element_at(F.filter("pieces", lambda p: p["rank"] <= F.col("at")), -1)
    # At most one row per cell: a fixed size.
    return (numbered.join(F.broadcast(table), "cell").withColumn("piece", piece)
            .select(F.col("id").alias(id_column), "size", "text_crc32", F.col("piece.shard").alias("shard"),
                    (F.col("piece.slot") + F.col("at") - F.col("piece.rank")).alias("slot")))
