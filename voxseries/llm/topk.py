"""Exact top-k inner products with block-at-a-time pruning.

Vectors are whole numbers in rows of a forward index: blocks of a range of documents, with the largest and smallest value of
each component. A query takes blocks in order of the score no member can exceed, and stops where that falls below its k-th.

Bounds are found from the extremes alone, before a vector moves: each query first meets the block of its greatest bound, and
then only blocks whose bound reaches the k-th score it has by then.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxseries.llm.common import Stages

#: Vectors in a stored block and in a block that is scored at once, and queries in a block of queries.
STORED, SCORED, QUERIES = 8192, 1024, 1024
#: Stored blocks of one group, and blocks of queries of one group at most: what meets in a task is bounded by both.
GROUP, ASKS = 8, 64
#: Groups of queries that are aimed at before a group holds more than one block of them.
SPREAD = 64
#: Stored blocks of one partition of the index: their extremes meet queries together.
RUN = 8 * GROUP

_BLOCK = ("block long, part int, dim int, width int, ids binary, vectors binary, most binary, least binary, "
          "seeds array<long>")


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest signed type that holds them."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def _extremes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest value of each component, for each run of SCORED vectors."""
    starts = np.arange(0, len(vectors), SCORED)
    return np.maximum.reduceat(vectors, starts, axis=0), np.minimum.reduceat(vectors, starts, axis=0)


def _pack(size: int):
    """Rows to blocks of at most `size` vectors of one length, in the order they come; `seeds` are those of the block's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def blocks(dim: int, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number
            ids, vectors, seeds = (np.concatenate(x) for x in zip(*waiting[dim]))
            while len(ids) >= least and len(ids):
                rows = _narrow(vectors[:size])
                high, low = _extremes(rows)
                known = np.unique(seeds[:size])
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([(part << 33) + number], pa.int64()), "part": pa.array([part], pa.int32()),
                    "dim": pa.array([dim], pa.int32()), "width": pa.array([rows.itemsize], pa.int32()),
                    "ids": pa.array([ids[:size].tobytes()], pa.binary()),
                    **{name: pa.array([x.tobytes()], pa.binary()) for name, x in (("vectors", rows), ("most", high), ("least", low))},
                    "seeds": pa.array([known[known >= 0]], pa.list_(pa.int64()))})
                number += 1
                ids, vectors, seeds = ids[size:], vectors[size:], seeds[size:]
            waiting[dim] = [(ids, vectors, seeds)]

        for batch in batches:
            column = batch.column("vector")
            if column.offset:
                column = pa.concat_arrays([column])
            ids, seeds = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "seed"))
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(offsets)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                rows = values[offsets[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0), np.int64)
                waiting.setdefault(dim, []).append((ids[at], rows, seeds[at]))
                if sum(len(x[0]) for x in waiting[dim]) >= size:
                    yield from blocks(dim, size)
        for dim in list(waiting):
            yield from blocks(dim, 1)

    return run


def _matrix(row: dict, name: str) -> np.ndarray:
    """The whole numbers of one block, a row for each vector (or each run of SCORED vectors)."""
    values = np.frombuffer(row[name], f"i{row['width']}")
    count = len(row["ids"]) // 8
    return values.reshape(count if name == "vectors" else -(-count // SCORED), row["dim"])


def _kind(queries: np.ndarray, *others: np.ndarray):
    """The fastest type in which every score is exact."""
    size = lambda x: max(-int(x.min(initial=0)), int(x.max(initial=0))) + 1
    largest = max(1, queries.shape[1]) * size(queries) * max(size(x) for x in others)
    return np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else object


def _bounds(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """[query, run]: the score that no vector of the run can exceed, exact in the type of the queries."""
    kind = queries.dtype
    return np.maximum(queries, 0) @ most.astype(kind).T + np.minimum(queries, 0) @ least.astype(kind).T


def search_blocks(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
                  known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best of each query; ties to the smaller id, equal ids are left out.

    `known` holds for each query a score that its k-th does not fall below, found elsewhere: lower ones are left out.
    """
    kind = _kind(queries, vectors)
    most, least = _extremes(vectors)
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    bound = _bounds(queries, most, least)
    order = np.argsort(-bound, axis=1, kind="stable")
    n = len(queries)
    kth = np.full(n, -np.inf, object if kind is object else float)
    if known is not None:
        kth[:] = known
    pool = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind))
    open_ = np.ones(n, bool)
    for step in range(bound.shape[1]):
        block = order[:, step]
        open_ &= bound[np.arange(n), block] >= kth
        if not open_.any():
            break
        found = [pool]
        for b in np.unique(block[open_]).tolist():
            rows = np.flatnonzero(open_ & (block == b))
            part = slice(b * SCORED, (b + 1) * SCORED)
            scores = queries[rows] @ vectors[part].T
            good = (scores >= kth[rows][:, None]) & (ids[part][None, :] != query_ids[rows][:, None])
            q, d = np.nonzero(good)
            found.append((rows[q], ids[part][d], scores[q, d]))
        q, d, s = (np.concatenate(x) for x in zip(*found))
        best = np.lexsort((d, -s, q))
        q, d, s = q[best], d[best], s[best]
        counts = np.bincount(q, minlength=n)
        rank = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
        keep = rank < k
        pool = (q[keep], d[keep], s[keep])
        last = rank[keep] == k - 1
        kth[pool[0][last]] = pool[2][last]
    return pool


def _known(row: dict, ids: np.ndarray) -> np.ndarray:
    """For each query of a block, its k-th score so far, or minus infinity. Whole numbers stay whole."""
    scores = {x["query_id"]: x["score"] for x in row["kths"] or ()}
    return np.array([scores.get(i, -np.inf) for i in ids.tolist()], object)


def _each_run(asks: pa.Table, heads: pa.Table) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
    """(block of queries, its ids, bounds of its queries for runs, stored block of each run)."""
    stored: dict[int, list[dict]] = {}
    for row in heads.to_pylist():
        stored.setdefault(row["dim"], []).append(row)
    for ask in asks.to_pylist():
        rows = stored.get(ask["dim"], [])
        if rows:
            most, least = (np.concatenate([_matrix(r, name) for r in rows]) for name in ("most", "least"))
            queries = _matrix(ask, "vectors")
            owner = np.repeat([r["block"] for r in rows], [-(-len(r["ids"]) // 8 // SCORED) for r in rows])
            yield ask, np.frombuffer(ask["ids"], np.int64), _bounds(queries.astype(_kind(queries, most, least)), most, least), owner


def _best_block(asks: pa.Table, heads: pa.Table) -> pa.Table:
    """For each query the stored block of its greatest bound."""
    found = [(ids, bound.max(axis=1).astype(float), owner[bound.argmax(axis=1)]) for _, ids, bound, owner in _each_run(asks, heads)]
    ids, bound, block = (np.concatenate([[], *x]) for x in (zip(*found) if found else ((), (), ())))
    return pa.table({"vec_id": pa.array(ids.astype(np.int64)), "bound": pa.array(bound.astype(float)),
                     "seed": pa.array(block.astype(np.int64))})


def _open_pairs(asks: pa.Table, heads: pa.Table) -> pa.Table:
    """Blocks of queries with the stored blocks in which the bound of a query reaches its k-th score."""
    found = []
    for ask, ids, bound, owner in _each_run(asks, heads):
        known = _known(ask, ids)
        known = known if bound.dtype == object else known.astype(float)
        blocks = np.unique(owner[(bound >= known[:, None]).any(axis=0)])
        found.append((np.full(len(blocks), ask["ask"]), blocks))
    ask, block = (np.concatenate([[], *x]) for x in (zip(*found) if found else ((), ())))
    return pa.table({"ask": pa.array(ask.astype(np.int64)), "block": pa.array(block.astype(np.int64))})


def quantised(df: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """vec_id and vector as floor(scale * x). Rows with a null id, vector, or a null or non-finite component are left out."""
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return (df.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).filter(sound)
            .select(F.col(id_column).cast("long").alias("vec_id"),
                    F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long")).alias("vector")))


def top_k(vectors: DataFrame, is_query, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
          scale: int = 64) -> DataFrame:
    """The k best rows for each row that `is_query` (a condition on vec_id) chooses: query_id, rank, vec_id, score.

    Vectors of different lengths do not meet. Rows that share an id are all candidates, but not for a query of that id; only
    one of them (the smallest vector) is a query. Fewer rows than k give all. Other columns are ignored.

    Queries are put in the order of the stored block with their greatest bound, so that a block of queries has few such
    blocks; with these it is scored first. Then the bounds are compared with the k-th scores, on the extremes of blocks
    alone, and only pairs of blocks that are still open move vectors, in groups bounded on both sides. Where bounds rule
    nothing out, a vector moves once for each 65,536 queries, in one byte a component if its numbers allow.
    """
    stages = Stages(vectors.sparkSession, "topk")
    rows = quantised(vectors, id_column, vector, scale)
    # Neighbours in this order share their largest component, which tightens the bounds of a block.
    largest = F.array_max(F.transform("vector", lambda x, i: F.struct(F.abs(x).alias("size"), i.alias("at"), x.alias("x"))))
    rows = stages.write(rows.withColumn("near", F.coalesce(largest["at"] * F.signum(largest["x"]), F.lit(0))), "vectors")
    parts = int(rows.count() // (STORED * RUN)) + 1
    blocks = stages.write(
        rows.withColumn("seed", F.lit(-1)).repartitionByRange(parts, "near", "vec_id").sortWithinPartitions("near", "vec_id")
        .select("vec_id", "vector", "seed").mapInArrow(_pack(STORED), _BLOCK), "blocks")
    heads = blocks.select("block", "part", "dim", "width", "ids", "most", "least")
    asked = stages.write(rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")), "asked")

    def numbered(packed: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Blocks of queries with their number (over one narrow row per block) and group; how many groups there are."""
        packed = stages.write(packed, name)
        order = Window.orderBy("block")
        numbers = stages.write(packed.select("block").withColumn("ask", (F.row_number().over(order) - 1).cast("long")), "numbers")
        count = numbers.count()
        each = min(ASKS, max(1, count // SPREAD))
        return packed.join(numbers, "block").drop("block", "part").withColumn("group", F.floor(F.col("ask") / each)), -(-count // each)

    def against_heads(asks: DataFrame, groups: int, run: Callable, schema: str) -> DataFrame:
        """Groups of blocks of queries beside the extremes of each partition of the index."""
        left = asks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        right = heads.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(groups, 1) - 1).cast("long"))))
        return left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInArrow(run, schema)

    def scored(asks: DataFrame, pairs: DataFrame) -> DataFrame:
        """The best of each pair of blocks; every pair is scored once."""
        # Blocks of a partition have consecutive numbers, so a shift puts GROUP of them together.
        cells = (pairs.withColumn("near", F.shiftright("block", GROUP.bit_length() - 1))
                 .join(asks.select("ask", "group"), "ask"))
        left = asks.select("ask", "dim", "width", "ids", "vectors", "kths").join(cells.groupBy("ask", "group", "near").agg(F.collect_list("block").alias("with")), "ask")
        right = blocks.select("block", "dim", "width", "ids", "vectors").join(
            cells.select("block", F.col("group").alias("asking"), F.col("near").alias("cell")).distinct(), "block")
        return left.groupBy("group", "near").cogroup(right.groupBy("asking", "cell")).applyInArrow(
            meet, "ask long, query_id long, vec_id long, score long")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        stored, out = {r["block"]: r for r in b.to_pylist()}, []
        for ask in a.to_pylist():
            # Only the last block of a partition may be short, and it comes last: runs of SCORED stay the stored ones.
            picked = [stored[i] for i in sorted(ask["with"])]
            ids = np.frombuffer(b"".join(r["ids"] for r in picked), np.int64)
            query_ids = np.frombuffer(ask["ids"], np.int64)
            q, d, s = search_blocks(query_ids, _matrix(ask, "vectors"), ids, np.concatenate([_matrix(r, "vectors") for r in picked]),
                                    k, _known(ask, query_ids))
            out.append((np.full(len(q), ask["ask"]), query_ids[q], d, s.astype(np.int64)))
        columns = zip(*out) if out else ((), (), (), ())
        return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *x]), pa.int64())
                         for name, x in zip(("ask", "query_id", "vec_id", "score"), columns)})

    first, groups = numbered(asked.withColumn("seed", F.lit(-1)).mapInArrow(_pack(QUERIES), _BLOCK), "queries")
    seeds = against_heads(first, groups, _best_block, "vec_id long, bound double, seed long").groupBy("vec_id").agg(
        F.max_by("seed", F.struct("bound", "seed")).alias("seed"))
    seeded = stages.write(asked.join(seeds, "vec_id"), "seeded")
    asks, groups = numbered(
        seeded.repartitionByRange(int(seeded.count() // (QUERIES * RUN)) + 1, "seed", "vec_id")
        .sortWithinPartitions("seed", "vec_id").mapInArrow(_pack(QUERIES), _BLOCK), "seeded_queries")
    none = F.lit(None).cast("array<struct<query_id:long,score:long>>")
    near = stages.write(asks.select("ask", F.explode("seeds").alias("block")), "near")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = stages.write(scored(asks.withColumn("kths", none), near).withColumn("rank", F.row_number().over(order))
                        .filter(F.col("rank") <= k), "best")
    # A block of queries has one k-th score for each of its queries at most.
    kths = best.filter(F.col("rank") == k).groupBy("ask").agg(F.collect_list(F.struct("query_id", "score")).alias("kths"))
    asks = stages.write(asks.join(kths, "ask", "left"), "bounded")
    still = stages.write(against_heads(asks, groups, _open_pairs, "ask long, block long")
                         .join(near, ["ask", "block"], "left_anti"), "open")
    found = best.drop("rank").unionByName(scored(asks, still))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
