"""Approximate nearest neighbours by cross-polytope hashing.

A vector is turned by pseudo-rotations (signs, then a fast Hadamard transform, three times over) and belongs to the signed axis
nearest to it; long indexes refine the bucket by further turns. A query looks into the buckets of several tables, those first
where its own coordinate on the axis is largest. What it meets there is scored on the original vectors, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxseries.llm.common import Stages, tidy

#: Vectors a bucket has on average, vectors of a bucket that are scored at once, and found rows that a task keeps back.
BUCKET, PIECE, HELD = 256, 4096, 1 << 19
#: Norms within this ratio share their buckets: inside one, the angle orders vectors nearly as the inner product does.
BAND = 1.25

_CELL = "grp long, kind int, cls long, vector binary"
_CELL_ARROW = pa.schema([("grp", pa.int64()), ("kind", pa.int32()), ("cls", pa.int64()), ("vector", pa.binary())])


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, orthonormal; the length is a power of two."""
    rows, dim = x.shape
    step = 1
    while step < dim:
        y = x.reshape(rows, dim // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, dim)
        step *= 2
    return x / np.sqrt(dim)


class Tables:
    """The hash functions: `tables` of them, each of as many buckets as `size` vectors need."""

    def __init__(self, dim: int, size: int, tables: int, bucket: int, seed: int):
        self.dim, self.tables, self.seed = dim, tables, seed
        self.padded = 1 << max(0, dim - 1).bit_length()
        self.bits = max(1, (max(1, size) // bucket).bit_length() - 1)
        # Axes of each turn: all of them until the last one, which takes the bits that are left.
        most, left, self.axes = self.padded.bit_length(), self.bits, []
        while left > 0:
            self.axes.append(1 << (min(left, most) - 1))
            left -= most

    def probes(self, wanted: int) -> int:
        """Buckets a query looks into. More of them as the index grows, by a power below one of its size."""
        return min(round(wanted * 2 ** (0.6 * max(0, self.bits - 7))), self.tables * (1 << self.bits))

    def coordinates(self, x: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Of each table: the unit vectors' coordinates on both directions of the axes, for each turn."""
        unit = np.zeros((len(x), self.padded))
        unit[:, : self.dim] = x / np.abs(x).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        rng = np.random.default_rng(self.seed)
        for table in range(self.tables):
            turns = []
            for axes in self.axes:
                y = unit
                for _ in range(3):
                    y = hadamard(y * rng.choice([-1.0, 1.0], self.padded))
                turns.append(np.concatenate([y[:, :axes], -y[:, :axes]], axis=1))
            yield table, turns

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each vector in each table."""
        out = np.zeros((len(x), self.tables), np.int64)
        for table, turns in self.coordinates(x):
            code = np.zeros(len(x), np.int64)
            for y in turns:
                code = code * y.shape[1] + y.argmax(axis=1)
            out[:, table] = (table << self.bits) | code
        return out

    def ranked(self, x: np.ndarray, wanted: int) -> np.ndarray:
        """(rows, probes): the buckets nearest to each query over all tables, by the summed coordinates of their axes."""
        wanted = self.probes(wanted)
        score, code = [], []
        for table, turns in self.coordinates(x):
            best, at = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
            for y in turns:
                both = (best[:, :, None] + y[:, None, :]).reshape(len(x), -1)
                codes = (at[:, :, None] * y.shape[1] + np.arange(y.shape[1])[None, None, :]).reshape(len(x), -1)
                if both.shape[1] > wanted:
                    top = np.argpartition(-both, wanted - 1, axis=1)[:, :wanted]
                    both, codes = np.take_along_axis(both, top, 1), np.take_along_axis(codes, top, 1)
                best, at = both, codes
            score.append(best)
            code.append(at | (table << self.bits))
        score, code = np.concatenate(score, axis=1), np.concatenate(code, axis=1)
        if score.shape[1] > wanted:
            top = np.argpartition(-score, wanted - 1, axis=1)[:, :wanted]
            code = np.take_along_axis(code, top, 1)
        return code


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    lists = batch.column("vector")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def _index(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x = _vectors(part, tables.dim)
                packed = pa.array([row.tobytes() for row in x], pa.binary())
                codes = tables.buckets(x.astype(np.float64))
                for table in range(tables.tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes[:, table]), part.column("band"), part.column("cls"), packed],
                        names=["code", "band", "cls", "vector"])

    return run


def _probe(tables: Tables, wanted: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                codes = tables.ranked(_vectors(part, tables.dim).astype(np.float64), wanted)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("cls"), lists], names=["cls", "codes"])

    return run


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """(query, candidate, score): each pair once, the k best of each query and all that tie with the last of them."""
    q, c, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    once = np.ones(len(q), bool)
    once[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, s = q[once], c[once], s[once]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(q)))
    last = s[first + np.minimum(sizes, k) - 1] if len(first) else s
    keep = s >= np.repeat(last, sizes)
    return [q[keep], c[keep], s[keep]]


def score(queries: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, inner product) of the k best for each query, ties with the last included.

    The products of the best are summed anew, row by row in one order: equal vectors then have equal scores wherever they
    are scored.
    """
    rough = queries @ vectors.T
    kth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(queries), -np.inf)
    slack = 1e-12 * np.abs(rough).max(axis=1, initial=0)
    q, c = np.nonzero(rough >= (kth - slack)[:, None])
    return q, c, (queries[q] * vectors[c]).sum(axis=1)


def _search(dim: int, kind: str, k: int):
    """Cells in order of group, the vectors of a group before its queries, to the best pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        group, ids, vectors = None, [], []

        def rows(column) -> np.ndarray:
            return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim).astype(np.float64)

        def out(found) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["q", "c", "score"])

        for batch in batches:
            groups, sides = (batch.column(c).to_numpy() for c in ("grp", "kind"))
            edge = np.flatnonzero(np.concatenate([[True], (groups[1:] != groups[:-1]) | (sides[1:] != sides[:-1])]))
            for a, b in zip(edge, np.append(edge[1:], len(groups))):
                part = batch.slice(a, b - a)
                if groups[a] != group:
                    group, ids, vectors = groups[a], [], []
                own = part.column("cls").to_numpy()
                if sides[a] == 0:
                    ids.append(own)
                    vectors.append(rows(part.column("vector")))
                    continue
                if not ids:
                    continue
                ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                for s in range(0, len(own), 256):
                    q, c, v = score(rows(part.column("vector").slice(s, 256)), vectors[0], k)
                    held.append([own[s: s + 256][q], ids[0][c], v])
                if sum(len(x[0]) for x in held) > HELD:
                    held = [_best(held, k)]
                    if len(held[0][0]) > HELD // 2:
                        yield out(held.pop())
        if held:
            yield out(_best(held, k))

    return run


def _met(cells: DataFrame, dim: int, kind: str, k: int) -> DataFrame:
    spark = cells.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (cells.repartition(parts, "grp").sortWithinPartitions("grp", "kind")
            .mapInArrow(tidy(_search(dim, kind, k)), "q long, c long, score double"))


def sound(vector: str):
    """A vector that is there, neither empty nor all zero, without null or non-finite entries."""
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & good & F.exists(vector, lambda c: c != 0)


def nearest(vectors: DataFrame, is_query, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
            tables: int = 12, probes: int = 56, bucket: int = BUCKET, seed: int = 5) -> DataFrame:
    """The k nearest found for each row that `is_query` (a condition on vec_id) chooses: query_id, rank, vec_id, score.

    Nearness is the inner product. Rows with a null id, or a vector that is null, empty, zero, or has null or non-finite
    entries take no part. Vectors of different lengths do not meet. Ties go to the smaller id. Rows that share an id are
    all candidates, but not for a query of that id; of queries that share one, the one with the least vector asks. A query
    that meets fewer than k rows is compared with all of them, so fewer than k come back only where there are no more.
    Other columns are ignored. An empty table gives an empty result.

    Equal vectors are one class, hashed and scored once; a class is known by its k + 1 smallest ids, as no query can
    return more. Every class is in every table. A large bucket is cut into pieces, which all of its queries meet; nothing is
    capped. The index costs `tables` copies of the vectors in one shuffle, whatever the number of queries.
    """
    spark = vectors.sparkSession
    stages = Stages(spark, "nearest")
    rows = vectors.filter(F.col(id_column).isNotNull() & sound(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    rows = stages.write(rows.withColumns({"d1": F.xxhash64("vector"), "d2": F.xxhash64(F.lit(1), "vector")}), "rows")
    out = None
    for dim in sorted(r[0] for r in rows.groupBy(F.size("vector")).count().collect()):
        part = _nearest(stages, rows.filter(F.size("vector") == dim), is_query, k, dim, tables, probes, bucket, seed)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out


def _nearest(stages: Stages, rows: DataFrame, is_query, k: int, dim: int, tables: int, probes: int, bucket: int,
             seed: int) -> DataFrame:
    # A class keeps its k + 1 smallest ids, each with up to k of its repeats: more can be in no answer.
    ids = rows.groupBy("d1", "d2", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    first = Window.partitionBy("d1", "d2").orderBy("vec_id")
    ids = ids.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    ids = ids.groupBy("d1", "d2").agg(F.sort_array(F.collect_list(F.struct("vec_id", "copies"))).alias("ids"))
    # Of the queries of one id, the one with the least vector asks.
    asks = rows.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("vector", "d1", "d2")).alias("least"))
    asks = stages.write(asks.select("vec_id", F.col("least.d1").alias("q1"), F.col("least.d2").alias("q2")), "asks")
    asked = asks.select("q1", "q2").distinct().withColumn("asks", F.lit(True))
    classes = rows.groupBy("d1", "d2").agg(F.first("vector").alias("vector")).join(ids, ["d1", "d2"])
    classes = classes.join(asked, (F.col("d1") == F.col("q1")) & (F.col("d2") == F.col("q2")), "left")
    # The largest entry is taken out first, so that squares neither overflow nor vanish.
    most = F.array_max(F.transform("vector", lambda c: F.abs(c.cast("double"))))
    square = F.aggregate(F.transform("vector", lambda c: c.cast("double") / F.col("most")), F.lit(0.0), lambda s, c: s + c * c)
    classes = classes.withColumn("most", most)
    classes = stages.write(classes.select(
        "d1", "d2", "vector", "ids", F.coalesce("asks", F.lit(False)).alias("asks"),
        F.round((F.log("most") + F.log(square) / 2) / F.log(F.lit(BAND))).cast("int").alias("band"),
        F.monotonically_increasing_id().alias("cls")), "classes")
    kind = "<f4" if classes.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
    classes = classes if kind == "<f4" else classes.withColumn("vector", F.col("vector").cast("array<double>"))
    size = classes.count()
    hashes = Tables(dim, size, tables, bucket, seed)
    index = classes.select("cls", "band", "vector").mapInArrow(
        tidy(_index(hashes)), "code long, band int, cls long, vector binary")
    index = stages.write(index, "index")
    # Sizes of buckets decide into how many pieces each is cut; there are about as many as vectors by `bucket`, per table.
    sizes = index.groupBy("band", "code").count().select(
        "band", "code", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces"))
    sizes = stages.write(sizes, "sizes")
    group = F.xxhash64("band", "code", "piece").alias("grp")
    stored = index.join(sizes.filter("pieces > 1"), ["band", "code"], "left").withColumn(
        "piece", F.pmod(F.xxhash64("cls"), F.coalesce("pieces", F.lit(1))).cast("int"))
    stored = stored.select(group, F.lit(0).alias("kind"), "cls", "vector")
    asking = classes.filter("asks").select("cls", "vector")
    codes = asking.mapInArrow(tidy(_probe(hashes, probes)), "cls long, codes array<long>")
    codes = codes.select("cls", F.explode("codes").alias("code")).join(sizes, "code")
    codes = codes.select("cls", "band", "code", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    packed = asking.mapInArrow(tidy(_packed(dim)), "cls long, vector binary")
    wanted = codes.select("cls", group).join(packed, "cls").select("grp", F.lit(1).alias("kind"), "cls", "vector")
    found = stages.write(_met(stored.unionByName(wanted), dim, kind, k + 1), "found")
    answers = stages.write(_answers(found, classes, asks, k), "answers")
    # Queries that met fewer than k rows: against all of them, piece by piece.
    full = rows.count()
    met = answers.groupBy("query_id").count().filter(F.col("count") >= k)
    short = asks.join(met, asks["vec_id"] == met["query_id"], "left_anti").filter(F.lit(full > 0))
    few = stages.write(classes.join(short.select("q1", "q2").distinct(), (F.col("d1") == F.col("q1")) & (F.col("d2") == F.col("q2")),
                                    "left_semi").select("cls", "vector"), "few")
    if not few.limit(1).count():
        return answers
    pieces = -(-size // PIECE)
    every = classes.select("cls", "vector").mapInArrow(tidy(_packed(dim)), "cls long, vector binary").select(
        F.pmod(F.xxhash64("cls"), F.lit(pieces)).alias("grp"), F.lit(0).alias("kind"), "cls", "vector")
    again = few.mapInArrow(tidy(_packed(dim)), "cls long, vector binary").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))).alias("grp"), F.lit(1).alias("kind"), "cls", "vector")
    rest = _answers(_met(every.unionByName(again), dim, kind, k + 1), classes, short, k)
    return answers.join(met, "query_id", "left_semi").select("query_id", "rank", "vec_id", "score").unionByName(rest)


def _packed(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), pa.array([row.tobytes() for row in _vectors(batch, dim)], pa.binary())],
                names=["cls", "vector"])

    return run


def _answers(found: DataFrame, classes: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """Pairs of classes to the rows asked for: the k best other rows of each query."""
    # k + 1 classes are enough, as each has an id and one of them is the query's own; ties go by the classes' least ids.
    pairs = found.groupBy("q", "c").agg(F.max("score").alias("score"))
    slim = classes.select(F.col("cls").alias("c"), "ids")
    pairs = pairs.withColumn("near", F.rank().over(Window.partitionBy("q").orderBy(F.desc("score")))).filter(F.col("near") <= k + 1)
    pairs = pairs.join(slim, "c")
    place = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0]["vec_id"])
    pairs = pairs.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k + 1)
    mine = asks.join(classes.select("d1", "d2", F.col("cls").alias("q")), (F.col("q1") == F.col("d1")) & (F.col("q2") == F.col("d2")))
    rows = mine.select(F.col("vec_id").alias("query_id"), "q").join(pairs.select("q", "ids", "score"), "q")
    rows = rows.select("query_id", "score", F.explode("ids").alias("id")).filter(F.col("id.vec_id") != F.col("query_id"))
    rows = rows.select("query_id", "score", F.col("id.vec_id").alias("vec_id"),
                       F.explode(F.array_repeat(F.lit(0), F.col("id.copies"))).alias("copy"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
