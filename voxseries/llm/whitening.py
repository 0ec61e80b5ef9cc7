"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of their centred rows.

With A the n centred rows, steps alternate u = Av and v = A'u, each made orthogonal to all earlier ones, so that A = U B V' with
a small bidiagonal B. Both products are sums over blocks of rows, made in the tasks. A left vector has a value per row; it is
kept as what it is a product of (u = Aw, w as long as a row) and made again in each block, so the rows are never written again,
and a lost task is simply run anew. The singular vectors of B give the components, its singular values their deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxseries.llm.common import Stages, tidy

#: Bytes of centred rows in a part of the table that all steps read, and sums that the driver adds up itself.
PART, FAN_IN = 1 << 26, 256
#: A residual below this share of the largest singular value counts as converged; what is below FLAT of it counts as none.
EXACT, FLAT = 1e-14, 1e-9
#: Entries beyond this take a row out: they fit no long after scaling.
_FAR = float(1 << 52)


def whole_numbers(vector: str, scale: int = 64, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift for each entry c."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(scale)).cast("long") + F.lit(shift))


def sound(vector: str, scale: int = 64) -> Column:
    """A vector that is there, with at least one entry, each of them finite and small enough for a whole number."""
    good = F.forall(vector, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c.cast("double") * F.lit(float(scale))) < F.lit(_FAR)), F.lit(False)))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & good


def _rows(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in longs where they hold it, else in Python integers."""
    most = max((abs(int(x.min(initial=0))), int(x.max(initial=0))))
    if n * most + max(map(abs, sums)) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _deviation(offsets: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; null beyond a long."""
    most = int(np.abs(offsets).max(initial=0))
    if offsets.dtype != object and most * most * offsets.shape[1] < 1 << 63:
        return (offsets * offsets).sum(axis=1).tolist()
    exact = (offsets.astype(object) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact.tolist()]


def _centre(n: int, sums: list[int]):
    """Rows to centred blocks: x - S/n as doubles, each rounded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a = (_offsets(_rows(batch, "x", len(sums)), n, sums) / n).astype(np.float64)
                yield pa.RecordBatch.from_pydict({"rows": pa.array([a.tobytes()], pa.binary())})

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for part in batch.column("sums"):
            part = np.frombuffer(part.as_py())
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})


class _Rows:
    """The centred rows, and sums over them."""

    def __init__(self, blocks: DataFrame, dim: int, parts: int):
        self.blocks, self.dim, self.parts = blocks, dim, parts

    def sum(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of `of(block)` over all blocks. Tasks add up their own; beyond FAN_IN tasks other tasks add those up."""
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for rows in batch.column("rows"):
                    part = of(np.frombuffer(rows.as_py()).reshape(-1, dim)).ravel()
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

        sums, many = self.blocks.mapInArrow(run, "sums binary"), self.parts
        while many > FAN_IN:
            many = -(-many // FAN_IN)
            sums = sums.repartition(many).mapInArrow(_added, "sums binary")
        return sum(np.frombuffer(row["sums"]) for row in sums.collect())


def _orthogonal(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            x = x - b * (b @ x)
    return x


def bidiagonalise(rows: _Rows, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors as rows, singular values), largest first: the `wanted` greatest that are not nought.

    Each step reads the rows once. Steps go on until the wanted triplets are exact to rounding, or the space is used up.
    Where the space of a start vector is exhausted (equal values, or fewer directions than dimensions), another start
    vector, orthogonal to all earlier ones, goes on.
    """
    dim, rng = rows.dim, np.random.default_rng(seed)
    right: list[np.ndarray] = []        # v_j
    makers: list[np.ndarray] = []       # w_j with u_j = A w_j, or noughts where there is no u_j
    images: list[np.ndarray] = []       # A'u_j
    top = 0.0

    def start() -> np.ndarray | None:
        v = _orthogonal(rng.standard_normal(dim), right)
        v = _orthogonal(v / np.linalg.norm(v), right)
        return v / np.linalg.norm(v)

    v = start()
    while True:
        right.append(v)
        k, w, shares = len(makers), np.array(makers).reshape(-1, dim).T, np.array(images).reshape(-1, dim)
        # u = Av less its share along the earlier left vectors, which is known from their images; what rounding left of it is
        # measured and taken off too, with one more pass where it is not tiny.
        maker = v - w @ (shares @ v)
        while True:

            def measured(a: np.ndarray) -> np.ndarray:
                u = a @ maker
                return np.concatenate([(a @ w).T @ u, [u @ u], a.T @ u])

            found = rows.sum(measured)
            again, square, image = found[:k], found[k], found[k + 1:]
            maker = maker - w @ again
            if np.linalg.norm(again) <= 1e-8 * np.sqrt(square) or square <= (FLAT * top) ** 2:
                break
        image = image - shares.T @ again
        alpha = float(np.sqrt(max(square - again @ again, 0.0)))
        top = max(top, alpha)
        if alpha > FLAT * top:
            makers.append(maker / alpha)
            images.append(image / alpha)
        # B = U'AV, from the images: row j holds (A'u_j)'V, two of its entries being alpha and beta.
        spread = np.array(images).reshape(-1, dim)
        rest = _orthogonal(images[-1], right) if alpha > FLAT * top else np.zeros(dim)
        beta = float(np.linalg.norm(rest))
        top = max(top, beta)
        small = spread @ np.array(right).T
        left, values, turned = np.linalg.svd(small, full_matrices=False)
        full = len(right) == dim
        take = min(wanted, len(values))
        if not full and take == wanted and alpha > FLAT * top and beta > FLAT * top:
            if np.all(beta * np.abs(left[-1, :take]) <= EXACT * values[0]):
                full = True
        if full:
            kept = [i for i in range(take) if values[i] > FLAT * values[0]] if take and values[0] > 0 else []
            return (turned @ np.array(right))[kept], values[kept]
        v = rest / beta if beta > FLAT * top else start()


@dataclass
class Whitening:
    """What whitening does to rows of one length."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    dim: int = field(init=False)

    def __post_init__(self):
        self.dim = len(self.sums)

    def transform(self, rows: DataFrame, id_column: str, out: str) -> DataFrame:
        """id, deviation (the sum of (n x - S)^2, exact; null beyond a long) and `whitened` of each row of x."""
        n, sums, dim = self.n, self.sums, self.dim
        turn = (self.components / np.sqrt(self.eigenvalues)[:, None]).T if len(self.eigenvalues) else np.zeros((dim, 0))
        schema = rows.select(id_column).schema.simpleString()[7:-1].replace(":", " ", 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                offsets = _offsets(_rows(batch, "x", dim), n, sums)
                y = (offsets / n).astype(np.float64) @ turn
                ends = np.arange(batch.num_rows + 1, dtype=np.int32) * turn.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_column), pa.array(_deviation(offsets), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel(), pa.float64()))],
                    names=[id_column, "deviation", out])

        return rows.select(id_column, "x").mapInArrow(tidy(run), f"{schema}, deviation long, {out} array<double>")


def fit(rows: DataFrame, dim: int, components: int = 32, stages: Stages | None = None) -> Whitening:
    """Whitening of a stored table of x, arrays of `dim` longs. All rows are the fit list. No rows, or rows that are all
    alike, have no components."""
    stages = stages or Stages(rows.sparkSession, "whitening")
    summed = rows.select(F.posexplode("x")).groupBy("pos").agg(
        F.count("*").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    sums = [0] * dim
    for row in summed:
        sums[row["pos"]] = int(Decimal(row["s"]))
    n = summed[0]["n"] if summed else 0
    if not n:
        return Whitening(0, sums, np.zeros((0, dim)), np.zeros(0), 0.0, 0.0)
    # Every step reads these rows, so they are laid out once, in parts of PART bytes at most.
    size = n * dim * 8
    parts = max(1, -(-size // PART), min(rows.sparkSession.sparkContext.defaultParallelism, size >> 20))
    blocks = stages.write(rows.select("x").repartition(parts).mapInArrow(tidy(_centre(n, sums)), "rows binary"), "centred")
    table = _Rows(blocks, dim, parts)
    vectors, values = bidiagonalise(table, min(components, dim))
    eigenvalues = values * values / n
    trace = float(table.sum(lambda a: np.array([(a * a).sum()]))[0]) / n
    turn = (vectors / np.sqrt(eigenvalues)[:, None]).T if len(values) else np.zeros((dim, 0))

    def moments(a: np.ndarray) -> np.ndarray:
        y = a @ turn
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    k, error = turn.shape[1], 0.0
    if k:
        both = table.sum(moments) / n
        spread = both[k:].reshape(k, k) - np.outer(both[:k], both[:k])
        error = float(np.abs(spread - np.eye(k)).max())
    stages.drop(blocks)
    return Whitening(n, sums, vectors, eigenvalues, trace, error)


def whiten(vectors: DataFrame, components: int = 32, id_column: str = "vec_id", vector: str = "embedding",
           scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row for each row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or has null, non-finite or (scaled) over-large entries are left out. Vectors of
    different lengths are whitened apart, each length on its own fit list. Components with no variance to speak of are not
    given: constant rows, or a single one, give no row. Repeated rows and ids count and come back as often as they are there;
    a null id is an id. Other columns are ignored. An empty table gives an empty result.

    The driver holds the components (some vectors) and sums as long as a vector; a step sends it a bounded number of them.
    """
    spark = vectors.sparkSession
    stages = Stages(spark, "whitening")
    rows = vectors.filter(sound(vector, scale)).select(F.col(id_column).alias("id"), whole_numbers(vector, scale, shift).alias("x"))
    rows = stages.write(rows, "rows")
    out = None
    for dim in sorted(r[0] for r in rows.groupBy(F.size("x")).count().collect()):
        same = rows.filter(F.size("x") == dim)
        model = fit(same, dim, components, stages)
        explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
        part = model.transform(same, "id", "y").select(
            "id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
            F.col("id").alias(id_column), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
            "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
            F.lit(model.identity_error).alias("identity_error"))
        out = part if out is None else out.unionByName(part)
    if out is not None:
        return out
    kind = vectors.schema[id_column].dataType.simpleString()
    return spark.createDataFrame([], f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, "
                                     "explained double, identity_error double")
