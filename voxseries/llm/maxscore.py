"""Ranked lexical search by MaxScore with bounds on pairs of terms.

The index is cut into blocks of documents. For the terms that the queries hold, a block has the list of each term with its
impacts, and for chosen pairs of a query's terms the list of documents that hold both, with the largest joint impact. A
document gets from a pair at most the joint maximum or the larger single one, which is less than the sum of two maxima. A
query adds up these bounds: blocks, and documents inside them, that cannot reach the k-th score known so far are passed over.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxseries.llm.common import Stages, text_slices, tidy

#: Documents and bytes of text in a block, bytes of query texts searched at once.
BLOCK, BYTES, ASKED = 2048, 1 << 22, 1 << 23

# Bytes of a term: digits, letters (A-Z as a-z) and all beyond ASCII. All others part terms.
_TERM = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


@dataclass
class Asked:
    """The queries of one round: their texts' terms, numbered; queries are numbered by their place."""

    vocabulary: dict[bytes, int]
    queries: list[list[int]]

    @classmethod
    def of(cls, texts: list[bytes]) -> Asked:
        vocabulary: dict[bytes, int] = {}
        return cls(vocabulary, [sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)}) for text in texts])

    def units(self, weight: list[int]) -> list[list[tuple[int, int]]]:
        """Each query's terms in pairs of like weight, the rarest first; a term left over is paired with itself.

        Rare terms seldom meet in a block: their joint maximum is then nought, and the pair counts as one term.
        """
        out = []
        for query in self.queries:
            order = sorted((t for t in query if weight[t] > 0), key=lambda t: (-weight[t], t))
            out.append([(a, b) for a, b in zip(order[::2], order[1::2] + order[-1:])])
        return out


@dataclass
class Corpus:
    documents: int
    terms: int
    weight: list[int]

    @classmethod
    def of(cls, documents: int, terms_: int, holders: list[int]) -> Corpus:
        # A term that no document holds has no list; its weight is of no account.
        return cls(documents, terms_, [
            math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) if df else 0 for df in holders])

    def impacts(self, weight: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 100 - 90 + (90 * length * self.documents) // max(self.terms, 1)
        return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _lists(vocabulary: dict[bytes, int]):
    """Texts to blocks: ids, lengths, and the list of each asked term (documents, occurrences), in order of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            for part in text_slices(batch, "text", BYTES):
                for start in range(0, part.num_rows, BLOCK):
                    yield block(part.slice(start, BLOCK), number)

    def block(part: pa.RecordBatch, number) -> pa.RecordBatch:
        lengths, term, doc, tf = [], [], [], []
        for at, text in enumerate(part.column("text").cast(pa.binary())):
            found = terms(text.as_py() or b"") if text.is_valid else []
            lengths.append(len(found))
            counts = Counter(map(number, found))
            counts.pop(None, None)
            term.extend(counts.keys())
            tf.extend(counts.values())
            doc.extend([at] * len(counts))
        term, doc, tf = np.array(term, np.int32), np.array(doc, np.int32), np.array(tf, np.int64)
        order = np.argsort(term, kind="stable")
        names, starts = np.unique(term[order], return_index=True)
        ids = part.column("id")
        return pa.RecordBatch.from_pydict({
            "ids": pa.array([ids.fill_null(0).to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "named": pa.array([ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()),
            "lengths": pa.array([np.array(lengths, np.int64).tobytes()], pa.binary()),
            "documents": pa.array([sum(n > 0 for n in lengths)], pa.int64()), "size": pa.array([sum(lengths)], pa.int64()),
            "terms": pa.array([names.astype(np.int32).tolist()], pa.list_(pa.int32())),
            "holders": pa.array([np.diff(np.append(starts, len(term))).astype(np.int32).tolist()], pa.list_(pa.int32())),
            "docs": pa.array([doc[order].tobytes()], pa.binary()), "tf": pa.array([tf[order].tobytes()], pa.binary())})

    return run


_LISTS = ("ids binary, named binary, lengths binary, documents long, size long, terms array<int>, holders array<int>, "
          "docs binary, tf binary")
_BLOCKS = ("block long, ids binary, named binary, terms binary, starts binary, docs binary, impacts binary, pairs binary, "
           "joint binary, pair_starts binary, both binary, bounds binary")


@dataclass
class Block:
    """Lists of a block of documents."""

    size: int
    starts: dict[int, tuple[int, int]]
    docs: np.ndarray
    impacts: np.ndarray

    def list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts.get(term, (0, 0))
        return self.docs[a:b], self.impacts[a:b]

    def most(self, term: int) -> int:
        return int(self.list(term)[1].max(initial=0))

    def both(self, a: int, b: int) -> tuple[np.ndarray, int]:
        """The documents that hold two terms, and the largest sum of their impacts in one."""
        (da, ia), (db, ib) = self.list(a), self.list(b)
        docs, i, j = np.intersect1d(da, db, assume_unique=True, return_indices=True)
        return docs, int((ia[i] + ib[j]).max(initial=0))


def _bounded(asked: Asked, corpus: Corpus):
    """Blocks with impacts, pair lists, joint maxima, and the bound of each query's score in the block."""
    units = asked.units(corpus.weight)
    weight = np.array(corpus.weight, np.int64)
    pairs = sorted({u for q in units for u in q if u[0] != u[1]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, holders = np.array(row["terms"], np.int32), np.array(row["holders"], np.int64)
                lengths, docs = np.frombuffer(row["lengths"], np.int64), np.frombuffer(row["docs"], np.int32)
                impacts = corpus.impacts(np.repeat(weight[names], holders) if len(names) else np.zeros(0, np.int64),
                                         np.frombuffer(row["tf"], np.int64), lengths[docs])
                ends = np.concatenate([[0], np.cumsum(holders)])
                block = Block(len(lengths), dict(zip(names.tolist(), zip(ends[:-1].tolist(), ends[1:].tolist()))), docs, impacts)
                most = {t: block.most(t) for t in names.tolist()}
                lists, joint, at = [], {}, []
                for n, (a, b) in enumerate(pairs):
                    if a in most and b in most:
                        both, joint[a, b] = block.both(a, b)
                        lists.append(both)
                        at.append(n)
                bounds = [sum(max(most.get(a, 0), most.get(b, 0), joint.get((a, b), 0)) for a, b in q) for q in units]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]], pa.int64()), "ids": pa.array([row["ids"]], pa.binary()),
                    "named": pa.array([row["named"]], pa.binary()), "terms": pa.array([names.tobytes()], pa.binary()),
                    "starts": pa.array([ends.astype(np.int64).tobytes()], pa.binary()), "docs": pa.array([row["docs"]], pa.binary()),
                    "impacts": pa.array([impacts.tobytes()], pa.binary()),
                    "pairs": pa.array([np.array(at, np.int32).tobytes()], pa.binary()),
                    "joint": pa.array([np.array([joint[pairs[n]] for n in at], np.int64).tobytes()], pa.binary()),
                    "pair_starts": pa.array([np.cumsum([0, *map(len, lists)]).astype(np.int64).tobytes()], pa.binary()),
                    "both": pa.array([np.concatenate([np.zeros(0, np.int32), *lists]).astype(np.int32).tobytes()], pa.binary()),
                    "bounds": pa.array([np.array(bounds, np.int64).tobytes()], pa.binary())})

    return run, units, pairs


def search(block: Block, joint: dict[tuple[int, int], tuple[np.ndarray, int]], query: list[tuple[int, int]],
           floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a block that may reach `floor`, exact; documents that cannot are passed over.

    Pairs are taken in order of their bounds. A document is looked at for the last pair it has a term of: the bounds of the
    pairs before it and what it holds of this one (one term, or both) must reach the floor together.
    """
    none = (np.zeros(0, np.int32), 0)
    units = []
    for a, b in query:
        single = (block.most(a), block.most(b) if b != a else 0)
        both = joint.get((a, b), none)
        bound = max(*single, both[1])
        if bound:
            units.append((bound, a, b, single, both))
    units.sort(key=lambda u: u[:3])
    before = np.cumsum([0, *(u[0] for u in units)]).tolist()
    open_ = np.zeros(block.size, bool)
    for n, (_, a, b, single, both) in enumerate(units):
        for docs, most in ((block.list(a)[0], single[0]), (block.list(b)[0], single[1]), both):
            if most and before[n] + most >= floor:
                open_[docs] = True
    score = np.zeros(block.size, np.int64)
    for n in range(len(units) - 1, -1, -1):
        if not open_.any():
            break
        _, a, b, _, _ = units[n]
        for term in {a, b}:
            docs, impacts = block.list(term)
            score[docs] += impacts
        open_ &= score + before[n] >= floor
    docs = np.flatnonzero(open_ & (score > 0))
    return docs, score[docs]


def _read(row: dict, pairs: list[tuple[int, int]]) -> tuple[Block, dict, np.ndarray, np.ndarray]:
    ids, named = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["named"], np.uint8)
    names, starts = np.frombuffer(row["terms"], np.int32).tolist(), np.frombuffer(row["starts"], np.int64).tolist()
    block = Block(len(ids), dict(zip(names, zip(starts[:-1], starts[1:]))), np.frombuffer(row["docs"], np.int32),
                  np.frombuffer(row["impacts"], np.int64))
    at, both = np.frombuffer(row["pairs"], np.int32).tolist(), np.frombuffer(row["both"], np.int32)
    edges, most = np.frombuffer(row["pair_starts"], np.int64).tolist(), np.frombuffer(row["joint"], np.int64).tolist()
    joint = {pairs[n]: (both[a:b], m) for n, a, b, m in zip(at, edges[:-1], edges[1:], most)}
    return block, joint, ids, named


def _best(pool: list[tuple], k: int) -> list[tuple]:
    return sorted(pool, key=lambda r: (-r[2], r[1] is None, r[1] or 0))[:k]


def _searched(units, pairs, floors: np.ndarray, k: int, chosen):
    """The k best documents of each query in the blocks of a task. `chosen` gives the queries of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor, pools = floors.copy(), {}
        for batch in batches:
            for row in batch.to_pylist():
                bounds = np.frombuffer(row["bounds"], np.int64)
                asked = [q for q in chosen(row) if bounds[q] > 0 and bounds[q] >= floor[q]]
                if not asked:
                    continue
                block, joint, ids, named = _read(row, pairs)
                for q in asked:
                    docs, scores = search(block, joint, units[q], int(floor[q]))
                    if len(docs) > k:
                        order = np.lexsort((ids[docs], 1 - named[docs], -scores))[:k]
                        docs, scores = docs[order], scores[order]
                    found = [(q, int(ids[d]) if named[d] else None, int(s)) for d, s in zip(docs, scores)]
                    pools[q] = _best(pools.get(q, []) + found, k)
                    if len(pools[q]) == k:
                        floor[q] = max(floor[q], pools[q][-1][2])
        rows = [r for pool in pools.values() for r in pool]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))],
            names=["query", "doc_id", "score"])

    return run


_FOUND = "query int, doc_id long, score long"


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the blocks of a task, the one with the largest bound for each query."""
    best, at = None, None
    for batch in batches:
        for block, bounds in zip(batch.column("block").to_pylist(), batch.column("bounds").to_pylist()):
            bounds = np.frombuffer(bounds, np.int64)
            if best is None:
                best, at = bounds.copy(), np.full(len(bounds), block, np.int64)
            else:
                better = bounds > best
                best[better], at[better] = bounds[better], block
    if best is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(best), dtype=np.int32)), pa.array(best), pa.array(at)],
                                         names=["query", "bound", "block"])


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text: str = "text",
         item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k documents of highest score for each item: item_id, rank, doc_id, score. Documents that score nothing are left out.

    Terms are runs of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. Null and empty texts have none: such
    documents are found by nobody and not counted, such items find nothing. Equal scores go to the smaller id, null last.
    Repeated rows are documents, or items, of their own. Other columns are ignored. Empty tables give an empty result.

    Items are searched in rounds of about ASKED bytes of text, whose terms go to every task; documents are read once a round.
    What a task holds is a block of documents and k rows for each query of the round.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "maxscore")
    asked = stages.write(items.select(F.col(item_column).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"),
                                      F.monotonically_increasing_id().alias("row")), "items")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = int(total // ASKED) + 1
    kind = items.schema[item_column].dataType.simpleString()
    out = None
    for n in range(rounds):
        # A hash shares the items out: the texts of a round come to the driver, about ASKED bytes of them.
        part = asked.filter(F.pmod(F.xxhash64("row"), F.lit(rounds)) == n).orderBy("row").collect()
        found = _round(stages, docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")),
                       Asked.of([r["text"].encode() for r in part]), k)
        names = spark.createDataFrame([(i, r["item_id"], r["row"]) for i, r in enumerate(part)],
                                      f"query int, item_id {kind}, row long")
        found = found.join(names, "query")
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select(F.col("item_id").alias(item_column), "rank", F.col("doc_id").alias(id_column), "score")


def _round(stages: Stages, docs: DataFrame, asked: Asked, k: int) -> DataFrame:
    lists = docs.mapInArrow(tidy(_lists(asked.vocabulary)), _LISTS)
    lists = stages.write(lists.withColumn("block", F.monotonically_increasing_id()), "lists")
    size = lists.agg(F.sum("documents").alias("documents"), F.sum("size").alias("size")).first()
    holders = [0] * len(asked.vocabulary)
    held = lists.select(F.explode(F.arrays_zip("terms", "holders")).alias("t")).groupBy("t.terms").agg(F.sum("t.holders").alias("df"))
    for row in held.collect():  # as many as the round's terms
        holders[row["terms"]] = row["df"]
    corpus = Corpus.of(size["documents"] or 0, size["size"] or 0, holders)
    run, units, pairs = _bounded(asked, corpus)
    index = stages.write(lists.mapInArrow(tidy(run), _BLOCKS), "index")
    stages.drop(lists)
    # First each query searches the block with the largest bound; the k-th score there is a floor for all others.
    seeds = index.select("block", "bounds").mapInArrow(_seeds, "query int, bound long, block long")
    seeds = seeds.groupBy("query").agg(F.max(F.struct("bound", "block")).alias("best")).filter("best.bound > 0")
    first = {row["query"]: row["best"]["block"] for row in seeds.collect()}
    by_block: dict[int, list[int]] = {}
    for query, block in first.items():
        by_block.setdefault(block, []).append(query)
    floors = np.zeros(len(asked.queries), np.int64)
    start = index.filter(F.col("block").isin(list(by_block))) if by_block else index.limit(0)
    start = stages.write(start.mapInArrow(
        tidy(_searched(units, pairs, floors, k, lambda row: by_block[row["block"]])), _FOUND), "first")
    for row in start.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") == k).collect():
        floors[row["query"]] = row["least"]
    everyone = range(len(asked.queries))

    def others(row: dict) -> list[int]:
        done = set(by_block.get(row["block"], ()))
        return [q for q in everyone if q not in done]

    rest = stages.write(index.mapInArrow(tidy(_searched(units, pairs, floors, k, others)), _FOUND), "rest")
    return start.unionByName(rest)
