"""Token ids as binary shards, compressed by Re-Pair grammars.

A shard holds whole documents in order of id, about SHARD_IDS ids. Frequent adjacent pairs are replaced by nonterminals, round
after round, within a document only. A shard stores its rules with the length of their expansions, so a document, or the id
at a place in it, is decoded from the document's own symbols.

Shards are the rows of a Parquet dataset, so Spark commits them whole and a lost executor leaves no half file behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxseries.llm.common import text_slices, tidy
from voxseries.llm.word_table import load

SHARD_IDS = 1 << 20
#: Pairs are replaced while one occurs this often within the documents of its shard; a round replaces this many kinds of pairs.
LEAST, PAIRS = 8, 8192

#: One row per shard. docs: ids (int64), known (bool), lengths in ids and in symbols (uint32); rules: left, right (uint32);
#: expansion (uint32 per rule); symbols below `base` are ids, others rule number + base. `first`: ids before, in this part.
SHARD = ("part int, shard int, first long, n_ids long, base int, doc_ids binary, known binary, doc_lengths binary, "
         "doc_symbols binary, rules binary, expansion binary, symbols binary")


def compress(ids: np.ndarray, docs: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, document number of each symbol, rules as rows of left and right).

    A round counts pairs within documents, takes the most frequent kinds, and replaces their occurrences where the pair is
    at least as frequent as the overlapping ones to its left and right; others wait for the next round. The most frequent
    pair is always replaced, so each round shortens the symbols; the last one finds no pair that occurs LEAST times.

    Replacing only makes kinds of pairs that hold a new symbol, so the count of an older kind never rises: a place whose
    kind is rare is not looked at again until a neighbour is replaced. Symbols form a linked list, and a round's work follows the
    places still open.
    """
    n = len(ids)
    symbols, alive = ids.astype(np.int64), np.ones(n, bool)
    span, total, rules = np.int64(base + n), base, []
    # -1 beyond the ends of a document; the last entry of `grade` stands for it.
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.flatnonzero(np.append(docs[1:] != docs[:-1], True)) if n else np.zeros(0, np.int64)
    after[ends] = -1
    before[np.append(0, ends[:-1] + 1) if n else ends] = -1
    grade = np.full(n + 1, np.iinfo(np.int32).max, np.int32)
    flags, table = np.zeros(n, bool), np.full(1 << 20, -1, np.int32)
    places = np.flatnonzero(after >= 0)
    while len(places):
        keys = symbols[places] * span + symbols[after[places]]
        slots = _slot(keys)
        full = np.bincount(slots, minlength=1 << 20)[slots] >= LEAST
        places, keys, slots = places[full], keys[full], slots[full]
        ordered = np.sort(keys)
        edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
        counts = np.diff(np.append(edges, len(ordered)))
        often = np.flatnonzero(counts >= LEAST)
        if not len(often):
            break
        kinds = ordered[edges[often]]
        pairs = kinds[np.argsort(-counts[often], kind="stable")[:PAIRS]]
        # Of pairs in one hash slot the most frequent is looked up in this round, the others wait for the next.
        _, first = np.unique(_slot(pairs), return_index=True)
        pairs = pairs[np.sort(first)]
        table[_slot(kinds)] = len(pairs)
        table[_slot(pairs)] = np.arange(len(pairs), dtype=np.int32)
        own = table[slots]
        table[_slot(kinds)] = -1
        open_ = own >= 0
        places, keys, own = places[open_], keys[open_], own[open_]
        chosen = np.append(pairs, -1)[own] == keys
        at, own = places[chosen], own[chosen]
        grade[at] = own
        take = (own <= grade[before[at]]) & (own <= grade[after[at]])
        grade[at] = grade[n]
        at, own = at[take], own[take]
        # Of overlapping places of one pair (a a a) every second one is replaced, from the left.
        starts = np.append(True, before[at[1:]] != at[:-1])
        even = (np.arange(len(at)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]) % 2 == 0
        at, own = at[even], own[even]
        used = np.bincount(own, minlength=len(pairs)) > 0
        rules.append(np.stack([pairs[used] // span, pairs[used] % span], axis=1))
        symbols[at] = total + (np.cumsum(used) - 1)[own]
        total += int(used.sum())
        gone = after[at]
        alive[gone] = False
        after[at] = beyond = after[gone]
        before[beyond[beyond >= 0]] = at[beyond >= 0]
        left = before[at]
        flags[places] = flags[at] = flags[left[left >= 0]] = True
        flags[gone] = False
        places = np.flatnonzero(flags)
        flags[places] = False
        places = places[after[places] >= 0]
    return symbols[alive], docs[alive], np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def _slot(keys: np.ndarray) -> np.ndarray:
    """One of 2**20 hash slots."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def expansions(rules: np.ndarray, base: int) -> np.ndarray:
    """The number of ids of each rule; a rule only names earlier ones."""
    sizes = np.ones(base + len(rules), np.int64)
    at = 0
    while at < len(rules):
        end = at + 1
        limit = base + at
        # Rules of one round name symbols of the rounds before it only: they are summed together.
        outside = np.flatnonzero((rules[at:] >= limit).any(axis=1))
        end = at + (int(outside[0]) if len(outside) else len(rules) - at)
        end = max(end, at + 1)
        sizes[base + at: base + end] = sizes[rules[at:end]].sum(axis=1)
        at = end
    return sizes[base:]


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids of a run of symbols: all nonterminals are replaced at once, until none is left."""
    while len(symbols) and symbols.max() >= base:
        high = symbols >= base
        ends = np.cumsum(np.where(high, 2, 1))
        out = np.empty(int(ends[-1]), np.int64)
        out[ends - 1] = np.where(high, rules[np.where(high, symbols - base, 0), 1] if len(rules) else 0, symbols)
        out[ends[high] - 2] = rules[symbols[high] - base, 0]
        symbols = out
    return symbols


class Shard:
    """A shard read back: documents, and places in them, are decoded one by one."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
        self.sizes = np.frombuffer(row["expansion"], "<u4").astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], "<u4")
        self.doc_ids, self.known = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["known"], bool)
        self.lengths = np.frombuffer(row["doc_lengths"], "<u4").astype(np.int64)
        self.ends = np.cumsum(np.frombuffer(row["doc_symbols"], "<u4").astype(np.int64))

    def document(self, i: int) -> np.ndarray:
        start = self.ends[i - 1] if i else 0
        return expand(self.symbols[start: self.ends[i]].astype(np.int64), self.rules, self.base)

    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all symbols one after the other, where each begins): for reading many documents."""
        sizes = np.concatenate([np.ones(self.base, np.int64), self.sizes])
        flat = expand(np.arange(len(sizes)), self.rules, self.base).astype("<u4")
        return flat, np.cumsum(sizes) - sizes

    def documents(self, lo: int, hi: int, flat: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """The packed ids of documents lo to hi - 1."""
        symbols = self.symbols[self.ends[lo - 1] if lo else 0: self.ends[hi - 1]].astype(np.int64)
        sizes = np.ones(len(symbols), np.int64)
        high = symbols >= self.base
        sizes[high] = self.sizes[symbols[high] - self.base]
        ends = np.cumsum(sizes)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[symbols] - (ends - sizes), sizes)].tobytes()
        cuts = np.concatenate([[0], np.cumsum(self.lengths[lo:hi])]) * 4
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def token(self, i: int, at: int) -> int:
        """The id at a place of a document, by the expansion lengths: only one path of the grammar is walked."""
        start = self.ends[i - 1] if i else 0
        symbols = self.symbols[start: self.ends[i]].astype(np.int64)
        sizes = np.where(symbols >= self.base, self.sizes[np.maximum(symbols - self.base, 0)] if len(self.sizes) else 1, 1)
        ends = np.cumsum(sizes)
        k = int(np.searchsorted(ends, at, side="right"))
        symbol, at = int(symbols[k]), at - int(ends[k] - sizes[k])
        while symbol >= self.base:
            left, right = self.rules[symbol - self.base].tolist()
            size = int(self.sizes[left - self.base]) if left >= self.base else 1
            symbol, at = (left, at) if at < size else (right, at - size)
        return symbol


def shards(docs: DataFrame, path: str, end_id: int | None = 0, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode texts and pack them: rows of SHARD, to be written as Parquet.

    Documents go by ascending id (null first; equal ids by a hash of their text); null texts are empty. `end_id` follows
    each document (None: nothing). The only shuffle is the range sort of the texts; a part ends with a smaller shard. A
    document longer than a shard makes a shard of its own. An empty table gives no shard. Other columns are ignored.
    """
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, part = load(path), TaskContext.get().partitionId()
        base = max([int(bpe.ids.max(initial=0)), *bpe.special.values(), end_id or 0]) + 1
        names: list[int | None] = []
        coded: list[bytes] = []
        waiting = first = number = 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(c) // 4 for c in coded], np.int64)
            ids = np.frombuffer(b"".join(coded), "<u4")
            symbols, owner, rules = compress(ids, np.repeat(np.arange(len(coded)), lengths), base)
            row = {
                "part": part, "shard": number, "first": first, "n_ids": len(ids), "base": base,
                "doc_ids": np.array([n or 0 for n in names], "<i8").tobytes(),
                "known": np.array([n is not None for n in names], bool).tobytes(),
                "doc_lengths": lengths.astype("<u4").tobytes(),
                "doc_symbols": np.bincount(owner, minlength=len(coded)).astype("<u4").tobytes(),
                "rules": rules.astype("<u4").tobytes(), "expansion": expansions(rules, base).astype("<u4").tobytes(),
                "symbols": symbols.astype("<u4").tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=_SHARD_ARROW)

        for batch in batches:
            for piece in text_slices(batch, "text", 1 << 19):
                for name, c in zip(piece.column("id").to_pylist(), bpe.encode([t or "" for t in piece.column("text").to_pylist()])):
                    names.append(name)
                    coded.append(c + tail)
                    waiting += len(coded[-1]) // 4
                    if waiting >= SHARD_IDS:
                        yield shard()
                        first, number, waiting = first + waiting, number + 1, 0
                        names.clear()
                        coded.clear()
        if coded:
            yield shard()

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    return ordered.mapInArrow(tidy(run), SHARD)


_SHARD_ARROW = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("base", pa.int32()),
    *((n, pa.binary()) for n in ("doc_ids", "known", "doc_lengths", "doc_symbols", "rules", "expansion", "symbols"))])


def read_documents(written: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents of written shards: id, start (ids before it), n_tokens, ids_crc32, ids (packed).

    One sum per part is set against the others in a single window and sent to all tasks; shards are read where they lie.
    """
    parts = written.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard, at = Shard(row), row["offset"] + row["first"]
                flat, begins = shard.spelled()
                for lo in range(0, len(shard.doc_ids), 512):
                    some = range(lo, min(lo + 512, len(shard.doc_ids)))
                    coded = shard.documents(lo, some.stop, flat, begins)
                    lengths = shard.lengths[lo: lo + 512]
                    starts = at + np.cumsum(lengths) - lengths
                    at += int(lengths.sum())
                    yield pa.RecordBatch.from_pydict({
                        id_column: pa.array([int(shard.doc_ids[j]) if shard.known[j] else None for j in some], pa.int64()),
                        "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(c) for c in coded], pa.int64()),
                        "ids": pa.array(coded, pa.binary())})

    return written.join(F.broadcast(offsets), "part").mapInArrow(
        tidy(run), f"{id_column} long, start long, n_tokens long, ids_crc32 long, ids binary")
