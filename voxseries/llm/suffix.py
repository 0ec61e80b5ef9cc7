"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every place where a string of `threshold` bytes starts is a suffix to be ordered through that depth only; places whose strings
are equal are exactly the repeats. Writing out one key per byte would cost many times the input, so the most significant
digits are chosen to settle ranges of places at once. For a place, its anchor is the least-hashed of the `gram`-byte strings
inside its window, leftmost first; it depends on the window alone, so equal windows have equal anchors at equal distances.

- Pass 1, digit: the anchor's string. One record stands for the run of places that share an anchor.
- Pass 2, digit: distance to the anchor in steps of STEP, and the bytes common to all windows of that step.
- Pass 3, digit: the distance itself, and the whole window.

After each pass a group of one leaves. A group whose records agree in all bytes that their windows cover is settled too: all
its windows are repeats. Only records of mixed groups go to the next pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries.llm.common import Stages, pair_hash, text_bytes, text_slices, tidy

STEP = 12
#: Hash slots by which the documents in question are found: a broadcast of at most so many numbers.
SLOTS = 1 << 20
_CHUNK = 1 << 17
_BYTE = np.random.default_rng(20240301).integers(0, 1 << 64, 256, np.uint64)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

_RECORD = "id long, tag long, lo int, hi int, more int, anchor int, g long, c long, n int"
_ARROW = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("more", pa.int32()),
                    ("anchor", pa.int32()), ("g", pa.int64()), ("c", pa.int64()), ("n", pa.int32())])


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a string from those of its halves."""
    x = b ^ (b >> np.uint64(32))
    x *= _C1
    x += a
    x *= _C2
    x ^= x >> np.uint64(29)
    return x


class Depth:
    """Hashes of the strings of fixed lengths that start at each place of a buffer."""

    def __init__(self, threshold: int):
        self.threshold = threshold
        self.gram = 1 << max(0, (2 * threshold // 3).bit_length() - 1)
        self.width = threshold - self.gram + 1

    def hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(of `gram` bytes, of `threshold` bytes)."""
        h, size = _BYTE[data], 1
        while size < self.gram:
            h = _join(h[:-size], h[size:])
            size *= 2
        return h, self.long(h, self.threshold)

    def long(self, h: np.ndarray, size: int) -> np.ndarray:
        """Of `size` bytes (gram to 2 * gram), by the first and the last gram in them."""
        far = size - self.gram
        return pair_hash(h[: len(h) - far], h[far:])

    def anchors(self, h: np.ndarray) -> np.ndarray:
        """The anchor of each place: the least hash in `width` places, leftmost first."""
        key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= self.width:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        rest = self.width - size
        if rest:
            key = np.minimum(key[:-rest], key[rest:])
        return (key & np.uint64((1 << 20) - 1)).astype(np.int64)


def _union(h_lo: np.ndarray, h_hi: np.ndarray, hi_lo: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The hash of all bytes that the windows from lo to hi cover (no two of them are further apart than a window)."""
    return pair_hash(pair_hash(h_lo, h_hi), (hi_lo.astype(np.uint64) << np.uint64(32)) + off.astype(np.uint64))


def _first_pass(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        depth = Depth(threshold)
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 22):
                data, offsets = text_bytes(part.column("text"))
                ids, tags = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
                for start in range(0, max(len(data) - threshold + 1, 0), _CHUNK):
                    piece = data[start: start + _CHUNK + threshold - 1]
                    h, whole = depth.hashes(piece)
                    anchor = depth.anchors(h)
                    place = np.arange(len(anchor)) + start
                    doc = np.searchsorted(offsets, place, side="right") - 1
                    valid = np.flatnonzero(place + threshold <= offsets[doc + 1])
                    if not len(valid):
                        continue
                    at = anchor[valid]
                    new = np.ones(len(valid), bool)
                    new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(valid)) - 1
                    lo, hi, at = valid[first], valid[last], at[first]
                    g = h[at]
                    c = _union(whole[lo], whole[hi], hi - lo, at - lo)
                    owner = doc[lo]
                    # Runs inside a run of one byte are all alike: they become one record.
                    same = np.zeros(len(lo), bool)
                    same[1:] = (g[1:] == g[:-1]) & (c[1:] == c[:-1]) & (lo[1:] == hi[:-1] + 1) & (owner[1:] == owner[:-1])
                    head = np.flatnonzero(~same)
                    tail = np.append(head[1:], len(lo)) - 1
                    base = start - offsets[owner[head]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[owner[head]]), pa.array(tags[owner[head]]),
                        pa.array((lo[head] + base).astype(np.int32)), pa.array((hi[head] + base).astype(np.int32)),
                        pa.array((hi[tail] - hi[head]).astype(np.int32)), pa.array((at[head] + base).astype(np.int32)),
                        pa.array(g[head].view(np.int64)), pa.array(c[head].view(np.int64)),
                        pa.array((tail - head + 1).astype(np.int32))], schema=_ARROW)

    return run


def _next_pass(threshold: int, step: int):
    """Records of the ranges in `todo` (lo, hi, anchor, g), cut by distance to the anchor in steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        depth = Depth(threshold)
        for batch in batches:
            for part in text_slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                h, whole = depth.hashes(data)
                core = depth.long(h, threshold - step + 1) if step > 1 else whole
                todo = part.column("todo")
                sizes, values = todo.value_lengths().to_numpy(), todo.flatten()
                fields = {n: values.field(n).to_numpy(zero_copy_only=False) for n in ("lo", "hi", "anchor", "g")}
                doc = np.repeat(np.arange(len(sizes)), sizes)
                lo, hi, anchor = (fields[n].astype(np.int64) for n in ("lo", "hi", "anchor"))
                # Distances fall from anchor - lo to anchor - hi.
                far, near = (anchor - lo) // step, (anchor - hi) // step
                pieces = far - near + 1
                r = np.repeat(np.arange(len(lo)), pieces)
                number = far[r] - (np.arange(len(r)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
                a = np.maximum(lo[r], anchor[r] - number * step - step + 1)
                b = np.minimum(hi[r], anchor[r] - number * step)
                base = offsets[doc[r]]
                middle = core[base + anchor[r] - number * step]
                g = pair_hash(pair_hash(fields["g"].astype(np.int64).view(np.uint64)[r], number.astype(np.uint64)), middle)
                c = _union(whole[base + a], whole[base + b], b - a, anchor[r] - a)
                ids, tags = (part.column(x).to_numpy(zero_copy_only=False)[doc[r]] for x in ("id", "tag"))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids), pa.array(tags), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                    pa.array(np.zeros(len(r), np.int32)), pa.array(anchor[r].astype(np.int32)), pa.array(g.view(np.int64)),
                    pa.array(c.view(np.int64)), pa.array(np.ones(len(r), np.int32))], schema=_ARROW)

    return run


_KEY = ["id", "tag"]


def _settle(stages: Stages, records: DataFrame, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """(ranges of repeated windows, ranges to look into) of one pass. Groups are only summed, never gathered."""
    groups = records.groupBy("g").agg(F.sum("n").alias("total"), F.min("c").alias("c1"), F.max("c").alias("c2"))
    groups = stages.write(groups.filter("total > 1").select("g", (F.col("c1") == F.col("c2")).alias("alike")), "groups")
    # Rows alike in id and text have the same records: they become one, which weighs as many.
    hot = records.join(groups, "g").groupBy(*[c for c in records.columns if c != "n"], "alike").agg(F.sum("n").alias("n"))
    hot = stages.write(hot, "hot")
    stages.drop(records)
    whole = ["id", "tag", "lo", (F.col("hi") + F.col("more")).alias("hi")]
    done = hot.filter("alike").select(*whole)
    mixed = hot.filter("NOT alike")
    kinds = mixed.groupBy("g", "c").agg(F.sum("n").alias("total"), F.min(F.struct("id", "tag", "lo")).alias("one"))
    kinds = stages.write(kinds.withColumnsRenamed({"g": "kg", "c": "kc"}), "kinds")
    judged = mixed.join(kinds, (F.col("g") == F.col("kg")) & (F.col("c") == F.col("kc")))
    judged = stages.write(judged.select(
        *_KEY, "lo", "hi", "more", "anchor", "g", "total",
        (F.struct("id", "tag", "lo") == F.col("one")).alias("chosen")), "judged")
    done = done.union(judged.filter("total > 1").select(*whole))
    if last:
        return done, None
    # Of equal ranges one goes on, as a partner for the others; the rest is settled.
    return done, judged.filter("total = 1 OR chosen").select(*_KEY, "lo", "hi", "anchor", "g")


def _slot():
    return F.pmod(F.xxhash64(*_KEY), F.lit(SLOTS))


def remove_repeats(docs: DataFrame, threshold: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, spans (array of start, end in bytes), kept (binary).

    A byte goes if a string of `threshold` bytes that covers it starts at another place of any document too, its own included.
    Strings are judged on the input. Null texts are empty; shorter texts keep all; repeated rows are other places, so they
    lose everything that is long enough. An empty table gives an empty result; other columns are ignored.

    Documents are known by id and a hash of the text, so rows alike in both share one set of spans; their records are folded
    into weights, so the work grows with their number and not with its square. Texts move only where a
    group is mixed or something is to be removed: such documents are picked by hash slots, a broadcast of fixed size.
    Groups are summed, and hot ones split by the join; no group is gathered.
    """
    stages = Stages(docs.sparkSession, "suffix")
    rows = docs.select(F.col(id_column).alias("own"), F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("text"))

    def picked(ranges: DataFrame, how: str) -> DataFrame:
        slots = ranges.select(_slot().alias("slot")).distinct()
        return rows.withColumn("slot", _slot()).join(F.broadcast(slots), "slot", how).drop("slot")

    records = stages.write(rows.select(*_KEY, "text").mapInArrow(tidy(_first_pass(threshold)), _RECORD), "records")
    done, todo = _settle(stages, records, False)
    parts = [done]
    for step in (STEP, 1):
        if step > max(1, threshold - Depth(threshold).gram):
            continue
        listed = todo.groupBy(*_KEY).agg(F.collect_list(F.struct("lo", "hi", "anchor", "g")).alias("todo"))
        listed = stages.write(listed, "todo")
        asked = picked(listed, "left_semi").select(*_KEY, "text").join(listed, _KEY)
        records = stages.write(asked.mapInArrow(tidy(_next_pass(threshold, step)), _RECORD), "records")
        done, todo = _settle(stages, records, step == 1)
        parts.append(done)
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    spans = stages.write(found.groupBy(*_KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("windows")), "spans")
    out = "own {}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary".format(
        rows.schema["own"].dataType.simpleString())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 22):
                lines = []
                windows = part.column("windows")
                for own, body, some in zip(part.column("own"), part.column("text"), windows):
                    raw = np.frombuffer((body.as_py() or "").encode(), np.uint8)
                    edge = np.zeros(len(raw) + 1, np.int64)
                    if some.is_valid and len(some):
                        lo = some.values.field("lo").to_numpy().astype(np.int64)
                        hi = some.values.field("hi").to_numpy().astype(np.int64)
                        np.add.at(edge, lo, 1)
                        np.add.at(edge, hi + threshold, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    lines.append({"own": own.as_py(), "n_bytes": len(raw), "n_removed": int(gone.sum()),
                                  "spans": [{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()],
                                  "kept": raw[~gone].tobytes()})
                yield pa.RecordBatch.from_pylist(lines, schema=_cut_schema(part.schema.field("own").type))

    touched = picked(spans, "left_semi").join(spans, _KEY, "left").select("own", "text", "windows").mapInArrow(tidy(cut), out)
    clean = picked(spans, "left_anti").select(
        "own", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"), F.col("text").cast("binary").alias("kept"))
    return clean.union(touched).withColumnRenamed("own", id_column)


def _cut_schema(own: pa.DataType) -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.schema([("own", own), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)),
                      ("kept", pa.binary())])
