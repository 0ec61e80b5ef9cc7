"""Similarity join of documents on word n-grams, by prefix filtering.

Documents of one n-gram set are one class. A class's n-grams are put in one global order, rare first; two sets as similar as
asked share an n-gram in the short prefixes of both. Length, position and the spread of the n-grams over hash ranges rule out
most candidates; each pair left is verified once, on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxseries.llm.common import Stages, mix, pair_hash, text_bytes, text_digest, text_slices, tidy
from voxseries.llm.components import components

#: Slots of the document frequencies: the table's size does not depend on the data.
SLOTS = 1 << 19
#: Hash slots by which documents in question are found.
ASKED = 1 << 20
#: Hash ranges of the suffix filter: n-grams are counted in few, and in many it is only told if their number is odd.
RANGES, WORDS_OF_BITS = 16, 8

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, np.uint64)
_NEAR = _RANDOM.integers(0, 1 << 64, 1 << 12, np.uint64) | np.uint64(1)
_FAR = _RANDOM.integers(0, 1 << 64, 1 << 16, np.uint64) | np.uint64(1)
#: The first letters of a word weigh the same whether or not a long word is near: its hash is that of the word alone.
_FAR[0] = 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, document) of each word, A-Z lower-cased; words end at blanks and document bounds."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    at = np.flatnonzero(~blank)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bound = np.zeros(len(data) + 1, bool)
    bound[offsets] = True
    start = bound[at]
    start[0] = True
    start[1:] |= at[1:] != at[:-1] + 1
    first = np.flatnonzero(start)
    sizes = np.diff(np.append(first, len(at)))
    inside = np.arange(len(at)) - np.repeat(first, sizes)
    letters = data[at]
    letters = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
    weight = _NEAR[inside & 0xFFF]
    if sizes.max() > 1 << 12:
        weight = weight * _FAR[(inside >> 12) & 0xFFFF] + (inside >> 28).astype(np.uint64)
    hashed = np.add.reduceat(_BYTE[letters] * weight, first)
    return mix(hashed + sizes.astype(np.uint64)), np.searchsorted(offsets, at[first], side="right") - 1


def shingles_of(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct n-grams of texts, in order of both; shorter texts are one n-gram as a whole."""
    data, offsets = text_bytes(column)
    hashed, owner = words_of(data, offsets)
    counts = np.bincount(owner, minlength=len(column))
    ends = np.cumsum(counts)
    place = np.arange(len(owner)) - np.repeat(ends - counts, counts)
    left = np.repeat(counts, counts) - place
    # A full n-gram starts at each word with enough words after it; a short text starts one at its first word.
    grams = hashed + np.uint64(words)
    for k in range(1, words):
        after = np.concatenate([hashed[k:], np.zeros(min(k, len(hashed)), np.uint64)])
        grams = np.where(left > k, pair_hash(grams, after), grams)
    short = np.repeat(counts < words, counts)
    grams = np.where(short, mix(grams + np.repeat(counts, counts).astype(np.uint64)), grams)
    start = (left >= words) | (short & (place == 0))
    grams, owner = grams[start], owner[start]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], grams[new]


def frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """In how many documents the n-grams of each slot occur, over all documents: SLOTS numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                _, grams = shingles_of(part.column("text"), words)
                total += np.bincount((grams & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    table = docs.select("text").mapInArrow(tidy(run), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.int64)
    out[table["slot"].to_numpy().astype(np.int64)] = table["n"].to_numpy()
    return out


_LIGHT = "doc_id long, mark binary, n int, a long, b long, central byte, spread array<short>, odd array<long>, head array<long>"
_WHOLE = "doc_id long, a long, b long, grams array<long>"


def _digests(owner: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """(ends of the documents' n-grams, a, b): two sums of hashes tell sets apart."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)

    def summed(values: np.ndarray) -> pa.Array:
        totals = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return pa.array((totals[ends[1:]] - totals[ends[:-1]]).view(np.int64))

    return ends, summed(mix(grams)), summed(mix(grams ^ np.uint64(0xA5A5A5A55A5A5A5A)))


def light_sets(docs: DataFrame, words: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Of each document's n-grams: their number, digest, how common they are, spread over hash ranges, and the prefix.

    The prefix is the first n - ceil(n * percent / 100) + 1 in the global order; none where no other set can be near.
    """
    sent = docs.sparkSession.sparkContext.broadcast(counts.astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                owner, grams = shingles_of(part.column("text"), words)
                n = part.num_rows
                ends, a, b = _digests(owner, grams, n)
                sizes = np.diff(ends)
                common = counts[(grams & np.uint64(SLOTS - 1)).astype(np.int64)]
                order = np.lexsort((grams, common, owner))
                # A set of n has a partner of another set only if n / (n + 1) is similar enough.
                heads = np.where(sizes * 100 >= (sizes + 1) * percent, sizes - (sizes * percent + 99) // 100 + 1, 0)
                place = np.arange(len(grams)) - np.repeat(ends[:-1], sizes)
                head = grams[order][place < np.repeat(heads, sizes)]
                rarity = np.bincount(owner, np.log2(common + 1.0), minlength=n) / np.maximum(sizes, 1)
                spread = np.bincount(owner * RANGES + (grams >> np.uint64(60)).astype(np.int64), minlength=n * RANGES)
                odd = np.bincount(owner * (WORDS_OF_BITS * 64) + (mix(grams) >> np.uint64(32)).astype(np.int64) % (WORDS_OF_BITS * 64),
                                  minlength=n * WORDS_OF_BITS * 64) & 1
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").cast(pa.int64()), "mark": part.column("mark").cast(pa.binary()), "n": pa.array(sizes.astype(np.int32)), "a": a, "b": b,
                    "central": pa.array(np.minimum(rarity * 8, 127).astype(np.int8)),
                    "spread": pa.ListArray.from_arrays(np.arange(0, n * RANGES + 1, RANGES, dtype=np.int32),
                                                       pa.array(np.minimum(spread, 32767).astype(np.int16))),
                    "odd": pa.ListArray.from_arrays(
                        np.arange(0, n * WORDS_OF_BITS + 1, WORDS_OF_BITS, dtype=np.int32),
                        pa.array(np.packbits(odd.astype(np.uint8)).view(np.int64))),
                    "head": pa.ListArray.from_arrays(
                        np.concatenate([[0], np.cumsum(heads)]).astype(np.int32), pa.array(head.view(np.int64)))})

    return docs.mapInArrow(tidy(run), _LIGHT)


def whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """All n-grams of documents, with the digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                owner, grams = shingles_of(part.column("text"), words)
                ends, a, b = _digests(owner, grams, part.num_rows)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").cast(pa.int64()), "a": a, "b": b,
                    "grams": pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(grams.view(np.int64)))})

    return docs.mapInArrow(tidy(run), _WHOLE)


def _ceil(numerator: Column, denominator: int) -> Column:
    """Whole-number division, rounded up."""
    return ((numerator + F.lit(denominator - 1)) - F.pmod(numerator + F.lit(denominator - 1), F.lit(denominator))) / denominator


class _Join:
    """One run of the join: tables are written once and shared by its steps."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.docs, self.words, self.percent, self.spark = docs, words, percent, docs.sparkSession
        self.stages = Stages(self.spark, "ngram-join")
        counts = frequencies(docs, words)
        self.sets = self.stages.write(
            light_sets(docs, words, percent, counts).withColumn("row", F.monotonically_increasing_id()), "sets")
        groups = self.sets.filter("n > 0").groupBy("a", "b", "n").agg(F.min("row").alias("cls"), F.min("doc_id").alias("low"))
        groups = self.stages.write(groups, "groups")
        own = self.sets.select("row", "central", "spread", "odd", "head")
        full = self.stages.write(groups.join(own, groups["cls"] == own["row"]).drop("row"), "full")
        sets = self.stages.write(self.sets.select("row", "doc_id", "mark", "n", "a", "b"), "rows")
        self.stages.drop(self.sets, groups)
        #: (gram, cls, n, pos, central) of the prefix of each class, pos from 0.
        self.entries = self.stages.write(full.select("cls", "n", "central", F.posexplode("head").alias("pos", "gram")), "entries")
        self.sets, self.classes = sets, self.stages.write(full.drop("head", "central"), "classes")
        self.stages.drop(full)

    def fits(self, n: Column, pos: Column, other_n: Column, other_pos: Column) -> Column:
        """Length and positional filter: what is left after the shared n-gram must reach the overlap asked."""
        p = self.percent
        need = _ceil((n + other_n).cast("long") * p, 100 + p)
        return ((F.least(n, other_n).cast("long") * 100 >= F.greatest(n, other_n).cast("long") * p)
                & (F.least(n - pos, other_n - other_pos) >= need))

    def may_link(self, n: Column, odd: Column, other_n: Column, other_odd: Column) -> Column:
        """Suffix filter: sets of n-grams differ in at least as many members as there are ranges of differing parity."""
        need = _ceil((n + other_n).cast("long") * self.percent, 100 + self.percent)
        apart = sum((F.bit_count(odd[i].bitwiseXOR(other_odd[i])) for i in range(WORDS_OF_BITS)), F.lit(0))
        return apart <= n + other_n - 2 * need

    def verify(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(linked pairs, all pairs looked at); x is the side with many partners. Whole sets are compared, once a pair.

        Sets are made again from the texts in question: those whose id falls in a hash slot that is asked for. The slots are
        a broadcast of at most ASKED numbers.
        """
        p = self.percent
        pairs = self.stages.write(pairs.select("x", "y").distinct(), "pairs")
        light = self.classes.select("cls", "n", "spread", "odd", "a", "b", "low")
        side = lambda s: light.select(*[F.col(c).alias(s if c == "cls" else f"{c}_{s}") for c in light.columns])
        both = pairs.join(side("y"), "y").join(side("x"), "x")
        # The suffix filter needs no n-grams: ranges that differ by more than the slack rule a pair out.
        apart = F.aggregate(F.zip_with("spread_x", "spread_y", lambda a, b: F.abs(a.cast("int") - b.cast("int"))),
                            F.lit(0), lambda a, b: a + b)
        need = _ceil((F.col("n_x") + F.col("n_y")).cast("long") * p, 100 + p)
        likely = self.stages.write(both.filter(apart <= F.col("n_x") + F.col("n_y") - 2 * need)
                                   .filter(self.may_link(F.col("n_x"), F.col("odd_x"), F.col("n_y"), F.col("odd_y")))
                                   .drop("spread_x", "spread_y", "odd_x", "odd_y"), "likely")
        slot = lambda c: F.pmod(F.xxhash64(c), F.lit(ASKED))
        asked = likely.select(F.explode(F.array("low_x", "low_y")).alias("low")).select(slot("low").alias("slot")).distinct()
        some = (self.docs.withColumn("slot", slot("doc_id")).join(F.broadcast(asked), "slot", "left_semi")
                .select("doc_id", "text"))
        some = self.stages.write(whole_sets(some, self.words).withColumn("at", F.monotonically_increasing_id()), "asked")
        # Of repeated rows (same id, same set) one stands for all.
        one = some.groupBy("a", "b", "doc_id").agg(F.min("at").alias("at"))

        def placed(rows: DataFrame, s: str) -> DataFrame:
            on = ((F.col(f"a_{s}") == F.col("a")) & (F.col(f"b_{s}") == F.col("b"))
                  & F.col(f"low_{s}").eqNullSafe(F.col("doc_id")))
            return rows.join(one, on).drop("a", "b", "doc_id", f"a_{s}", f"b_{s}", f"low_{s}").withColumnRenamed("at", f"at_{s}")

        def with_grams(rows: DataFrame, s: str) -> DataFrame:
            return rows.join(some.select(F.col("at").alias(f"at_{s}"), F.col("grams").alias(f"grams_{s}")), f"at_{s}").drop(f"at_{s}")

        # Both sides are found by narrow rows first: sets move once for each side.
        compared = with_grams(with_grams(placed(placed(likely, "y"), "x"), "y"), "x").select(
            "x", "y", "n_x", "n_y", F.size(F.array_intersect("grams_x", "grams_y")).alias("shared"))
        linked = F.col("shared").cast("long") * 100 >= (F.col("n_x") + F.col("n_y") - F.col("shared")).cast("long") * p
        out = self.stages.write(compared.filter(linked).select("x", "y"), "links")
        self.stages.drop(some, likely)
        return out, pairs

    def run(self) -> DataFrame:
        return self.labelled().select(
            "row", "doc_id", F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

    def labelled(self) -> DataFrame:
        """Each row with the label of its component (null where it is empty) and the smallest id there."""
        stages, entries = self.stages, self.entries
        # An n-gram in one prefix only finds nobody. Else its hub is the most common one of its classes.
        hubs = entries.groupBy("gram").agg(F.count("*").alias("m"), F.max(F.struct("central", "cls", "n", "pos")).alias("hub"))
        hubs = stages.write(hubs.filter("m > 1").select(
            "gram", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("cls", "n", "pos")]), "hubs")
        live = stages.write(entries.join(hubs, "gram").drop("central"), "live")
        stages.drop(entries, hubs)
        # First each class meets the hub: in a group of copies nearly all link to it, and pairs inside a component need no
        # look.
        first = (live.filter(F.col("cls") != F.col("hub_cls"))
                 .filter(self.fits(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos")))
                 .select(F.col("hub_cls").alias("x"), F.col("cls").alias("y")))
        links, seen = self.verify(first)
        labels = components(stages, links)
        known = live.join(labels, live["cls"] == labels["node"], "left").select(
            "gram", "cls", "n", "pos", F.coalesce("label", "cls").alias("label"))
        known = stages.write(known, "labelled")
        stages.drop(live)
        # N-grams whose classes are all in one component are done.
        mixed = known.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
        open_ = known.join(mixed.select("gram"), "gram", "left_semi")
        parity = self.classes.select(F.col("cls").alias("of"), "odd")
        open_ = stages.write(open_.join(parity, open_["cls"] == parity["of"]).drop("of"), "open")
        stages.drop(known)
        p = self.percent
        # Of a pair the shorter one shows the n-gram in its shorter indexing prefix.
        head = F.col("pos") <= F.col("n") - _ceil(F.col("n").cast("long") * 2 * p, 100 + p)
        a = open_.filter(head).select("gram", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"),
                                      F.col("label").alias("ly"), F.col("odd").alias("oy"))
        b = open_.select("gram", F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"),
                         F.col("label").alias("lx"), F.col("odd").alias("ox"))
        longer = (F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") > F.col("y")))
        pairs = a.join(b, (a["gram"] == b["gram"]) & (F.col("lx") != F.col("ly")) & longer
                       & self.fits(F.col("nx"), F.col("px"), F.col("ny"), F.col("py"))
                       & self.may_link(F.col("nx"), F.col("ox"), F.col("ny"), F.col("oy"))).select("x", "y")
        pairs = stages.write(pairs.distinct(), "across")
        stages.drop(open_)
        old = seen.select(F.col("x").alias("u"), F.col("y").alias("v"))
        old = old.union(old.select("v", "u"))
        more, _ = self.verify(pairs.join(old, (F.col("x") == F.col("u")) & (F.col("y") == F.col("v")), "left_anti"))
        links = stages.write(links.union(more), "all-links")
        labels = components(stages, links)
        placed = self.classes.join(labels, self.classes["cls"] == labels["node"], "left").withColumn(
            "label", F.coalesce("label", "cls"))
        placed = stages.write(placed.select("a", "b", F.col("n").alias("size"), "low", "label"), "placed")
        least = placed.groupBy("label").agg(F.min("low").alias("component_id"))
        classes = stages.write(placed.join(least, "label").select("a", "b", "size", "label", "component_id"), "components")
        stages.drop(placed, self.classes, links)
        slim = self.sets
        s = slim.join(classes, (slim["a"] == classes["a"]) & (slim["b"] == classes["b"]) & (slim["n"] == classes["size"]), "left")
        return s.select("row", "doc_id", "mark", "n", "label", "component_id")


def link(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: row, doc_id, n_shingles, component_id (the smallest id that links reach).

    Words are runs of anything but blanks, A-Z lower-cased; a document is its set of distinct `words`-word n-grams, or with
    fewer words the whole sequence. Two documents link when 100 * intersection >= percent * union. Null and blank texts are
    empty and link with nothing. Null ids are never the smallest, if another is there. Repeated rows are one class.

    Documents with equal sets are one class before any join. Classes that share an n-gram are not paired with each other but
    with one hub first; after that only pairs across components are looked at, each once. Every such pair is looked at, so no
    connection is lost. Sets are 64-bit hashes; the driver sees a table of fixed size and one number per round.
    """
    return _Join(_rows(docs, id_column, text), words, percent).run()


def _rows(docs: DataFrame, id_column: str, text: str, mark: Column | None = None) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (F.lit(None) if mark is None else mark).cast("binary").alias("mark"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text",
                     ) -> DataFrame:
    """The documents with one row of each component: the smallest id's (null last), of one id's texts the one with the
    smallest digest, of repeated rows any. Empty documents and the documents' own columns stay.

    Rows are told apart by id and digest of the text, so a repeated id on other texts takes nothing with it.
    """
    mark = text_digest(F.col(text))
    join = _Join(_rows(docs, id_column, text, mark), words, percent)
    stages = Stages(docs.sparkSession, "near-copies")
    rows = stages.write(join.labelled().filter("n > 0").select("doc_id", "mark", "label"), "labels")
    join.stages.clear()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark"))
    best = rows.groupBy("label").agg(first.alias("first")).select(
        F.col("first.doc_id").alias("best_id"), F.col("first.mark").alias("best_mark"))
    keys = rows.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).agg(F.count("*").alias("same"))
    keys = keys.join(best, F.col("__id").eqNullSafe(F.col("best_id")) & (F.col("__mark") == F.col("best_mark")), "left")
    touched = stages.write(keys.filter("best_mark IS NULL OR same > 1").select(
        "__id", "__mark", F.col("best_mark").isNotNull().alias("__keep")), "touched")
    one = stages.write(touched.filter("__keep"), "one")
    tagged = docs.withColumn("__digest", mark)
    on = F.col(id_column).cast("long").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__mark"))
    # Rows alike in id and text that stay are rare: one of them comes back by a join of its own.
    again = tagged.join(one, on).dropDuplicates(["__id", "__mark"])
    return tagged.join(touched, on, "left_anti").select(*docs.columns).unionByName(again.select(*docs.columns))
