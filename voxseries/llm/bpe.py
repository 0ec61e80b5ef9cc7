"""Byte-level BPE by speculation and verification.

Words are proposed as greedy longest matches. A proposal is the encoding if and only if every adjacent pair of its tokens
is compatible, that is: merging the bytes of both by rank never crosses the seam. The pairs of all new words of a slice
are checked at once; only words with a failing pair are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxseries.llm.common import replaced, text_slices, tidy

#: Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words a worker remembers in each of two generations. It bounds memory only.
_REMEMBERED = 300_000

#: Bytes up to which failing words are merged together; longer ones go one by one, in n log n.
_SHORT = 48


#: Texts without a character beyond Latin letters and common punctuation are split by a plain pattern with the classes
#: written out, which is faster; only the others can hold characters this Python does not know.
_BEYOND_LATIN = re.compile("[^\x00-\u02ff\u2010-\u2027]")


def _latin_pattern() -> re.Pattern:
    """PATTERN for Latin texts. The first branches differ in their first letter, so their order is free."""
    plain = [chr(c) for c in [*range(0x300), *range(0x2010, 0x2028)]]
    letters = "".join(c for c in plain if unicodedata.category(c)[0] == "L")
    numbers = "".join(c for c in plain if unicodedata.category(c)[0] == "N")
    space = "\t\n\v\f\r \x85\xa0"
    return re.compile(f" ?[{letters}]+| ?[{numbers}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letters}{numbers}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


def _byte_chars() -> dict[str, int]:
    """The published map of printable stand-ins to bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _newer_characters() -> re.Pattern:
    """Code points this Python does not know; libraries may class them differently."""
    unknown = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn"]
    ranges, start = [], None
    for c, after in zip(unknown, [*unknown[1:], -1]):
        start = c if start is None else start
        if after != c + 1:
            ranges.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


def _slot(keys: np.ndarray, factor: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(44)).astype(np.int64)


def _pair_tables(keys: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Hash tables of 2**20 slots; keys whose slot is taken go to the next table, with another factor."""
    tables, left, factor = [], np.arange(len(keys)), 0x9E3779B97F4A7C15
    while len(left):
        known, place = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, np.int32)
        at = _slot(keys[left], factor)
        _, first = np.unique(at, return_index=True)
        known[at[first]], place[at[first]] = keys[left[first]], left[first]
        tables.append((factor, known, place))
        # A pair written twice keeps its first rank.
        left = np.setdiff1d(left, left[first])
        left = left[known[_slot(keys[left], factor)] != keys[left]]
        factor = (factor * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1
    return tables


def _lookup(tables: list[tuple[int, np.ndarray, np.ndarray]], keys: np.ndarray) -> np.ndarray:
    """The place of each key among the keys of the tables, or -1."""
    out = np.full(len(keys), -1, np.int64)
    for factor, known, place in tables:
        at = _slot(keys, factor)
        hit = known[at] == keys
        out[hit] = place[at[hit]]
    return out


class Bpe:
    """A byte-level BPE vocabulary from a tokenizers JSON file.

    Inside, a symbol is a base byte (0 to 255) or 256 + rank of the merge that makes it.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, chars = spec["model"]["vocab"], _byte_chars()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in spec["model"]["merges"]]
        symbol = {c: b for c, b in chars.items()}
        left, right, spelled = [], [], [bytes([b]) for b in range(256)]
        self.proper = True
        for a, b in merges:
            left.append(symbol[a])
            right.append(symbol[b])
            spelled.append(spelled[symbol[a]] + spelled[symbol[b]])
            self.proper &= a + b not in symbol
            symbol.setdefault(a + b, 255 + len(spelled) - 255 - 1)
        base = np.arange(256, dtype=np.int64)
        self.left = np.concatenate([base, np.array(left, np.int64)])
        self.right = np.concatenate([base, np.array(right, np.int64)])
        n = len(spelled)
        names = {i: c for c, i in symbol.items()}
        self.ids = np.array([vocab.get(names.get(i, ""), 0) for i in range(n)], np.uint32)
        self._n = n
        self._tables = _pair_tables(self.left[256:] * n + self.right[256:])
        self.rank = {(a, b): i + 256 for i, (a, b) in reversed(list(enumerate(zip(left, right))))}
        sound = np.ones(n, bool)
        if n > 256:
            sound[256:] = self.compatible(self.left[256:], self.right[256:], np.arange(256, n))
        for i in range(256, n):
            sound[i] &= sound[self.left[i]] and sound[self.right[i]]
        self.by_bytes = {spelled[i]: i for i in range(n) if sound[i]}
        self.longest = max(map(len, self.by_bytes))
        steps, accepts = {}, [-1]
        for piece, token in self.by_bytes.items():
            node = 0
            for byte in piece:
                key = node * 256 + byte
                node = steps.get(key, 0)
                if not node:
                    steps[key] = node = len(accepts)
                    accepts.append(-1)
            accepts[node] = token
        self._steps = _pair_tables(np.fromiter(steps, np.int64, len(steps)))
        self._nodes = np.fromiter(steps.values(), np.int64, len(steps))
        self._accepts = np.array(accepts, np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        top = int(max([*self.ids.tolist(), *self.special.values()], default=0)) + 1
        pieces = [b""] * top
        for i in range(n):
            pieces[self.ids[i]] = spelled[i]
        for content, i in self.special.items():
            pieces[i] = content.encode()
        self._piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._piece_sizes = np.array([len(p) for p in pieces], np.int64)
        self._piece_starts = np.cumsum(self._piece_sizes) - self._piece_sizes
        self._words, self._latin = regex.compile(PATTERN), _latin_pattern()
        self._newer = _newer_characters()
        self._fresh: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._splitter = None
        self.speculated = self.merged = 0

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The symbol that merging a and b makes, or a number above all symbols."""
        found = _lookup(self._tables, a * self._n + b)
        return np.where(found >= 0, found + 256, self._n)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the seam of a and b (before rank `limit`), for many pairs at once.

        Both sides are taken apart again, latest merge first. At each moment the two symbols at the seam could have
        merged until the earlier of the two was used up; if that merge ranks before, the seam does not hold.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), self._n, np.int64) if limit is None else limit.astype(np.int64)
        while len(at):
            crossed = self._merge_rank(a, b) < limit
            good[at[crossed]] = False
            whole = (a < 256) & (b < 256)
            stay = ~(crossed | whole)
            at, a, b, limit = at[stay], a[stay], b[stay], limit[stay]
            # The later merge comes apart first. On equal rank the left one was merged first, so the right comes apart.
            first = (a > b) & (a >= 256) | (b < 256)
            limit = np.where(first, a, b + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good

    def merge_exactly(self, word: bytes) -> list[int]:
        """Merge by rank with a heap over a linked list."""
        symbols = list(word)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n or rank.get((symbols[i], symbols[j])) != r:
                continue
            symbols[i], symbols[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := rank.get((r, symbols[k]))) is not None:
                    heapq.heappush(heap, (x, i))
            h = before[i]
            if h >= 0 and (x := rank.get((symbols[h], r))) is not None:
                heapq.heappush(heap, (x, h))
        return [s for s in symbols if s >= 0]

    def merge_all_exactly(self, words: list[bytes]) -> list[np.ndarray]:
        """Merge many words by rank at once: each round merges the best pair of every word that has one left."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= _SHORT]
        for i in set(range(len(words))) - set(short):
            out[i] = np.array(self.merge_exactly(words[i]), np.int64)
        symbols = np.frombuffer(b"".join(words[i] for i in short), np.uint8).astype(np.int64)
        sizes = np.fromiter((len(words[i]) for i in short), np.int64, len(short))
        name = np.array(short, np.int64)
        while len(name):
            ends = np.cumsum(sizes)
            starts = ends - sizes
            ranks = np.full(len(symbols), self._n, np.int64)
            ranks[:-1] = self._merge_rank(symbols[:-1], symbols[1:])
            ranks[ends - 1] = self._n
            best = np.minimum.reduceat(ranks, starts)
            done = best == self._n
            for i, a, b in zip(name[done].tolist(), starts[done].tolist(), ends[done].tolist()):
                out[i] = symbols[a:b]
            take = (ranks == np.repeat(best, sizes)) & (ranks < self._n)
            # Of overlapping pairs (a a a) every second one is merged, from the left.
            place = np.flatnonzero(take)
            first = np.ones(len(place), bool)
            first[1:] = place[1:] != place[:-1] + 1
            run = place[first][np.cumsum(first) - 1] if len(place) else place
            place = place[(place - run) % 2 == 0]
            symbols[place] = ranks[place]
            keep = np.repeat(~done, sizes)
            keep[place + 1] = False
            left = np.add.reduceat(keep, starts, dtype=np.int64)
            symbols, sizes, name = symbols[keep], left[~done], name[~done]
        return out

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest matches."""
        known, out, at, n = self.by_bytes, [], 0, len(word)
        while at < n:
            for end in range(min(n, at + self.longest), at, -1):
                token = known.get(word[at:end])
                if token is not None:
                    out.append(token)
                    at = end
                    break
        return out

    def propose_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of many words at once, by walking one trie: (tokens, tokens per word)."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        long = [i for i, w in enumerate(words) if len(w) > _SHORT]
        name = np.setdiff1d(np.arange(len(words)), long)
        at, end = np.concatenate([[0], ends[:-1]])[name].astype(np.int64), ends[name]
        tokens = [np.array(self.propose(words[i]), np.int64) for i in long]
        owners = [np.full(len(t), i, np.int64) for i, t in zip(long, tokens)]
        node, best, after = np.zeros(len(name), np.int64), np.full(len(name), -1, np.int64), at.copy()
        while len(name):
            step = np.where(at < end, _lookup(self._steps, node * 256 + text[np.minimum(at, len(text) - 1)]), -1)
            stuck = step < 0
            tokens.append(best[stuck])
            owners.append(name[stuck])
            node = np.where(stuck, 0, self._nodes[step])
            at = np.where(stuck, after, at + 1)
            token = self._accepts[node]
            best = np.where(token >= 0, token, best)
            after = np.where(token >= 0, at, after)
            going = ~(stuck & (at >= end))
            name, at, end, node, best, after = (x[going] for x in (name, at, end, node, best, after))
        owner = np.concatenate([*owners, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        return (np.concatenate([*tokens, np.zeros(0, np.int64)])[order],
                np.bincount(owner, minlength=len(words)).astype(np.int64))

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        if not self.proper:
            return [self.ids[self.merge_exactly(w)].astype("<u4").tobytes() for w in raw]
        flat, sizes = self.propose_all(raw)
        ends = np.cumsum(sizes)
        failing: list[int] = []
        if len(flat) > 1:
            keys = flat[:-1] * self._n + flat[1:]
            owner = np.repeat(np.arange(len(raw)), sizes)
            inside = owner[:-1] == owner[1:]
            distinct, place = np.unique(keys[inside], return_inverse=True)
            bad = ~self.compatible(distinct // self._n, distinct % self._n)[place]
            failing = np.unique(owner[:-1][inside][bad]).tolist()
        ids = self.ids[flat].astype("<u4").tobytes()
        self.speculated += len(words)
        self.merged += len(failing)
        coded = [ids[4 * (end - size): 4 * end] for size, end in zip(sizes.tolist(), ends.tolist())]
        for i, symbols in zip(failing, self.merge_all_exactly([raw[i] for i in failing])):
            coded[i] = self.ids[symbols].astype("<u4").tobytes()
        return coded

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text. Characters newer than this Python are split by the library itself."""
        if not _BEYOND_LATIN.search(text):
            return self._latin.findall(text)
        if not self._newer.search(text):
            return self._words.findall(text)
        if self._splitter is None:
            from tokenizers.pre_tokenizers import ByteLevel
            self._splitter = ByteLevel(add_prefix_space=False)
        return [text[a:b] for _, (a, b) in self._splitter.pre_tokenize_str(text)]

    def _parts(self, text: str) -> Iterator[list[str] | int]:
        """Word lists, and ids of special tokens written in the text."""
        at = 0
        for found in self._specials.finditer(text) if self._specials else ():
            if found.start() > at:
                yield self.words(text[at:found.start()])
            yield self.special[found.group()]
            at = found.end()
        if at < len(text):
            yield self.words(text[at:] if at else text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        parts = [list(self._parts(t)) for t in texts]
        fresh, old = self._fresh, self._old
        seen: set[str] = set()
        for part in parts:
            for words in part:
                if not isinstance(words, int):
                    seen.update(words)
        local, new = {}, []
        for w in seen:
            ids = fresh.get(w)
            if ids is None:
                ids = old.get(w)
                if ids is None:
                    new.append(w)
                    continue
                fresh[w] = ids
            local[w] = ids
        for w, ids in zip(new, self.encode_words(new)):
            local[w] = ids
            if len(w) <= 64:
                fresh[w] = ids
        if len(fresh) > _REMEMBERED:
            self._old, self._fresh = fresh, {}
        return [b"".join(int(p).to_bytes(4, "little") if isinstance(p, int) else b"".join(map(local.__getitem__, p))
                         for p in part) for part in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of many ids at once."""
        ids = ids.astype(np.int64)
        sizes = self._piece_sizes[ids]
        total = int(sizes.sum())
        ends = np.cumsum(sizes)
        at = np.arange(total) + np.repeat(self._piece_starts[ids] - (ends - sizes), sizes)
        return self._piece_bytes[at].tobytes()


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One vocabulary per Python worker and path."""
    return Bpe(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", packed: bool = False) -> DataFrame:
    """Add a column of token ids: array<int>, or with `packed` little-endian unsigned 32-bit integers as binary.

    Null texts count as empty and get no ids. Special tokens of the vocabulary written in a text become their ids. An
    existing column named like `ids` is replaced. Rows stay where they are: there is no shuffle. Texts of any length are
    encoded whole. `path` must be readable on every executor, like the Python environment itself.
    """
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    out = df.drop(ids)
    schema = T.StructType([*out.schema.fields, T.StructField(ids, kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in text_slices(batch, text, 1 << 19):
                coded = bpe.encode([t or "" for t in part.column(text).to_pylist()])
                if packed:
                    values = pa.array(coded, pa.binary())
                else:
                    ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                    values = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(coded), "<i4"))
                yield replaced(part, arrow, {ids: values.cast(arrow.field(ids).type)})

    return out.mapInArrow(tidy(run), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the decoded text of a column of ids (array<int> or packed binary), special tokens included.

    Null ids decode to the empty text. Bytes that are not UTF-8 become the replacement character.
    """
    out = df.drop(text)
    schema = T.StructType([*out.schema.fields, T.StructField(text, T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = []
                for value in part.column(ids):
                    if not value.is_valid:
                        texts.append("")
                        continue
                    coded = np.frombuffer(value.as_buffer(), "<u4") if pa.types.is_binary(value.type) \
                        or pa.types.is_large_binary(value.type) else value.values.to_numpy(zero_copy_only=False)
                    # A long document is decoded in steps: memory is bounded by the step, not by the text.
                    texts.append(b"".join(bpe.decode(coded[i: i + (1 << 18)]) for i in range(0, len(coded), 1 << 18))
                                 .decode("utf-8", "replace"))
                yield replaced(part, arrow, {text: pa.array(texts, arrow.field(text).type)})

    return out.mapInArrow(tidy(run), schema)
