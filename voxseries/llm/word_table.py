"""Byte-level BPE by the tokenizers library, for texts whose words mostly came before.

Latin texts are split into words many at once, as arrays. Short words are looked up by all their bytes in a table of arrays; only
words that are not in it reach the library, many in one call. Other texts take the way of `bpe.Bpe`.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from voxseries.llm.bpe import _BEYOND_LATIN, Bpe, _byte_chars
from voxseries.llm.common import pair_hash

#: Classes of characters. END stands between texts.
_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)
_BETWEEN = "\u0300"

#: Bytes of a word whose key holds all of them, and slots of the table. Longer words are not remembered.
_KEYED, _SLOTS = 23, 1 << 20
#: Remembered ids from which on a table starts anew. It bounds memory only.
_FULL = 1 << 23

#: A word starts at a space between two other characters, whatever is around: there texts of more than _LONG characters are cut.
_LONG, _CUT = 1 << 20, re.compile(r"(?<=\S) (?=\S)")

_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _classes() -> np.ndarray:
    """Of the characters in texts that _BEYOND_LATIN does not find, as in bpe._latin_pattern."""
    out = np.full(0x2028, _OTHER, np.uint8)
    for c in [*range(0x300), *range(0x2010, 0x2028)]:
        out[c] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER)
    out[[ord(c) for c in "\t\n\v\f\r \x85\xa0"]] = _SPACE
    out[ord(_BETWEEN)] = _END
    return out


_CLASS = _classes()


def word_starts(codes: np.ndarray) -> np.ndarray:
    """Whether a word starts at each character of Latin texts with END after each of them; END itself is one.

    A run of one class is a word, except: of blanks before something else the last stands apart, and a space there joins what
    follows; an apostrophe that starts a word takes the letters of a contraction.
    """
    kind = _CLASS[codes]
    start = np.append(True, kind[1:] != kind[:-1]) | (kind == _END)
    blank = kind == _SPACE
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & (kind[1:] != _END))
    start[last] = True
    start[last[codes[last] == 0x20] + 1] = False
    at = np.flatnonzero((codes == 0x27) & start)
    # Past the end of all texts comes END at least, which is no letter: two more characters are looked at.
    near = np.append(codes, np.zeros(2, codes.dtype))
    one, two = near[at + 1], near[at + 2]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = np.isin(one * 0x10000 + two, [ord(a) * 0x10000 + ord(b) for a, b in ("re", "ve", "ll")])
    start[at[single | double] + 1] = False
    start[at[single] + 2] = True
    start[at[double] + 3] = True
    return start


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of about _LONG characters that are split into the same words as the whole."""
    at = 0
    while len(text) - at > _LONG and (found := _CUT.search(text, at + _LONG)):
        yield text[at: found.start()]
        at = found.start()
    yield text[at:]


class LibraryBpe(Bpe):
    """Words are encoded by the tokenizers library; what it gave is remembered."""

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer, pre_tokenizers

        # Words reach the library as the vocabulary spells their bytes: U+0001 is free to stand between them, and no special token
        # is written in them.
        with open(path, encoding="utf-8") as file:
            spec = json.load(file) | {k: None for k in ("normalizer", "post_processor", "padding", "truncation")}
        self.library = Tokenizer.from_str(json.dumps(spec | {"added_tokens": []}))
        self.library.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\x01")
        spelled = {b: ord(c) for c, b in _byte_chars().items()}
        self._spelled = np.array([spelled[b] for b in range(256)], "<u4")
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros((_SLOTS, 3), np.uint64)
        self._places, self._counts = np.zeros(_SLOTS, np.int64), np.zeros(_SLOTS, np.int64)
        self._ids, self._used = np.zeros(1 << 16, np.uint32), 0

    def encode_words(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        ids, counts = self._by_library(np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw)))
        ends = 4 * np.cumsum(counts)
        coded = ids.tobytes()
        return [coded[a:b] for a, b in zip((ends - 4 * counts).tolist(), ends.tolist())]

    def _by_library(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words (one at least) of `sizes` bytes that stand in `data` one after the other."""
        ends = np.cumsum(sizes)
        text = np.insert(self._spelled[data], ends[:-1], 1)
        parts, at = [], 0
        # The library is given about 4,096 bytes at once, in whole words.
        while at < len(ends):
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4096)), at + 1)
            parts.append(self._called(text[(ends[at - 1] if at else 0) + at: ends[to - 1] + to - 1]))
            at = to
        ids = np.concatenate(parts)
        reached = np.append(np.cumsum(self._piece_sizes[ids.astype(np.int64)]), -1)
        last = np.searchsorted(reached[:-1], ends)
        if (reached[last] == ends).all():
            return ids, np.diff(np.append(-1, last))
        # A vocabulary that does not spell every byte: words go one by one.
        alone = [self._called(self._spelled[data[b - n: b]]) for b, n in zip(ends.tolist(), sizes.tolist())]
        return np.concatenate(alone), np.fromiter(map(len, alone), np.int64, len(alone))

    def _called(self, characters: np.ndarray) -> np.ndarray:
        text = characters.tobytes().decode("utf-32-le")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        plain = [not (_BEYOND_LATIN.search(t) or self._specials and self._specials.search(t)) for t in texts]
        latin = iter(self._encode_latin([t for t, p in zip(texts, plain) if p and len(t) <= _LONG]))
        rest = iter(super().encode([t for t, p in zip(texts, plain) if not p]))
        return [next(rest) if not p else next(latin) if len(t) <= _LONG
                else b"".join(self._encode_latin([some])[0] for some in pieces(t)) for t, p in zip(texts, plain)]

    def _encode_latin(self, texts: list[str]) -> list[bytes]:
        """Of texts of Latin characters without special tokens."""
        if not texts:
            return []
        if self._used > _FULL:
            self._forget()
        whole = _BETWEEN.join([*texts, ""])
        codes, raw = np.frombuffer(whole.encode("utf-32-le"), "<u4"), whole.encode()
        first = np.flatnonzero(word_starts(codes))
        closing = codes[first] == ord(_BETWEEN)
        offsets = first
        if len(raw) != len(codes):
            offsets = (np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800)) - 1 - (codes >= 0x80) - (codes >= 0x800))[first]
        sizes = np.diff(np.append(offsets, len(raw)))
        offsets, sizes = offsets[~closing], sizes[~closing]
        places, counts = self._look_up(raw, offsets, sizes)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        coded = self._ids[np.arange(total) + np.repeat(places - (ends - counts), counts)].astype("<u4").tobytes()
        # The number of words before the end of each text.
        words = np.flatnonzero(closing) - np.arange(len(texts))
        cuts = (4 * np.append(0, ends)[words]).tolist()
        return [coded[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]

    def _look_up(self, raw: bytes, offsets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the remembered ids, number of ids) of each word; new words are encoded and remembered."""
        data = np.frombuffer(raw + bytes(24), np.uint8)
        eight = np.ndarray(len(raw) + 16, "<u8", data, strides=(1,))
        keys = [eight[np.minimum(offsets + 8 * k, len(raw))] & _MASKS[np.clip(sizes - 8 * k, 0, 8)] for k in range(3)]
        keys[2] |= sizes.astype(np.uint64) << np.uint64(56)
        slots = (pair_hash(pair_hash(keys[0], keys[1]), keys[2]) >> np.uint64(44)).astype(np.int64)
        places, counts = self._places[slots], self._counts[slots]
        known = (self._keys[slots, 0] == keys[0]) & (self._keys[slots, 1] == keys[1]) & (self._keys[slots, 2] == keys[2])
        known &= sizes <= _KEYED
        new = np.flatnonzero(~known)
        if not len(new):
            return places, counts
        # Of a short word that is here more than once only one is encoded.
        short, long = new[sizes[new] <= _KEYED], new[sizes[new] > _KEYED]
        order = short[np.lexsort([k[short] for k in keys])]
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
        one = np.append(order[fresh], long)
        begins = np.cumsum(sizes[one]) - sizes[one]
        ids, made = self._by_library(data[np.arange(int(sizes[one].sum())) + np.repeat(offsets[one] - begins, sizes[one])], sizes[one])
        while self._used + len(ids) > len(self._ids):
            self._ids = np.append(self._ids, np.zeros_like(self._ids))
        self._ids[self._used: self._used + len(ids)] = ids
        begins = self._used + np.cumsum(made) - made
        self._used += len(ids)
        mine = np.append(np.cumsum(fresh) - 1, np.arange(int(fresh.sum()), len(one)))
        at = np.append(order, long)
        places[at], counts[at] = begins[mine], made[mine]
        # Where words share a slot one of them stays.
        _, kept = np.unique(slots[order[fresh]], return_index=True)
        some = order[fresh][kept]
        self._keys[slots[some]] = np.stack([k[some] for k in keys], axis=1)
        self._places[slots[some]], self._counts[slots[some]] = places[some], counts[some]
        return places, counts


@lru_cache(maxsize=2)
def load(path: str) -> LibraryBpe:
    return LibraryBpe(path)
