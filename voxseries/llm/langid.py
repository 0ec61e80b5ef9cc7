"""Language identification as mixture inference.

A document is a bag of words, and each word comes from one of the learned languages. Expectation maximisation estimates the
languages' proportions from trigram likelihoods; languages leave the set one by one while the penalised likelihood improves.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxseries.llm.common import Stages, replaced, text_slices, tidy

#: Trigrams are hashed to this many buckets: the size of a model does not depend on the data.
BUCKETS = 1 << 16
#: Languages in one block of the model: a worker holds one block (32 MB) at a time, however many languages there are.
LANGUAGES = 64
#: A document's fit ends when no other shares can raise its log-likelihood by more than this.
TOLERANCE = 1e-4

_state: dict[str, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    if "letters" not in _state:
        table = np.zeros(0x110000, bool)
        for c in range(0x110000):
            table[c] = unicodedata.category(chr(c))[0] == "L"
        _state["letters"] = table
    return _state["letters"]


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each letter's trigram, first letter of each word, words per text) of lower-cased texts.

    A word is a run of letters; the trigram of a letter holds its neighbours, or a bound where the word ends.
    """
    joined = "\n".join([*((t or "").lower() for t in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Lower-casing can change a text's length, so texts are told apart by counting again.
    sizes = np.fromiter((len((t or "").lower()) + 1 for t in texts), np.int64, len(texts))
    is_letter = _letter_table()[codes]
    symbol = np.where(is_letter, codes, 0).astype(np.uint64)
    padded = np.concatenate([[0], symbol, [0]]).astype(np.uint64)
    at = np.flatnonzero(is_letter)
    key = (padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1]) * np.uint64(0xC2B2AE3D27D4EB4F) + padded[at + 2]
    key *= np.uint64(0xD6E8FEB86659FD93)
    bucket = (key >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    first = np.flatnonzero(~is_letter[np.maximum(at - 1, 0)] | (at == 0)) if len(at) else at
    owner = np.searchsorted(np.cumsum(sizes), at[first], side="right")
    return bucket, first, np.bincount(owner, minlength=len(texts))


@dataclass
class Model:
    """log_p[bucket, language]: smoothed logarithms of trigram frequencies."""

    languages: list[str]
    log_p: np.ndarray

    def predict(self, texts: list[str | None], tolerance: float = TOLERANCE) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, proportion of it, size of the chosen set) of each text; `und` and 0 without letters."""
        names, score, chosen = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for i, (languages, share, _) in self.choose(texts, None, tolerance).items():
            names[i], score[i], chosen[i] = languages[int(share.argmax())], min(share.max(), 1), len(languages)
        return names, score, chosen

    def choose(self, texts: list[str | None], carried: list[tuple[list[str], bytes]] | None = None, tolerance: float = TOLERANCE,
               ) -> dict[int, tuple[list[str], np.ndarray, np.ndarray]]:
        """For each text with letters: its languages, their shares, and the log-likelihoods [word, language] under them.

        `carried` holds what other blocks of languages left of each text: names, and these likelihoods as bytes.
        """
        bucket, first, words = _trigrams(texts)
        filled = np.flatnonzero(words)
        wide = max((len(carried[i][0]) for i in filled.tolist()), default=0) if carried else 0
        k = wide + len(self.languages)
        if not len(filled) or not k:
            return {}
        counts = words[filled]
        starts = np.cumsum(counts) - counts
        log_l, first_allowed = np.full((len(first), k), -np.inf), np.ones((len(filled), k))
        if wide:
            for row, (i, at, n) in enumerate(zip(filled.tolist(), starts.tolist(), counts.tolist())):
                names, logs = carried[i]
                log_l[at: at + n, : len(names)] = np.frombuffer(logs).reshape(n, len(names))
                first_allowed[row, len(names): wide] = 0
        for j in range(len(self.languages)):
            log_l[:, wide + j] = np.add.reduceat(self.log_p[:, j][bucket], first)
        top = log_l.max(axis=1, keepdims=True)
        like = np.exp(np.maximum(log_l - top, -60))

        def fit(allowed: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            # The start is near the last fit, yet no language that is allowed is at 0: from there it could not come back.
            share = allowed * (share + 1e-3)
            share /= share.sum(axis=1, keepdims=True)
            live, some, size = np.arange(len(filled)), like, counts
            while len(live):
                now = share[live]
                over = 1 / np.einsum("ij,ij->i", some, np.repeat(now, size, axis=0))
                lift = np.add.reduceat(some * over[:, None], np.cumsum(size) - size, axis=0) / size[:, None]
                share[live] = np.maximum(now * lift, 1e-200 * allowed[live])
                # The likelihood is concave: from `now` it can rise by size * log(greatest lift) at most. The second term is
                # what rounding leaves of that.
                most = np.where(allowed[live] > 0, lift, 0).max(axis=1)
                going = size * np.log(np.maximum(most, 1)) > np.maximum(tolerance, size * 1e-13)
                if not going.all():
                    some, live, size = some[np.repeat(going, size)], live[going], size[going]
            fitted = np.einsum("ij,ij->i", like, np.repeat(share, counts, axis=0))
            return share, np.add.reduceat(np.log(fitted) + top[:, 0], starts)

        allowed = first_allowed
        share, fitted = fit(allowed, np.ones_like(allowed))
        cost = 0.5 * np.log(counts + 1.0) + 2.0
        best_share, best = share, fitted - cost * allowed.sum(axis=1)
        while (going := allowed.sum(axis=1) > 1).any():
            weakest = np.where(allowed > 0, share, np.inf).argmin(axis=1)
            allowed[going, weakest[going]] = 0
            share, fitted = fit(allowed, share)
            value = fitted - cost * allowed.sum(axis=1)
            better = going & (value >= best)
            best = np.where(better, value, best)
            best_share = np.where(better[:, None], share, best_share)
        out = {}
        for i, at, n, shares in zip(filled.tolist(), starts.tolist(), counts.tolist(), best_share):
            kept = np.flatnonzero(shares > 0)
            names = [carried[i][0][j] if j < wide else self.languages[j - wide] for j in kept.tolist()]
            out[i] = names, shares[kept], log_l[at: at + n, kept]
        return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> list[Model]:
    """Count trigrams by language over all rows with a language: a model for each LANGUAGES languages, in order of name.

    The driver gets at most BUCKETS numbers a language, one block after the other.
    """
    schema = "lang string, bucket int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_slices(batch, text):
                names = np.array(part.column(lang).to_pylist(), object)
                texts = part.column(text).to_pylist()
                for name in set(names.tolist()):
                    bucket, _, _ = _trigrams([t for t, x in zip(texts, names) if x == name])
                    totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                    totals[name] += np.bincount(bucket, minlength=BUCKETS)
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()),
                 "n": pa.array(total[at], pa.int64())})

    labelled = docs.select(text, lang).filter(F.col(lang).isNotNull())
    counts = labelled.mapInArrow(tidy(count), schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    stages = Stages(docs.sparkSession, "languages")
    counts = stages.write(counts, "counts")
    seen = max(counts.select("bucket").distinct().count(), 1)
    blocks: list[Model] = []
    rest = counts.select("lang").distinct()
    while names := [r["lang"] for r in rest.orderBy("lang").limit(LANGUAGES).collect()]:
        table = counts.filter(F.col("lang").between(names[0], names[-1])).toArrow()
        totals = np.zeros((BUCKETS, len(names)))
        at = pc.index_in(table["lang"], pa.array(names, table["lang"].type)).to_numpy()
        totals[table["bucket"].to_numpy(), at] = table["n"].to_numpy()
        blocks.append(Model(names, np.log((totals + smoothing) / (totals.sum(axis=0) + smoothing * seen))))
        rest = rest.filter(F.col("lang") > names[-1])
    stages.clear()
    return blocks


def identify(docs: DataFrame, model: Model | Sequence[Model], text: str = "text") -> DataFrame:
    """Add lang_pred, lang_score and lang_count (size of the chosen language set). Columns of these names are replaced.

    Null texts and texts without a letter get `und`, 0 and 0; so does every text if nothing was learned. Equal shares go to
    the language first in order of name. Whole texts count. Rows stay where they are.

    A model of several blocks meets the documents block by block: the set chosen so far competes with the languages of the
    next block, so no number of languages is too large. As the choice is greedy, a faint second language can be another one
    than if all languages met at once. Each block but the last writes the documents once, with the
    likelihoods of their words under the languages that stay. A task holds 8 bytes for each word of a text and language of a
    block, a few times.
    """
    blocks = [model] if isinstance(model, Model) else list(model) or [Model([], np.zeros((BUCKETS, 0)))]
    out = docs.drop("lang_pred", "lang_score", "lang_count")
    stages = Stages(docs.sparkSession, "languages")
    kept = "lang_kept"
    while kept in out.columns:
        kept += "_"
    plain = out.schema.fields
    carry = T.StructType([T.StructField("names", T.ArrayType(T.StringType())), T.StructField("logs", T.BinaryType())])
    between = T.StructType([*plain, T.StructField(kept, carry)])
    final = T.StructType([*plain, T.StructField("lang_pred", T.StringType()),
                          T.StructField("lang_score", T.DoubleType()), T.StructField("lang_count", T.LongType())])

    def meet(block: Model, first: bool, last: bool):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        arrow = to_arrow_schema(final if last else between)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch, text):
                    texts = part.column(text).to_pylist()
                    carried = None if first else [(x["names"], x["logs"]) for x in part.column(kept).to_pylist()]
                    chosen = sent.value.choose(texts, carried)
                    found = [chosen.get(i, ([], np.zeros(0), np.zeros((0, 0)))) for i in range(len(texts))]
                    if last:
                        values = {"lang_pred": [x[int(s.argmax())] if x else "und" for x, s, _ in found],
                                  "lang_score": [min(float(s.max(initial=0)), 1.0) for _, s, _ in found],
                                  "lang_count": [len(x) for x, _, _ in found]}
                    else:
                        values = {kept: [{"names": x, "logs": logs.tobytes()} for x, _, logs in found]}
                    yield replaced(part, arrow, {name: pa.array(x, arrow.field(name).type) for name, x in values.items()})

        return run

    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        out = out.mapInArrow(tidy(meet(block, i == 0, last)), final if last else between)
        if not last:
            out = stages.write(out, "kept")
    return out
