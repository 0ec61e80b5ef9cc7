"""Operators of the subpackage against brute force, on awkward rows: nulls, empty and long texts, ties, repeats, no rows."""

import glob
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxseries.llm import bpe, chat, digest_index, langid, mixing, ngram_join, queries, repair, ring, suffix, topk
from voxseries.llm.common import Stages
from voxseries.sources.tables import shared_dir

SCHEMA = "doc_id long, text string, lang string, source string, slot int, row string, cls string"


def documents(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i, "en"), f"src{(i or 0) % 9}", 5, "x", None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "Straße", "日本", "it's", "x" * 90, "<|endoftext|>", "🙂", "7"]
    body = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    shared = " ".join(rng.choice(words) for _ in range(120))
    texts = list(enumerate(body)) + [(40, None), (41, ""), (42, " \t\n"), (43, body[3]), (44, body[3]), (44, body[3]),
                                     (None, body[3]), (45, "a" * 3000), (46, "one"), (47, "ONE"), (48, "one two"),
                                     (49, body[1] + " " + shared), (50, shared + " " + body[2]), (51, shared + "  end")]
    near = [rng.choice(["k", "l", "m"]) + str(i) for i in range(200)]
    for j in range(12):
        copy = list(near)
        copy[j * 7] = f"edit{j}"
        texts.append((60 + j, " ".join(copy)))
    return texts


def test_bpe_equals_the_library(spark, odd):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    out = bpe.decode(bpe.encode(documents(spark, odd), path), path).collect()
    assert len(out) == len(odd)
    for r in out:
        want = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == (r["text"] or "")
        assert r["slot"] == 5
    assert bpe.encode(documents(spark, []), path).count() == 0


def test_greedy_words_that_fail_are_merged_exactly(odd):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    coder, tok, rng = bpe.Bpe(path), Tokenizer.from_file(path), random.Random(1)
    texts = ["".join(rng.choice("etaoinshr'  \n1éß日\x1c ") for _ in range(rng.randrange(0, 200))) for _ in range(2000)]
    texts.append("".join(rng.choice("etaoinshrdlu") for _ in range(30000)))
    for t, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    assert 0 < coder.merged < coder.speculated


@pytest.mark.parametrize("threshold", [8, 50, 400])
def test_suffix_removal(spark, odd, threshold):
    rows = suffix.remove_repeats(documents(spark, odd), threshold).collect()
    texts = [(t or "").encode() for _, t in odd]
    seen = Counter(t[p: p + threshold] for t in texts for p in range(len(t) - threshold + 1))
    want = Counter()
    for (i, _), t in zip(odd, texts):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - threshold + 1):
            if seen[t[p: p + threshold]] > 1:
                gone[p: p + threshold] = True
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        want[i, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in rows) == want
    assert suffix.remove_repeats(documents(spark, []), threshold).count() == 0


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_ngram_join(spark, odd, words, percent):
    sets = []
    for i, t in odd:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(found[k:k + words]) for k in range(len(found) - words + 1)} or ({tuple(found)} if found else set()))
    parent = list(range(len(odd)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(odd)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(odd):
        if i is not None:
            least[root(k)].append(i)
    want = Counter((i, len(sets[k]), min(least[root(k)], default=None)) for k, (i, _) in enumerate(odd))
    got = ngram_join.link(documents(spark, odd), words, percent).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    if percent == 90:
        assert ngram_join.link(documents(spark, []), words, percent).count() == 0


def test_ngram_join_beside_long_words(spark):
    """A word's hash does not depend on what shares its slice: copies of a long word's neighbours lie in other partitions."""
    rng = random.Random(5)
    body = [[f"w{rng.randrange(500)}" for _ in range(60)] for _ in range(6)]
    long_word = "".join(rng.choice("ABCabc0189+/") for _ in range(5000))
    first = [(k, " ".join(t)) for k, t in enumerate(body)] + [(6, long_word), (7, " ".join(body[0][:20]) + " " + long_word)]
    near = [(10 + k, " ".join([*t[:-1], "edited"])) for k, t in enumerate(body)]
    exact = [(20 + k, t) for k, t in first]
    docs = documents(spark, first).coalesce(1).union(documents(spark, near).coalesce(1)).union(documents(spark, exact).coalesce(1))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link(docs, 3, 90).collect()}
    assert got == {i: i % 10 for i, _ in first + near + exact}
    alone, _ = ngram_join.words_of(np.frombuffer(b"plain", np.uint8), np.array([0, 5]))
    beside, _ = ngram_join.words_of(np.frombuffer(b"plain" + b"y" * 4097, np.uint8), np.array([0, 5, 4102]))
    assert beside[0] == alone[0]


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)], i) for i in range(300)]
    rows += [(i, rows[7][1], 0) for i in range(300, 340)] + [
        (400, None, 1), (420, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (440, [float("nan")] * 6, 1), (460, [1.0], 1), (None, rows[1][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=5).collect()
    sound = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _ in rows
             if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    for q in [i for i in sound if i % 20 == 0]:
        want = sorted(((-int(sound[q] @ v), i) for i, v in sound.items() if i != q and len(v) == len(sound[q])))[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_leaves_out_blocks_before_vectors_move(spark):
    """Clusters far apart: a query's best block gives a k-th score that no block of another cluster reaches."""
    rng = np.random.default_rng(5)
    centre = np.eye(8)[np.arange(40_000) % 8] * 3
    vectors = (centre + 0.05 * rng.normal(size=centre.shape)).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(40_000), "embedding": list(vectors)}),
                               "vec_id long, embedding array<float>")
    before = set(glob.glob(f"{shared_dir(spark)}/topk-*"))
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=20).toPandas()
    (root,) = set(glob.glob(f"{shared_dir(spark)}/topk-*")) - before
    count = lambda name: spark.read.parquet(glob.glob(f"{root}/*-{name}")[0]).count()
    every = count("blocks") * count("seeded_queries")
    assert count("near") + count("open") < every and count("blocks") == 5
    whole = np.floor(64 * vectors.astype(float)).astype(int)
    for q in (0, 20, 1220, 39_980):
        score = whole @ whole[q]
        score[q] = -10**9
        want = np.lexsort((np.arange(len(score)), -score))[:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == want.tolist() and mine.score.tolist() == score[want].tolist()
    assert len(got) == 2000 * 20


def test_top_k_of_large_and_alike_numbers(spark):
    """Scores beyond 2^53 stay whole; alike vectors, one id on several rows and empty vectors have a defined result."""
    big = 2.0**30
    rows = [(0, [big, 1.0]), (1, [big, 1.0]), (2, [big, 1.5]), (3, [big, 0.5]), (20, [1.0, 1.0]), (20, [2.0, 1.0]),
            (40, []), (41, []), (60, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=3, scale=1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(1, 2**60 + 1), (2, 2**60 + 1), (3, 2**60)], 20: [(0, 2**30 + 1), (1, 2**30 + 1), (2, 2**30 + 1)],
                   40: [(41, 0)]}


def test_digest_index_over_two_batches(spark, odd, tmp_path):
    index = digest_index.DigestIndex(spark, f"digests_{tmp_path.name.replace('-', '_')}", str(tmp_path / "index"), buckets=4)
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first, second = odd[:35], odd[35:]
    known = {}
    for batch in (first, second, []):
        groups = defaultdict(list)
        for i, t in batch:
            groups[plain(t)].append(i)
        fresh = {t: min((i is None, i or 0) for i in ids) for t, ids in groups.items() if t not in known}
        got = index.ingest(documents(spark, batch)).collect()
        assert len(got) == len(batch)
        assert sum(r["kept"] for r in got) == len(fresh)
        known |= {t: (None if v[0] else v[1]) for t, v in fresh.items()}
        want = Counter((i, known[plain(t)], len(groups[plain(t)])) for i, t in batch)
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
    assert spark.table(index.table).count() == len(known)
    other = digest_index.DigestIndex(spark, f"again_{tmp_path.name.replace('-', '_')}", str(tmp_path / "other"), buckets=4)
    stay = digest_index.drop_copies(other, documents(spark, odd)).collect()
    assert len(stay) == len({plain(t) for _, t in odd})


def test_language_mixture(spark):
    rng = random.Random(3)
    lexicon = {"aa": ["kako", "tiko", "mako"], "bb": ["schul", "stein", "rund"]}
    texts = [(i, " ".join(rng.choice(lexicon[k]) for _ in range(30))) for i, k in enumerate(["aa", "bb"] * 20)]
    docs = documents(spark, texts, {i: "ab"[i % 2] * 2 for i, _ in texts})
    model = langid.train(docs)
    mixed = " ".join(rng.choice(lexicon["aa"]) for _ in range(60)) + " " + " ".join(rng.choice(lexicon["bb"]) for _ in range(20))
    asked = [(1, "kako tiko"), (2, None), (3, ""), (4, "12 !?"), (5, mixed), (6, "stein"), (None, "rund rund"),
             (8, mixed * 5000)]
    got = {r["doc_id"]: (r["lang_pred"], r["lang_score"], r["lang_count"])
           for r in langid.identify(documents(spark, asked), model).collect()}
    assert got[1] == ("aa", 1.0, 1) and got[6][0] == got[None][0] == "bb"
    assert got[2] == got[3] == got[4] == ("und", 0.0, 0)
    assert got[5][0] == "aa" and got[5][2] == 2 and abs(got[5][1] - 0.75) < 0.05
    assert got[8][0] == "aa" and got[8][2] == 2 and abs(got[8][1] - 0.75) < 0.05
    empty = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}


def test_language_shares_are_fitted_to_the_end():
    """Close languages: the share is where the likelihood of the two is greatest, found here by bisection."""
    rng = np.random.default_rng(7)
    model = langid.Model(["aa", "bb"], -9 + 0.3 * rng.normal(size=(langid.BUCKETS, 2)))
    pool = ["".join(rng.choice(list("abcdefghijklmnop"), 4)) for _ in range(5000)]
    bucket, first, _ = langid._trigrams(pool)
    log_l = np.add.reduceat(model.log_p[bucket], first)
    draw = lambda j, n: rng.choice(len(pool), n, p=np.exp(log_l[:, j]) / np.exp(log_l[:, j]).sum())
    mixes = [np.concatenate([draw(0, a), draw(1, 2000 - a)]) for a in (1700, 1500, 1300)]
    names, score, chosen = model.predict([" ".join(pool[i] for i in m) for m in mixes])
    assert names == ["aa"] * 3 and chosen.tolist() == [2, 2, 2]
    for m, s in zip(mixes, score):
        ratio, lo, hi = np.exp(log_l[m, 1] - log_l[m, 0]), 0.0, 1.0
        for _ in range(60):
            at = (lo + hi) / 2
            lo, hi = (at, hi) if ((1 - ratio) / (at + (1 - at) * ratio)).sum() > 0 else (lo, at)
        assert s == pytest.approx(lo, abs=2e-3)


def test_languages_beyond_one_block(spark):
    """150 languages in three blocks: one language and mixtures across blocks are found, and no row or column is lost."""
    rng = random.Random(9)
    pick = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    lexicon = {f"l{j:03d}": [pick() for _ in range(12)] for j in range(150)}
    say = lambda name, n: " ".join(rng.choice(lexicon[name]) for _ in range(n))
    texts = [(i, say(f"l{i:03d}", 60)) for i in range(150)]
    blocks = langid.train(documents(spark, texts, {i: f"l{i:03d}" for i, _ in texts}))
    assert [len(b.languages) for b in blocks] == [64, 64, 22] and sum((b.languages for b in blocks), []) == sorted(lexicon)
    asked = [(i, say(f"l{i:03d}", 12)) for i in range(150)]
    asked += [(200, say("l003", 60) + " " + say("l140", 20)), (201, say("l100", 60) + " " + say("l101", 30)), (202, None), (203, "1 2")]
    docs = documents(spark, asked).withColumn("lang_kept", F.lit("own")).withColumn("lang_pred", F.lit("old"))
    rows = langid.identify(docs, blocks).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["lang_count"]) for r in rows}
    assert all(got[i][0] == f"l{i:03d}" for i in range(150)) and {r["lang_kept"] for r in rows} == {"own"}
    assert got[200] == ("l003", 2) and got[201] == ("l100", 2) and got[202] == got[203] == ("und", 0)
    whole = langid.Model(sorted(lexicon), np.concatenate([b.log_p for b in blocks], axis=1))
    names, score, chosen = whole.predict([t for _, t in asked[150:]])
    shares = {r["doc_id"]: r["lang_score"] for r in rows}
    for (i, _), name, share, size in zip(asked[150:], names, score, chosen):
        assert got[i] == (name, size) and shares[i] == pytest.approx(share, abs=1e-3)


def test_ring(spark, odd):
    got = ring.assign(documents(spark, odd), 7, nodes=8, cells=64).collect()
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(got) == len(odd)
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in odd)
    assert ring.assign(documents(spark, []), 7).count() == 0
    assert len(set(ring.ring(24))) == 24


def test_budgets_fill_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 30), (None, "x", "s5", 500)],
        "domain string, lang string, source string, available long")
    weights = {"domain": {"a": 2.0, "b": 1.0}}
    got = {r["source"]: r["target"] for r in mixing.budgets(leaves, F.lit(400), weights, other=1.0).collect()}
    # Root 400 by 2:1:1 -> b can give 30; the others share 370 by 2:1. In a, x and y have equal parts; s1 is short, s2 helps.
    assert got["s4"] == 30 and got["s1"] == 10
    assert got["s1"] + got["s2"] == pytest.approx(got["s3"], abs=1)
    assert got["s5"] == pytest.approx(370 / 3, abs=1) and sum(got.values()) == pytest.approx(400, abs=5)


def test_mixing_takes_prefixes_of_epochs(spark, odd):
    docs = documents(spark, odd)
    got = mixing.select(docs, F.lit("d"), {}, share=1.5, max_epochs=2, seed=1).collect()
    tokens = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in odd if i is not None}
    assert all(0 < r["tokens_taken"] <= r["tokens"] for r in got)
    by_leaf = defaultdict(int)
    for r in got:
        by_leaf[r["source"], r["epoch"]] += r["tokens_taken"]
        assert r["doc_id"] is None or r["tokens"] == tokens[r["doc_id"]]
    total = sum(tokens.values()) + tokens[44] + tokens[3]
    assert sum(by_leaf.values()) == pytest.approx(1.5 * total, abs=20)
    again = mixing.select(docs, F.lit("d"), {}, share=1.5, max_epochs=2, seed=1).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.select(documents(spark, []), F.lit("d"), {}, share=1.0).count() == 0


def test_repair_round_trip(spark, odd):
    path = queries.tokenizer_path()
    docs = documents(spark, odd + [(900 + i, "again and again " * 40) for i in range(20)])
    written = Stages(spark, "test").write(repair.shards(docs, path, end_id=0), "shards")
    got = sorted(repair.read_documents(written).collect(), key=lambda r: r["start"])
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    want = Counter((r["doc_id"], np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
                   for r in docs.collect())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert ids == sorted(ids)
    some = written.collect()
    assert any(len(r["rules"]) for r in some)
    for r in some:
        shard = repair.Shard(r.asDict())
        whole = shard.document(0)
        assert [shard.token(0, k) for k in range(len(whole))] == whole.tolist()
    assert repair.shards(documents(spark, []), path).count() == 0


def test_known_words_of_latin_texts_are_looked_up_as_arrays(monkeypatch):
    """Like the library on awkward Latin texts; no text is split word by word, and words that came before do not reach the library."""
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    tok, coder, rng = Tokenizer.from_file(path), type(repair.load(path))(path), random.Random(8)
    some = ["a", "é", "ß", "s", "t", "re", "ve", "ll", "m", "'", "'", " ", " ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", "\x1c", "\0", "\x01",
            ".", "!!", "—", "’", "…", "\u2010", "\u2027", "7", "²", "½", "µ", "ª", "×", "Ġ", "the", " of", "x" * 23, "y" * 24, "zé" * 9]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    texts += ["", "'", "'s", " 's", "\n's", "''s", "it's'll've", "'re", "'r", "'l", " ", "  ", "\n", "a ", "a  ", "a \n", " \n a", "x" * 5000, ""]
    want = [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    def refuse(*_):
        raise AssertionError("split or encoded once more")

    monkeypatch.setattr(coder, "words", refuse)
    assert coder.encode(texts) == want
    plain = ["the of", "", "it's the\n"] * 5
    once = coder.encode(plain)
    monkeypatch.setattr(coder, "_by_library", refuse)
    assert coder.encode(plain) == once
    monkeypatch.undo()
    mixed = ["the 日本", "a<|endoftext|>b", "the", "Ω'sé", "", "<|endoftext|>", "🙂 of"] + [a + b for a, b in zip(texts[:500], texts[::-1])]
    assert coder.encode(mixed) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in mixed]
    assert coder.encode([]) == [] and coder.encode(["", ""]) == [b"", b""]


def test_long_texts_are_cut_between_words(monkeypatch):
    """Memory is bounded by the piece; ids are those of the whole text."""
    from voxseries.llm import word_table
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    monkeypatch.setattr(word_table, "_LONG", 40)
    tok, coder, rng = Tokenizer.from_file(path), word_table.LibraryBpe(path), random.Random(10)
    some = ["it", "'s", "é", " ", "  ", "\n", "\t", " \x1c", "\xa0", "7", "!", " of", " the", " '"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(1, 300))) for _ in range(500)] + ["x" * 300, " " * 300, ""]
    assert max(len(list(word_table.pieces(t))) for t in texts) > 3
    assert all("".join(word_table.pieces(t)) == t for t in texts)
    assert coder.encode(texts) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_words_survive_full_slots_and_a_new_table(monkeypatch):
    """Words that share a slot push each other out, and a full table starts anew: ids stay right."""
    from voxseries.llm import word_table
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    monkeypatch.setattr(word_table, "_FULL", 200)
    tok, coder, rng = Tokenizer.from_file(path), word_table.LibraryBpe(path), random.Random(9)
    monkeypatch.setattr(word_table, "pair_hash", lambda a, b: (a + b) << np.uint64(62) | np.uint64(1 << 45))
    for _ in range(20):
        texts = [" ".join(rng.choice(["alpha", "beta", "é", "z" * 40, str(rng.randrange(99))]) for _ in range(30)) for _ in range(6)]
        assert coder.encode(texts) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_reading_shards_does_not_shuffle_them(spark, odd):
    """Also where Spark would not broadcast by itself, as with tables of unknown size."""
    written = Stages(spark, "test").write(repair.shards(documents(spark, odd), queries.tokenizer_path()), "shards")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = repair.read_documents(written)
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert read.count() == len(odd)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 50, 300)
    for ids, docs in [(np.tile(passage, 400), np.zeros(120000, int)), (np.tile(passage, 400), np.arange(120000) // 1000),
                      (np.full(50000, 7), np.zeros(50000, int)), (rng.integers(0, 40, 60000), np.arange(60000) // 90)]:
        symbols, owner, rules = repair.compress(ids.astype("<u4"), docs, 50)
        left = Counter(zip(symbols[:-1][owner[:-1] == owner[1:]].tolist(), symbols[1:][owner[:-1] == owner[1:]].tolist()))
        assert max(left.values(), default=0) < repair.LEAST
        assert repair.expand(symbols, rules, 50).tolist() == ids.tolist()
        sizes = repair.expansions(rules, 50)
        assert np.bincount(owner, np.where(symbols < 50, 1, np.append(sizes, 0)[symbols - 50])).tolist() == np.bincount(docs).tolist()


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<|im_end|>\\<|im_next|>", "<", "<|im_", "<<SYS>>x<s>", "", None, "é🙂\n"]
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "a<|im_role|>\\b", None]), rng.choice(nasty), 1)
            for c in (1, 2, None) for t in range(12)] + [(3, 0, "assistant", "x" * 70000, 1), (4, None, "user", "hi", 1)]
    rows += [(5, t, "user" if t % 2 else "assistant", str(t), 1) for t in range(700)] + [(1, 3, "user", "hi", 1)] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    out = chat.format_chats(df).select("*", chat.read_turns(F.col("formatted")).alias("read"),
                                       chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked")).collect()
    assert len(out) == 6
    for r in out:
        mine = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text, _ in rows if c == r["conv_id"]))
        assert [(x["role"], x["text"]) for x in r["read"]] == [m[2:] for m in mine]
        assert r["masked"] == "".join(m[3] for m in mine if m[2] == "assistant")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_near_copies_with_repeated_and_null_ids(spark):
    base = [f"w{i}" for i in range(80)]
    near, other = " ".join([*base[:-1], "edit"]), " ".join(f"v{i}" for i in range(80))
    base = " ".join(base)
    docs = documents(spark, [(1, base), (5, near), (5, other), (7, base.upper()), (7, other + " end"), (8, "x y"), (8, "x y"),
                             (None, near), (None, "z z z"), (None, "z z z q"), (None, "z z z"), (9, ""), (9, "")])
    got = Counter((r["doc_id"], r["text"]) for r in ngram_join.drop_near_copies(docs).collect())
    assert got == Counter({(1, base): 1, (5, other): 1, (8, "x y"): 1, (None, "z z z"): 1, (None, "z z z q"): 1, (9, ""): 2})


def test_mixing_does_not_depend_on_the_layout(spark, odd):
    docs = documents(spark, odd + [(None, f"other {i}") for i in range(20)] + [(44, f"more {i}") for i in range(20)])
    takes = [Counter(map(tuple, mixing.select(d, F.lit("d"), {}, share=share, max_epochs=2, seed=5, marked=True).collect()))
             for share in (0.4, 1.3) for d in (docs.coalesce(1), docs.repartition(7), docs.orderBy(F.desc("text")))]
    assert takes[0] == takes[1] == takes[2] and takes[3] == takes[4] == takes[5]


def test_mixing_counts_follow_length_without_blanks(spark, tmp_path):
    texts = {1: "one two  three\n", 2: "日本語の文" * 100, 3: "aB3/" * 600, 4: "Straße 日本x", 5: "", 6: None, 7: "ไทย ok"}
    want = {1: 3, 2: 500, 3: 200, 4: 4, 7: 4}
    spark.createDataFrame([(i, t, "en", f"src{i}", 1) for i, t in texts.items()],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = queries.op8_mixing(spark, str(tmp_path)).collect()
    assert got and all(r["tokens"] == want[r["doc_id"]] for r in got) and {2, 3} <= {r["doc_id"] for r in got}


def test_keep_taken_with_repeated_and_null_ids(spark):
    texts = [(None, f"n{i} " * 10) for i in range(40)] + [(3, f"m{i} " * 10) for i in range(40)] + [(4, "same " * 10)] * 40
    docs = documents(spark, texts).withColumn("source", F.lit("src0"))
    taken = mixing.select(docs, F.lit("d"), {}, share=0.5, seed=2, marked=True)
    want = Counter((r["doc_id"], bytes(r["mark"])) for r in taken.collect())
    kept = mixing.keep_taken(docs, taken, F.lit("d"))
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).digest()) for r in kept.collect()) == want
    assert sum(want.values()) == 60


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeghiklmnoprstu") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    body = {i: " ".join(rng.choice(vocabulary) for _ in range(80)) for i in range(40)}
    texts = list(body.items()) + [(50, body[1]), (51, body[2] + " more"), (52, "123"), (53, None)]
    spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in texts],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, str(tmp_path))
        if name != "BPE encoding":
            assert after.columns == docs.columns
        docs = Stages(spark, "test").write(after, "stage")
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert kept[0] == set(range(40)) | {50, 51} and kept[1] == kept[0] - {50} and kept[2] == kept[1] - {51}
    assert kept[3] < kept[2] and kept[4] == kept[3]

