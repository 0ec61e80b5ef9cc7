"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries.llm import (
    bpe, chat, crosspolytope, digest_index, langid, maxscore, mixing, ngram_join, repair, ring, suffix, topk, whitening,
)
from voxseries.llm.common import Stages

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, tokenizer_path(), packed=True).drop("text")
    out = bpe.decode(coded, tokenizer_path())
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, 400).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.try_divide("n_removed", "n_bytes").alias("removed_share"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.link(docs, words=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    name = f"digests_{uuid.uuid4().hex}"
    index = digest_index.DigestIndex(spark, name, f"{Stages(spark, 'index').root}/digests", docs.schema["doc_id"].dataType)
    return index.ingest(docs).select("doc_id", "keep_id", "group_size", "kept",
                                     F.lower(F.hex("digest")).alias("text_sha256"))


def _held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def language_model(docs: DataFrame) -> list[langid.Model]:
    """Learned from the documents that are not held out."""
    return langid.train(docs.filter(~_held_out()))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = language_model(docs)
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_count")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return ring.assign(docs, 24).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))


#: Production parameters of the mix: which sources make a domain, and the weights of the tree.
DOMAINS = {"web": ["src0"], "reference": [f"src{i}" for i in range(1, 8)]}
WEIGHTS = {"domain": {"web": 0.3, "reference": 0.4, "community": 0.3},
           "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}}


def domain() -> F.Column:
    out = F.lit("community")
    for name, sources in DOMAINS.items():
        out = F.when(F.col("source").isin(sources), name).otherwise(out)
    return out


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return mixing.select(docs, domain(), WEIGHTS, share=0.8, other=0.1, max_epochs=2, seed=17,
                         tokens=mixing.pieces(F.col("text")))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    written = Stages(spark, "shards").write(repair.shards(docs, tokenizer_path()), "repair")
    return repair.read_documents(written).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    written = Stages(spark, "chats").write(chat.format_chats(turns.unionByName(own)), "formatted")
    read = written.select("conv_id", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"),
                          chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                       F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return maxscore.rank(docs, _read(spark, sf_dir, "benchmark"), k=10)


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"), components=32)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe, "op2_suffix_dedup": op2_suffix_dedup, "op3_ngram_join": op3_ngram_join, "op4_top_k": op4_top_k,
    "op5_exact_dedup": op5_exact_dedup, "op6_language_id": op6_language_id, "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing, "op9_token_shards": op9_token_shards, "op10_chat": op10_chat, "op11_ranked_search": op11_ranked_search,
    "op12_nearest": op12_nearest, "op13_whitening": op13_whitening, "pipeline": pipeline,
}

_ESCAPES = "|".join(chat._quoted(c) for c in chat.CONTROL)

ORACLE: dict[str, str] = {
    "op4_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[]))
                     AS BIGINT) AS score
              FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op5_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
               text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op10_chat": rf"""
        WITH u AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
                   UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        t AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
                     length(text) + length(text) - length(replace(text, '\', ''))
                     + len(regexp_extract_all(text, '{_ESCAPES}')) AS escaped FROM u)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(escaped + CASE WHEN before = role THEN {len(chat.NEXT)}
                        ELSE length(role) + {len(chat.START) + len(chat.ROLE) + len(chat.END)} END) AS BIGINT)
                   AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op11_ranked_search": r"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
        corpus AS (SELECT count(*) FILTER (len(words) > 0) AS N, CAST(sum(len(words)) AS BIGINT) AS L FROM d),
        f AS (SELECT row, doc_id, len(words) AS size, term, count(*) AS tf
              FROM (SELECT row, doc_id, words, unnest(words) AS term FROM d) GROUP BY row, doc_id, size, term),
        holders AS (SELECT term, count(*) AS df FROM f GROUP BY term),
        q AS (SELECT DISTINCT item, item_id, term FROM (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
        s AS (SELECT item, item_id, row, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * N + 2) / (2 * df + 1))) AS BIGINT)
                     * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * size * N) // L))))) AS BIGINT) AS score
              FROM q JOIN f USING (term) JOIN holders USING (term), corpus GROUP BY item, item_id, row, doc_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10""",
}
