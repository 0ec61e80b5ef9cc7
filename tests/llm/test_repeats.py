"""Repeated rows, and rows that are delivered again."""

import time
import uuid

import pytest

from voxseries.llm import digest_index, ngram_join, suffix
from voxseries.llm.common import Stages

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("key", [7, None])
def test_suffix_removal_of_many_repeated_rows(spark, key):
    text = "".join(chr(97 + (i * i * 7 + i // 5) % 26) for i in range(3000))
    edited = text[:1000] + "#" + text[1001:2000] + "#" + text[2001:]
    df = spark.createDataFrame([(key, text)] * 2000 + [(8, edited), (9, "unlike " * 3)], SCHEMA)
    start = time.time()
    got = {(r.doc_id, r.n_bytes, r.n_removed): r.asDict()["n"] for r in suffix.remove_repeats(df, 400).groupBy(
        "doc_id", "n_bytes", "n_removed").count().withColumnRenamed("count", "n").collect()}
    assert time.time() - start < 60
    assert got == {(key, 3000, 3000): 2000, (8, 3000, 2998): 1, (9, 21, 0): 1}


@pytest.mark.parametrize("key", [7, None])
def test_links_of_many_repeated_rows(spark, key):
    words = [f"w{i}" for i in range(200)]
    near = " ".join(words[:100] + ["edit"] + words[101:])
    df = spark.createDataFrame([(key, " ".join(words))] * 1000 + [(key, near)] * 1000 + [(9, "far away from it all")], SCHEMA)
    start = time.time()
    rows = ngram_join.link(df, words=3, percent=90).select("doc_id", "n_shingles", "component_id").collect()
    assert time.time() - start < 60
    assert sorted({(r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows}) == sorted({(key or 0, 198, key or 0), (9, 3, 9)})
    assert len(rows) == 2001


def test_index_drops_what_is_delivered_again(spark):
    index = digest_index.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", f"{Stages(spark, 'index').root}/digests")

    def taken(rows, **options):
        out = index.ingest(spark.createDataFrame(rows, SCHEMA), **options).collect()
        return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out)

    assert taken([(1, "a"), (2, "b")]) == [(1, 1, 1, True), (2, 2, 1, True)]
    assert taken([(1, "a"), (3, "b"), (4, "c")], ingest="third") == [(1, 1, 1, False), (3, 2, 1, False), (4, 4, 1, True)]
    # The same call once more, as after a crash behind the append.
    assert taken([(1, "a"), (3, "b"), (4, "c")], ingest="third") == [(1, 1, 1, False), (3, 2, 1, False), (4, 4, 1, True)]
    assert taken([(4, "c"), (0, " ")]) == [(0, 0, 1, True), (4, 4, 1, False)]
    again = digest_index.drop_copies(index, spark.createDataFrame([(4, "c"), (5, "d"), (5, "d")], SCHEMA)).collect()
    assert [tuple(r) for r in again] == [(5, "d")]
