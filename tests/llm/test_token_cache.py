import random

import numpy as np
import pytest

from barledger.llm import chunked, token_cache

ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "\n \n b", "a\tb", "it's 's x", "x <|endoftext|> y",
    "a　 b", "a \x1c b", "\0x y", "a  b", "tail \n", " \0a", "naïve Übung 梦 🙂", "word " * 5000,
]


def odd_texts():
    rng = random.Random(1)
    return ODD + ["".join(rng.choice(" \n\tab'.1é \x1c\0") for _ in range(rng.randrange(1, 12))) for _ in range(3000)]


def test_chunks_give_the_ids_of_the_library():
    tok = chunked.Chunked(chunked.public_path("byte_bpe_50k.json"))
    for _ in range(2):
        for t, ids in zip(odd_texts(), tok.encode(odd_texts())):
            assert np.frombuffer(ids, np.uint32).tolist() == tok.lib.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts(spark, name):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "y"), (3, "a", "z"), (3, "a", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, content string")
    cache = token_cache.new_cache(spark)
    got = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit) for r in token_cache.counts(df, cache, name).collect()}
    tok = chunked.Chunked(chunked.public_path(name))
    for i, t, _ in rows:
        n = len(tok._library([t or ""])[0])
        assert got[i, len((t or "").encode())] == (n, n > 1024)


def test_only_misses_are_encoded(spark):
    cache = token_cache.new_cache(spark)
    first = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "c")], "doc_id bigint, text string")
    assert token_cache.counts(first, cache).count() == 3
    stored = lambda: spark.read.parquet(cache).count()
    assert stored() == 2
    second = spark.createDataFrame([(4, "c"), (5, "new one")], "doc_id bigint, text string")
    assert token_cache.counts(second, cache).count() == 2
    assert stored() == 3
    # another tokenizer version has counts of its own
    token_cache.counts(second, cache, "word_bpe_49k.json").collect()
    assert stored() == 5


def test_stored_counts_are_used(spark):
    cache = token_cache.new_cache(spark)
    version = token_cache.version_digest(chunked.public_path("byte_bpe_50k.json"))
    import hashlib

    row = [(bytearray(version), bytearray(hashlib.sha256(b"c").digest()), 77)] * 2
    spark.createDataFrame(row, token_cache.CACHE).write.mode("append").parquet(cache)
    df = spark.createDataFrame([(1, "c")], "doc_id bigint, text string")
    assert [tuple(r) for r in token_cache.counts(df, cache).collect()] == [(1, 1, 77, False)]
    assert token_cache.counts(df.limit(0), cache).collect() == []


def test_report_finds_stored_counts_and_encodes_each_distinct_miss_once(spark):
    import hashlib

    rows = [(i, f"text {i % 40}") for i in range(200)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    cache = token_cache.new_cache(spark)
    got = {r.doc_id: r.n_tokens for r in token_cache.report(df, cache).collect()}
    tok = chunked.Chunked(chunked.public_path("byte_bpe_50k.json"))
    assert got == {d: len(tok._library([t or ""])[0]) for d, t in rows}
    stored = [bytes(r.content) for r in spark.read.parquet(cache).collect()]
    distinct = {hashlib.sha256((t or "").encode()).digest() for _, t in rows}
    assert sorted(stored) == sorted(distinct)  # each content once: the second job appended misses only
    early = {c for c in distinct if c.hex().startswith("0")}
    assert early and early != distinct
