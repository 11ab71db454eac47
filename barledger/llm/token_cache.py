"""Token counts through a digest cache.

A row's content digest is the SHA-256 of its text (null: empty text; nothing else may be
normalised, or counts would change), a tokenizer's version digest that of its file and of its
library's version.  Counts stored under both are joined; only distinct texts without a stored
count are encoded, and their counts are appended to the cache.  Appending twice (after a lost
executor or a concurrent job) is harmless: equal keys hold equal counts and are read as one.

Copies of a text meet after a map-side pre-aggregation by digest, so a text that a third of all
rows share is shuffled once per task at most.

Defined cases: repeated rows and ids get equal counts; null and empty texts count 0 tokens.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.chunked import public_path, tokenizer
from barledger.llm.common import shared_dir, staged, text_or_empty

LIMIT = 1024
TOKENIZER = "byte_bpe_50k.json"
CACHE = "version binary, content binary, n_tokens bigint"


def version_digest(path: str) -> bytes:
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read())
    body.update(f"{library.__name__} {library.__version__}".encode())
    return body.digest()


def new_cache(spark: SparkSession) -> str:
    """An empty cache folder in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/token-cache/{uuid.uuid4().hex}"
    spark.createDataFrame([], CACHE).write.parquet(path)
    return path


def _encode(name: str):
    def run(batches):
        import pyarrow as pa

        tok = tokenizer(name if "/" in name else public_path(name))
        for batch in batches:
            for lo, hi, data, off in flat.blocks(batch.column("text")):
                body = data.tobytes()
                ids = tok.encode([body[off[i] : off[i + 1]].decode("utf-8", "replace") for i in range(hi - lo)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("content").slice(lo, hi - lo), pa.array([len(x) // 4 for x in ids], pa.int64())], names=["content", "n_tokens"]
                )

    return run


def stored(spark: SparkSession, cache: str, version: bytes) -> DataFrame:
    """content, n_tokens of one tokenizer version, one row per content."""
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == F.lit(version))
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def fill(texts: DataFrame, cache: str, name: str, version: bytes) -> None:
    """Append the counts of contents that ``cache`` lacks; ``texts`` has content, text.

    Copies become one row before the shuffle; what the cache knows leaves by an anti-join.
    """
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    misses = distinct.join(stored(texts.sparkSession, cache, version), "content", "left_anti")
    counted = misses.mapInArrow(_encode(name), "content binary, n_tokens bigint")
    counted.select(F.lit(version).alias("version"), "content", "n_tokens").write.mode("append").parquet(cache)


def counts(docs: DataFrame, cache: str, name: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per input row; fills ``cache``."""
    version = version_digest(name if "/" in name else public_path(name))
    fill(docs.select(_content(), text_or_empty().alias("text")), cache, name, version)
    rows = docs.select("doc_id", _content(), F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"))
    # one row a content, written, so that Spark can split a content that many rows share
    known = staged(stored(docs.sparkSession, cache, version))
    return rows.join(known, "content", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _content():
    return F.unhex(F.sha2(F.encode(text_or_empty(), "utf-8"), 256)).alias("content")


def report(docs: DataFrame, cache: str | None = None) -> DataFrame:
    """Counts of all rows through a cache that an earlier job has filled in part.

    The earlier job counts the rows whose digest starts with a zero digit; the second finds their
    counts stored, encodes the distinct others and appends them.
    """
    cache = cache or new_cache(docs.sparkSession)
    earlier = docs.where(F.expr("substr(sha2(encode(coalesce(text, ''), 'utf-8'), 256), 1, 1) = '0'"))
    version = version_digest(public_path(TOKENIZER))
    fill(earlier.select(_content(), text_or_empty().alias("text")), cache, TOKENIZER, version)
    return counts(docs, cache, TOKENIZER)
