"""Importance resampling towards a target text distribution by hashed n-gram counts.

Words are runs of digits, letters and non-ASCII characters (A-Z lower-cased).  A text's
features are all runs of 1 to ``ORDER`` consecutive words, joined by one space, repeats
counted; the CRC-32 of a feature's bytes modulo ``BUCKETS`` names its bucket.

* **Interning.** The words of a block are copied into one byte array with a space between
  words, so every feature is one byte span.  An open-addressed NumPy table (linear probing,
  at most half full) interns the spans: the key is xxhash64 of the bytes, an equal key is
  verified byte by byte, and a slot stores the bucket and the count.  Each occurrence keeps
  its slot id, so counts are a bincount of ids, a CRC is taken once for each distinct feature
  (of a longer run by joining the CRCs of its words), and gains are gathered through the ids.
* **Counts.** Each task sums its blocks into one array of ``BUCKETS`` longs and returns its
  non-zero buckets; Spark adds them up.  Only the bucket totals (a fixed number) reach the
  driver, where the gains are computed, and go back with the second pass.
* **Draw.** score = floored mean gain + Gumbel noise from the id, so the highest scores are a
  draw without replacement in proportion to exp(weight / 1000).  Places come from a two-level
  prefix scan over ranges of the score, never from one sorted task.

Defined cases: null or wordless text has no feature, weight 0 and is never drawn; a null
doc_id is drawn with the noise of the empty id and sorts first on ties; rows repeated whole
are scored alike and drawn as often as they stand; an empty table stays empty and an empty
target gives every bucket the gain of no evidence.  Only the two named columns are read.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.common import staged
from barledger.operators.ordering import number_rows

BUCKETS = 10_000
ORDER = 2
#: A document of fewer words is never drawn; this share (in hundredths) of the others is.
LEAST_WORDS, SHARE = 20, 25
SEED = 7
#: Longer spans are hashed one by one by the library.
_LONG = 256

#: The five 64-bit primes of xxhash64 (fixed values of the published algorithm).
_P1 = np.uint64(11400714785074694791)
_P2 = np.uint64(14029467366897019727)
_P3 = np.uint64(1609587929392839161)
_P4 = np.uint64(9650029242287828579)
_P5 = np.uint64(2870177450012600261)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _lanes(data: np.ndarray, dtype) -> np.ndarray:
    """View that reads ``dtype`` at every byte place of ``data`` (padded by 8 bytes)."""
    size = np.dtype(dtype).itemsize
    return np.ndarray(shape=(len(data) - size + 1,), dtype=dtype, buffer=data, strides=(1,))


def xxhash64(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of byte spans of ``data``, whose last 8 bytes are padding."""
    wide, half = _lanes(data, np.uint64), _lanes(data, np.uint32)
    out = length.astype(np.uint64) + _P5
    at = start.copy()
    with np.errstate(over="ignore"):
        big = np.flatnonzero(length >= 32)
        if len(big):
            acc = [np.full(len(big), v, np.uint64) for v in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
            stripes = length[big] // 32
            live = np.arange(len(big))
            for s in range(int(min(stripes.max(), _LONG // 32))):
                live = live[stripes[live] > s]
                p = start[big[live]] + 32 * s
                for lane in range(4):
                    acc[lane][live] = _rotl(acc[lane][live] + wide[p + 8 * lane] * _P2, 31) * _P1
            h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for v in acc:
                h = (h ^ (_rotl(v * _P2, 31) * _P1)) * _P1 + _P4
            out[big] = h + length[big].astype(np.uint64)
            at[big] += 32 * stripes
        end = start + length
        live = np.flatnonzero(end - at >= 8)
        while len(live):
            k = _rotl(wide[at[live]] * _P2, 31) * _P1
            out[live] = _rotl(out[live] ^ k, 27) * _P1 + _P4
            at[live] += 8
            live = live[end[live] - at[live] >= 8]
        live = np.flatnonzero(end - at >= 4)
        if len(live):
            out[live] = _rotl(out[live] ^ (half[at[live]].astype(np.uint64) * _P1), 23) * _P2 + _P3
            at[live] += 4
        for _ in range(3):
            live = np.flatnonzero(end > at)
            out[live] = _rotl(out[live] ^ (data[at[live]].astype(np.uint64) * _P5), 11) * _P1
            at[live] += 1
        out ^= out >> np.uint64(33)
        out *= _P2
        out ^= out >> np.uint64(29)
        out *= _P3
        out ^= out >> np.uint64(32)
    for i in np.flatnonzero(length > _LONG):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + length[i]].tobytes())
    return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of equal ``length`` at ``a`` and ``b`` hold equal bytes."""
    wide = _lanes(data, np.uint64)
    equal = np.ones(len(a), bool)
    live, at = np.flatnonzero(length > 0), 0
    while len(live):
        differ = wide[a[live] + at] ^ wide[b[live] + at]
        left = length[live] - at
        differ <<= np.where(left < 8, 8 * (8 - left), 0).astype(np.uint64)  # little-endian: later bytes go first
        equal[live] = differ == 0
        at += 8
        live = live[(left > 8) & (differ == 0)]
    return equal


def _crc_step() -> np.ndarray:
    """CRC-32 of each byte value alone, without conditioning."""
    v = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        v = np.where(v & 1, (v >> 1) ^ np.uint32(0xEDB88320), v >> 1)
    return v


_STEP = _crc_step()


@lru_cache(maxsize=_LONG)
def _shift(length: int) -> np.ndarray:
    """Four tables, one a byte of a CRC, that together append ``length`` zero bytes to it."""
    if length:
        v = _shift(length - 1)
        return (v >> np.uint32(8)) ^ _STEP[v & np.uint32(255)]
    return np.arange(256, dtype=np.uint32)[None] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))


def crc_joined(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of left + space + right from both CRCs and the byte length of ``right``."""
    c = ~left
    c = ~((c >> np.uint32(8)) ^ _STEP[(c ^ np.uint32(0x20)) & np.uint32(255)])
    out = right.copy()
    order = np.argsort(length, kind="stable")
    size, first = np.unique(length[order], return_index=True)
    for n, at in zip(size.tolist(), np.split(order, first[1:])):
        t, x = _shift(n), c[at]
        out[at] ^= t[0][x & np.uint32(255)] ^ t[1][(x >> np.uint32(8)) & np.uint32(255)] ^ t[2][(x >> np.uint32(16)) & np.uint32(255)] ^ t[3][x >> np.uint32(24)]
    return out


class Table:
    """Open-addressed table of byte spans.

    A slot knows the span that owns it (and by it the key and the bytes), its count and its bucket;
    ``slot`` is the slot of each occurrence.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        n = len(start)
        size = 1 << max(4, (2 * n - 1).bit_length())
        self.owner = np.full(size, -1, np.int32)
        key = xxhash64(data, start, length)
        self.slot = np.empty(n, np.int32)
        todo, at = np.arange(n, dtype=np.int32), (key & np.uint64(size - 1)).astype(np.int32)
        while len(todo):
            free = np.flatnonzero(self.owner[at] < 0)
            self.owner[at[free]] = todo[free]  # of several, the last one stays
            holder = self.owner[at]
            fit = (key[holder] == key[todo]) & (length[holder] == length[todo])
            maybe = np.flatnonzero(fit & (holder != todo))
            fit[maybe] = same_bytes(data, start[holder[maybe]], start[todo[maybe]], length[todo[maybe]])
            self.slot[todo[fit]] = at[fit]
            todo, at = todo[~fit], (at[~fit] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        self.used = np.flatnonzero(self.owner >= 0)
        self.bucket = np.zeros(size, np.int32)

    def crc(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes of each slot."""
        out, who, view = np.zeros(len(self.owner), np.uint32), self.owner[self.used], memoryview(data)
        out[self.used] = [zlib.crc32(view[a:b]) for a, b in zip(start[who].tolist(), end[who].tolist())]
        return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[Table]]:
    """Words of each row; for runs of 1, 2 .. ``ORDER`` words the row of each, and their table.

    The CRC of a longer run is put together from that of the run without its last word and that
    of the word, so bytes are read for distinct words only (and where a last word is very long).
    """
    packed, s, e, row = flat.plain_words(data, offsets)
    word = Table(packed, s, e - s)
    one = word.crc(packed, s, e)
    word.bucket[:] = one % np.uint32(BUCKETS)
    rows, tables, shorter = [row], [word], one[word.slot]
    for n in range(2, ORDER + 1):
        i = np.flatnonzero(row[n - 1 :] == row[: len(row) - n + 1]) if len(row) >= n else np.zeros(0, np.int64)
        table = Table(packed, s[i], e[i + n - 1] - s[i])
        first = i[table.owner[table.used]]  # first and last word of each distinct run
        last = first + n - 1
        size = e[last] - s[last]
        crc = crc_joined(shorter[first], one[word.slot[last]], np.minimum(size, _LONG))
        for j in np.flatnonzero(size > _LONG).tolist():
            crc[j] = zlib.crc32(packed[s[first[j]] : e[last[j]]].tobytes())
        table.bucket[table.used] = crc % np.uint32(BUCKETS)
        rows.append(row[i])
        tables.append(table)
        if n < ORDER:
            whole, found = np.zeros(len(table.owner), np.uint32), np.zeros(len(s), np.uint32)
            whole[table.used] = crc
            found[i] = whole[table.slot]
            shorter = found
    return np.bincount(row, minlength=len(offsets) - 1), rows, tables


def _bucket_counts(batches):
    """Non-zero buckets of all texts of a partition."""
    import pyarrow as pa

    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, off in flat.blocks(batch.column("text")):
            for table in features(data, off)[2]:
                # counts are far below 2^53, so sums as doubles are exact
                total += np.bincount(table.bucket[table.used], table.count[table.used], BUCKETS).astype(np.int64)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, text_column: str = "text") -> DataFrame:
    """(bucket, n) over all features of ``texts``."""
    found = texts.select(F.col(text_column).alias("text")).mapInArrow(_bucket_counts, "bucket bigint, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """Gain of each bucket in thousandths of a natural log unit, floored."""
    up, down = float(sum(source.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    ratio = [float(target.get(b, 0) + 1) * up / (float(source.get(b, 0) + 1) * down) for b in range(BUCKETS)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weights(gain: np.ndarray):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b, data, off in flat.blocks(batch.column("text")):
                n_words, rows, tables = features(data, off)
                count, total = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for row, table in zip(rows, tables):
                    by_slot = gain[table.bucket].astype(np.float64)
                    count += np.bincount(row, minlength=b - a)
                    total += np.bincount(row, by_slot[table.slot], b - a).astype(np.int64)
                weight = np.where(count > 0, total // np.maximum(count, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(n_words), pa.array(count), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (null where not drawn) per row of ``docs``."""
    counts = [{r["bucket"]: r["n"] for r in bucket_counts(x).collect()} for x in (docs, target)]  # BUCKETS rows at most
    gain = gains(*counts)
    weighed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _weights(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    )
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(label, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = staged(weighed.withColumn("score", (F.col("weight") + noise).cast("bigint")))
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * share // 100
    placed = number_rows(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_first()], "rank")
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.unionByName(rest)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score, rank per document."""
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
