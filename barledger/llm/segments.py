"""Toxicity by maximum-scoring segments with extreme-value calibration.

* **Token scores.** Log-odds of a token in toxic against other training texts under an
  informative Dirichlet prior (the pooled counts, of weight ``PRIOR``).  Tokens are hashed to
  ``BUCKETS`` buckets.  A bucket counts only if its log-odds is ``Z`` standard deviations from
  zero; every score loses ``MARGIN``, so that the expected score is negative, as the statistics
  of segments need.
* **Segments.** All maximal scoring segments of a text are found in one pass in linear time
  (only runs of positive tokens make candidates).
* **Calibration.** Lambda solves ``E[exp(lambda s)] = 1`` over tokens of other texts; K is
  fitted to the maxima of other training texts (Gumbel).  A segment is significant when
  ``K n exp(-lambda S)`` is at most ``E_VALUE``.  A logistic curve over the normalised maximum
  and the significant mass gives the score.

Labels are learned only from rows whose CRC-32 of the id text modulo 5 is not 0, from at most
``FIT_ROWS`` of them (the smallest id hashes; a documented bound), so the fitted model has a fixed
size.  All rows are scored.  Labels, lang, source and ids are never inputs of a score.

Defined cases: null, empty and blank texts have no tokens and the score of a text without any
segment; repeated label rows count toxic if one of them is; null labels are passed over; without
labels of both kinds every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.common import staged, text_or_empty

BUCKETS = 1 << 18
FIT_ROWS = 20_000
PRIOR = 20_000.0
Z = 4.0
MARGIN = 0.7
E_VALUE = 0.05

_PUNCT = np.zeros(256, bool)
_PUNCT[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


@dataclass
class Model:
    scores: np.ndarray
    lam: float
    log_k: float
    weights: np.ndarray  # intercept, normalised maximum, significant mass


def held_out(doc_id: Column) -> Column:
    """CRC-32 of the id as text modulo 5 is 0; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 5 == 0


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, row, start and end of each token (lower-cased, edge punctuation cut)."""
    s, e, row = flat.word_spans(data, offsets)
    if not len(s):
        return s, row, s, e
    solid = ~_PUNCT[data]
    n = len(data)
    index = np.arange(n, dtype=np.int32)
    ahead = np.minimum.accumulate(np.where(solid, index, n)[::-1])[::-1]
    back = np.maximum.accumulate(np.where(solid, index, -1))
    a, z = np.minimum(ahead[s], e), np.maximum(back[e - 1] + 1, s)
    full = a < z
    s, e, row = a[full], z[full], row[full]
    h = flat.span_hash(flat.prefix_hash(flat.LOWER[data]), s, e)
    return (h % np.uint64(BUCKETS)).astype(np.int64), row, s, e


def maximal_segments(values: list[float], places: list[int]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) of a sequence given as alternating
    runs; ``places`` are the run numbers.  One pass; each candidate is joined at most once."""
    total, stack = 0.0, []  # (sum before, sum at end, first, last, index of nearest with smaller left)
    for v, p in zip(values, places):
        if v <= 0:
            total += v
            continue
        left, right, first = total, total + v, p
        total = right
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                del stack[len(stack) :]
                stack.append((left, right, first, p, j))
                break
            left, first = stack[j][0], stack[j][2]
            nxt = stack[j][4]
            del stack[j:]
            j = nxt
    return [(r - l, a, z) for l, r, a, z, _ in stack]


def text_segments(scores: np.ndarray, row: np.ndarray, n_rows: int):
    """For each row: tokens, and its maximal segments as (score, first token, last token)."""
    bounds = np.searchsorted(row, np.arange(n_rows + 1))
    positive = scores > 0
    change = np.ones(len(scores), bool)
    change[1:] = (positive[1:] != positive[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], len(scores))
    sums = np.add.reduceat(scores, begin) if len(begin) else np.zeros(0)
    cut = np.searchsorted(begin, bounds)
    has = np.zeros(n_rows, bool)
    has[np.unique(row[positive])] = True
    for i in range(n_rows):
        n = int(bounds[i + 1] - bounds[i])
        if not has[i]:
            yield n, []
            continue
        a, z = cut[i], cut[i + 1]
        found = maximal_segments(sums[a:z].tolist(), list(range(a, z)))
        yield n, [(s, int(begin[f] - bounds[i]), int(end[l] - 1 - bounds[i])) for s, f, l in found]


def features(n: int, segments: list, lam: float, log_k: float) -> tuple[float, float, int]:
    """Normalised maximum, significant mass and number of significant segments."""
    if not segments or not n:
        return -5.0, 0.0, 0
    bits = [lam * s - log_k - np.log(n) for s, _, _ in segments]
    good = [b for b in bits if b >= -np.log(E_VALUE)]
    return float(np.clip(max(bits), -5.0, 60.0)), float(np.log1p(sum(good))), len(good)


def _count_tokens(batches):
    """(bucket, toxic tokens, other tokens) summed over the partition."""
    import pyarrow as pa

    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        toxic = np.array(batch.column("toxic").to_pylist(), np.int64)
        for lo, hi, data, off in flat.blocks(batch.column("text")):
            b, row, _, _ = buckets(data, off)
            for label in (0, 1):
                counts[label] += np.bincount(b[toxic[lo:hi][row] == label], minlength=BUCKETS)
    used = np.flatnonzero(counts.sum(0))
    for i in range(0, len(used), 50_000):
        u = used[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(counts[1][u]), pa.array(counts[0][u])], names=["bucket", "toxic", "other"])


def token_scores(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log-odds with Dirichlet prior where significant, pooled log-odds elsewhere, less the margin."""
    n_t, n_c = max(toxic.sum(), 1), max(other.sum(), 1)
    prior = PRIOR * (toxic + other) / (n_t + n_c) + 1e-9
    t, c = toxic + prior, other + prior
    log_odds = np.log(t / (n_t + PRIOR - t)) - np.log(c / (n_c + PRIOR - c))
    sure = np.abs(log_odds) / np.sqrt(1 / t + 1 / c) >= Z
    rest_t, rest_c = toxic[~sure].sum() + 1.0, other[~sure].sum() + 1.0
    pooled = np.log(rest_t / n_t) - np.log(rest_c / n_c)
    return np.where(sure, log_odds, min(pooled, 0.0)) - MARGIN


def solve_lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1; 1 when no score is positive."""
    p = weights / weights.sum()
    live = p > 0
    s, p = scores[live], p[live]
    if not (s > 0).any() or (p * s).sum() >= 0:
        return 1.0
    lo, hi = 1e-6, 1.0
    while (p * np.exp(np.minimum(hi * s, 500))).sum() < 1 and hi < 64:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        if (p * np.exp(np.minimum(mid * s, 500))).sum() < 1:
            lo = mid
        else:
            hi = mid
    return hi


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic curve by Newton steps."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _segments_of(model, columns: list[str], full: bool):
    def run(batches):
        import pyarrow as pa

        m = Model(*model.value)
        for batch in batches:
            for lo, hi, data, off in flat.blocks(batch.column("text")):
                b, row, start, end = buckets(data, off)
                first = np.searchsorted(row, np.arange(hi - lo))
                out = []
                for i, (n, segs) in enumerate(text_segments(m.scores[b], row, hi - lo)):
                    x1, x2, good = features(n, segs, m.lam, m.log_k)
                    best = max((s for s, _, _ in segs), default=0.0)
                    places = []
                    if full and n:
                        least = (-np.log(E_VALUE) + m.log_k + np.log(n)) / m.lam
                        places = [
                            {"start": int(start[first[i] + a] - off[i]), "end": int(end[first[i] + z] - off[i]), "score": float(s)}
                            for s, a, z in segs
                            if s >= least
                        ]
                    p = float(1 / (1 + np.exp(-np.clip(m.weights @ np.array([1.0, x1, x2]), -30, 30))))
                    out.append((n, best, x1, x2, good, p, places))
                cols = list(zip(*out)) or [()] * 7
                place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
                types = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), place]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in columns), *(pa.array(c, t) for c, t in zip(cols, types))],
                    names=[*columns, "n", "best", "x1", "x2", "n_segments", "score", "segments"],
                )

    return run


_OUT = "n bigint, best double, x1 double, x2 double, n_segments bigint, score double, segments array<struct<start:bigint,end:bigint,score:double>>"


def _apply(rows: DataFrame, model: Model, columns: dict[str, str], full: bool = False) -> DataFrame:
    value = rows.sparkSession.sparkContext.broadcast((model.scores.astype(np.float32), model.lam, model.log_k, model.weights))
    schema = ", ".join(f"{c} {t}" for c, t in columns.items())
    return rows.select(*columns, "text").mapInArrow(_segments_of(value, list(columns), full), f"{schema}, {_OUT}")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of bounded size from at most FIT_ROWS labelled texts outside the held-out fold.

    A text counts once for each doc_id, however often its row is repeated.
    """
    marks = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("bigint").alias("toxic"))
    )
    texts = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("h"), text_or_empty().alias("text"))
    chosen = (
        texts.select("doc_id", "h").distinct().join(marks, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "h")
        .limit(FIT_ROWS)
    )
    # FIT_ROWS rows of three numbers at most: a proven bound
    rows = texts.join(F.broadcast(chosen), ["doc_id", "h"])
    train = staged(rows.groupBy("doc_id", "h").agg(F.first("toxic").alias("toxic"), F.first("text").alias("text")).drop("doc_id", "h"))
    counts = np.zeros((2, BUCKETS), np.int64)
    for r in train.mapInArrow(_count_tokens, "bucket bigint, toxic bigint, other bigint").groupBy("bucket").agg(F.sum("toxic"), F.sum("other")).collect():
        counts[0, r[0]], counts[1, r[0]] = r[1], r[2]
    toxic, other = counts
    scores = token_scores(toxic, other) if toxic.sum() and other.sum() else np.full(BUCKETS, -MARGIN)
    lam = solve_lambda(scores, other.astype(float)) if other.sum() else 1.0
    model = Model(scores, lam, 0.0, np.zeros(3))
    seen = _apply(train, model, {"toxic": "bigint"}).select("toxic", "n", "best").collect()  # FIT_ROWS at most
    maxima = [lam * r.best - np.log(r.n) for r in seen if not r.toxic and r.best > 0]
    model.log_k = float(np.mean(maxima) - np.euler_gamma) if len(maxima) >= 20 else 0.0
    made = _apply(train, model, {"toxic": "bigint"}).select("toxic", "x1", "x2").collect()
    y = np.array([r.toxic for r in made], float)
    if len(y) and 0 < y.mean() < 1:
        model.weights = logistic(np.array([(r.x1, r.x2) for r in made]), y)
    else:
        share = y.mean() if len(y) else 0.0
        model.weights = np.array([30.0 if share == 1 else -30.0, 0.0, 0.0])
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, and the significant passages as byte spans, per input row."""
    return _apply(docs.select("doc_id", text_or_empty().alias("text")), model, {"doc_id": "bigint"}, full=True)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_segments per row."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = scored(d, fit(d, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_segments", "segments")
