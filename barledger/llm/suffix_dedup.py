"""Removal of repeated byte strings by suffix order and longest-previous-factor flags.

A byte is removed when a string of ``length`` bytes that covers it also starts elsewhere
(mode ``all``) or starts at an earlier place (mode ``later``: the first copy stays; places are
ordered by doc_id, text hash, offset).  Texts are UTF-8 bytes and strings never cross texts.

* **Anchors.** Each window of ``length`` bytes names one k-gram: its smallest by hash, the
  last one on ties.  That depends on the window's bytes alone, so equal windows name equal
  k-grams at equal offsets.  Consecutive windows with one k-gram form a *context*, about two
  per ``length`` bytes, and only (k-gram, context) hashes are shuffled.
* **Classes.** Contexts equal in every byte are settled at once, however many there are.
* **Suffix order.** What is left are contexts that share a k-gram but differ somewhere (the
  ends of shared passages).  Their bytes meet by k-gram and suffixes are ordered by prefix
  doubling up to ``length`` bytes.  In that order each suffix has a previous and a next
  neighbour with a smaller place; the longer of the common prefixes with the two is its longest
  previous factor (up to ``length``), and a window whose factor reaches ``length`` has an
  earlier copy.  The same with larger places tells later copies.
* **Very common k-grams** (more than ``HOT`` different contexts) are first cut into runs of a
  few windows, which are again settled by class; only runs that share their common part with
  a different run are compared window by window, by hash, with no group in one task.  These
  k-grams never reach the suffix order.

Rows repeated whole are one text with a flag: their anchors are counted once.

Defined cases: null text is empty; texts shorter than ``length`` keep all bytes; rows repeated
whole are copies in mode ``all`` and one text in mode ``later``; rows sharing a doc_id with
different texts are separate.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.common import NO_ID, carried, doc_key, staged, text_or_empty

LENGTH = 400
GRAM = 64
#: Different contexts of one k-gram that are put in suffix order together.
HOT = 512
#: Windows of one run of a very common k-gram.
RUN = 16
#: Bytes in one suffix order; ranks of two halves and a place must fit 62 bits.
ORDER_BYTES = 1 << 20

_SPAN = "d bigint, h bigint, s bigint, e bigint"


def _gram(length: int) -> int:
    return max(1, min(GRAM, length // 2))


def contexts(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Row, k-gram hash, context hash, first window, windows and k-gram offset of each context."""
    k = _gram(length)
    w = length - k + 1
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(counts.sum())
    if not total:
        z = np.zeros(0, np.int64)
        return {"row": z, "f": z, "c": z, "s": z, "n": z, "o": z}
    p = flat.prefix_hash(data)
    at = np.arange(len(data) - k + 1)
    gram = flat.span_hash(p, at, at + k)
    bits = int(len(data)).bit_length()
    low = np.uint64((1 << bits) - 1)
    key = (gram & ~low) | (low - at.astype(np.uint64))
    blocks = -(-len(key) // w)
    padded = np.full(blocks * w, np.uint64(2**64 - 1), np.uint64)
    padded[: len(key)] = key
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(counts) - counts), counts)
    anchor = (low - (np.minimum(back[start], ahead[start + w - 1]) & low)).astype(np.int64)
    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, total))
    s, a = start[begin], anchor[begin]
    c = flat.span_hash(p, s, s + n - 1 + length) + (a - s).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
    rows = row[begin]
    return {"row": rows, "f": gram[a].view(np.int64), "c": c.view(np.int64), "s": s - offsets[rows], "n": n, "o": a - s}


def _anchor_rows(length: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo, hi, data, off in flat.blocks(batch.column("text")):
                found = contexts(data, off, length)
                pick = pa.array(found.pop("row") + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d").take(pick), batch.column("h").take(pick), *map(pa.array, found.values())],
                    names=["d", "h", *found],
                )  # columns as in _ROWS

    return run


def _context_bytes(length: int):
    """Cut the wanted contexts out of their texts."""

    def run(batches):
        import pyarrow as pa

        names = ["d", "h", "f", "s", "n", "o", "hot", "body"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        for batch in batches:
            d, h = batch.column("d").to_pylist(), batch.column("h").to_pylist()
            wanted = batch.column("wanted").to_pylist()
            body, off = flat.raw(batch.column("text"))
            rows, size = [], 0
            for i, list_ in enumerate(wanted):
                for x in list_:
                    a = int(off[i]) + x["s"]
                    rows.append((d[i], h[i], x["f"], x["s"], x["n"], x["o"], x["hot"], body[a : a + x["n"] - 1 + length].tobytes()))
                    size += len(rows[-1][-1])
                    if size > flat.BLOCK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def prefix_ranks(data: np.ndarray, depth: int) -> tuple[list[np.ndarray], list[int]]:
    """Ranks of all suffixes by their first 1, 2, 4 .. ``depth`` bytes, and these lengths.

    Equal prefixes have equal ranks; a suffix that ends early is shorter than any longer one.
    """
    n = len(data)
    bits = max(1, int(n).bit_length())
    if 3 * bits > 63:
        raise ValueError("Too many bytes for one suffix order.")
    index = np.arange(n, dtype=np.int64)
    low = np.int64((1 << bits) - 1)

    def ranked(high: np.ndarray) -> np.ndarray:
        order = np.sort((high << bits) | index)
        value = order >> bits
        out = np.empty(n, np.int32)
        out[order & low] = np.cumsum(np.concatenate(([True], value[1:] != value[:-1])))
        return out

    def later(rank: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        if by < n:
            out[: n - by] = rank[by:]
        return out

    ranks, lengths = [ranked(data.astype(np.int64) + 1)], [1]
    while lengths[-1] < depth:
        reach = lengths[-1]
        by = min(reach, depth - reach)
        ranks.append(ranked((ranks[-1].astype(np.int64) << bits) | later(ranks[-1], by)))
        lengths.append(reach + by)
    return ranks, lengths


def common_prefix(ranks: list[np.ndarray], lengths: list[int], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes ``a`` and ``b``, up to the last of ``lengths``."""
    n, depth = len(ranks[0]), lengths[-1]
    out = np.where(ranks[-1][a] == ranks[-1][b], depth, 0)
    open_ = np.flatnonzero(out == 0)
    for rank, reach in zip(ranks[-2::-1], lengths[-2::-1]):
        i, j = a[open_] + out[open_], b[open_] + out[open_]
        inside = (i < n) & (j < n)
        same = np.zeros(len(open_), bool)
        same[inside] = rank[i[inside]] == rank[j[inside]]
        out[open_[same]] += reach
    return out


def nearest_smaller(place: np.ndarray) -> np.ndarray:
    """Index of the nearest element before each one that is smaller, -1 without one.

    All elements jump over their larger predecessors at once; what lies between an element and
    the one it points to is always larger, so every jump is sound.
    """
    at = np.arange(len(place)) - 1
    live = np.flatnonzero(at >= 0)
    while len(live):
        live = live[place[at[live]] > place[live]]
        at[live] = at[at[live]]
        live = live[at[live] >= 0]
    return at


def previous_factors(ranks: list[np.ndarray], lengths: list[int], starts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix at ``starts``: the longest prefix, up to the last
    length, that also starts at a smaller place.

    In suffix order (ties by place) it is met at the previous or the next suffix of smaller place.
    """
    order = np.lexsort((place, ranks[-1][starts]))
    sorted_place, suffix = place[order], starts[order]
    before = nearest_smaller(sorted_place)
    after = len(order) - 1 - nearest_smaller(sorted_place[::-1])[::-1]
    out = np.zeros(len(starts), np.int64)
    for other, has in ((before, before >= 0), (after, after < len(order))):
        i = np.flatnonzero(has)
        out[order[i]] = np.maximum(out[order[i]], common_prefix(ranks, lengths, suffix[i], suffix[other[i]]))
    return out


def factor_flags(data: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous (next) factor of the suffixes at ``starts`` reaches ``length``."""
    ranks, lengths = prefix_ranks(data, length)
    earlier = previous_factors(ranks, lengths, starts, place) >= length
    return earlier, previous_factors(ranks, lengths, starts, -place) >= length


def _spans(d, h, s, flag, first):
    """Maximal runs of flagged windows; ``first`` marks where a context begins."""
    edge = np.concatenate(([False], flag, [False]))
    begin = flag & (~edge[:-2] | first)
    end = flag & (~edge[2:] | np.append(first[1:], True))
    i, j = np.flatnonzero(begin), np.flatnonzero(end)
    return d[i], h[i], s[i], s[j]


def _ordered(length: int, mode: str):
    """Suffix order over whole k-gram groups; rows come sorted by k-gram."""

    def settle(rows):
        import pyarrow as pa

        rows.sort(key=lambda r: (r[0], r[1], r[3]))
        d, h, _, s, n = (np.array(c, np.int64) for c in list(zip(*rows))[:5])
        bodies = [r[5] for r in rows]
        sizes = np.array([len(b) for b in bodies], np.int64)
        base = np.cumsum(sizes) - sizes
        first = np.zeros(int(n.sum()), bool)
        first[np.cumsum(n) - n] = True
        inside = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
        starts = np.repeat(base, n) + inside
        data = np.frombuffer(b"".join(bodies), np.uint8)
        earlier, later = factor_flags(data, starts, np.arange(len(starts)), length)
        out = _spans(np.repeat(d, n), np.repeat(h, n), np.repeat(s, n) + inside, earlier | later if mode == "all" else earlier, first)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (*out[:3], out[3] + length)], names=["d", "h", "s", "e"])

    def run(batches):
        held, group, size, part = [], [], 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("d", "h", "f", "s", "n", "body"))):
                if group and row[2] != group[-1][2]:
                    if held and size + part >= ORDER_BYTES:
                        yield settle(held)
                        held, size = [], 0
                    held.extend(group)
                    size, part, group = size + part, 0, []
                group.append(row)
                part += len(row[5])
        if held and size + part >= ORDER_BYTES:
            yield settle(held)
            held = []
        if held or group:
            yield settle(held + group)

    return run


#: Rows of one output batch.
_OUT_ROWS = 50_000


def _batched(parts, names: list[str]):
    """Record batches of at most about ``_OUT_ROWS`` rows from tuples of equal-length arrays."""
    import pyarrow as pa

    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= _OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)


def _bodies(batches, names: list[str]):
    """Rows of the named columns, a few at a time."""
    for batch in batches:
        for lo in range(0, len(batch), 1000):
            part = batch.slice(lo, 1000)
            yield from zip(*(part.column(c).to_pylist() for c in names))


def _runs(length: int):
    """Cut contexts of very common k-grams into runs of windows.

    Runs are aligned to the k-gram, so equal windows fall into runs of equal offset.  The key
    of a run is the part that all its windows hold, its class the bytes of all of them.
    """
    size = max(1, min(RUN, length // 4))

    def cut(d, h, f, s, n, o, body):
        p = flat.prefix_hash(np.frombuffer(body, np.uint8))
        a = np.unique(np.concatenate(([0], np.arange((o + 1) % size, n, size))))
        z = np.append(a[1:], n) - 1
        side = (o - a) // size
        begin = o - size * side
        salt = np.full(len(a), f, np.int64).view(np.uint64) + side.view(np.uint64)
        key = flat.span_hash(p, begin, begin - size + 1 + length) + flat.mix(salt)
        whole = flat.span_hash(p, a, z + length) + (o - a).view(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        return np.full(len(a), d), np.full(len(a), h), key.view(np.int64), whole.view(np.int64), s + a, z - a + 1, o - a

    def run(batches):
        rows = _bodies(batches, ["d", "h", "f", "s", "n", "o", "body"])
        yield from _batched((cut(*r) for r in rows), ["d", "h", "f", "c", "s", "n", "o"])

    return run


def _windows(length: int):
    """Each window of the wanted runs as a context of its own, keyed by its hash."""

    def cut(d, h, s, n, body, wanted):
        at = [np.arange(x["s"], x["s"] + x["n"]) - s for x in wanted if s <= x["s"] < s + n]
        a = np.concatenate(at) if at else np.zeros(0, np.int64)
        key = flat.span_hash(flat.prefix_hash(np.frombuffer(body, np.uint8)), a, a + length).view(np.int64)
        return np.full(len(a), d), np.full(len(a), h), key, key, a + s, np.ones(len(a), np.int64), np.zeros(len(a), np.int64)

    def run(batches):
        rows = _bodies(batches, ["d", "h", "s", "n", "body", "wanted"])
        yield from _batched((cut(*r) for r in rows), ["d", "h", "f", "c", "s", "n", "o"])

    return run


_ROWS = "d bigint, h bigint, f bigint, c bigint, s bigint, n bigint, o bigint"


def _settle(rows: DataFrame, length: int, mode: str) -> tuple[DataFrame, DataFrame]:
    """Spans of contexts with equal copies; one row of each class that shares its key with another class."""
    # Both written apart: the join's tasks then do no more than join, so Spark splits a k-gram
    # that many rows share.
    often = staged(rows.groupBy("f").agg(F.count("*").alias("rows")).where("rows > 1").select("f"))
    found = staged(rows.join(often, "f", "left_semi"))
    # Texts repeated whole give the same row again: one row a place, with their number.
    live = staged(found.groupBy("d", "h", "f", "c", "s", "n", "o").agg(F.count("*").alias("times")))
    place = F.struct("d", "h", "s")
    copies = F.sum("times") if mode == "all" else F.count("*")
    classes = staged(
        live.groupBy("f", "c").agg(copies.alias("copies"), F.min(place).alias("first"), F.max("n").alias("n"), F.max("o").alias("o"))
    )
    copied = live.join(classes.where("copies > 1").select("f", "c", "first"), ["f", "c"])
    if mode == "later":
        copied = copied.where(place != F.col("first"))
    spans = copied.select("d", "h", "s", (F.col("s") + F.col("n") - 1 + length).alias("e"))
    several = classes.groupBy("f").agg(F.count("*").alias("classes")).where("classes > 1")
    edges = classes.join(several, "f").select("first.d", "first.h", "f", "first.s", "n", "o", (F.col("classes") > HOT).alias("hot"))
    return spans, edges


def _per_text(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy("d", "h").agg(F.collect_list(F.struct(*columns)).alias("wanted"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, mode: str = "all") -> DataFrame:
    """(d, h, spans): spans (s, e) of bytes to remove, unmerged; ``texts`` has d, h, text."""
    if mode not in ("all", "later") or length < 2:
        raise ValueError("mode is all or later, length at least 2")
    anchors = staged(texts.mapInArrow(_anchor_rows(length), _ROWS))
    spans, edges = _settle(anchors, length, mode)
    wanted = _per_text(edges, "f", "s", "n", "o", "hot")
    bodies = texts.join(wanted, ["d", "h"]).dropDuplicates(["d", "h"]).select("d", "h", "text", "wanted")
    bodies = staged(
        bodies.mapInArrow(_context_bytes(length), "d bigint, h bigint, f bigint, s bigint, n bigint, o bigint, hot boolean, body binary")
    )
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = bodies.where("not hot").repartition(parts, "f").sortWithinPartitions("f")
    found = [spans, few.mapInArrow(_ordered(length, mode), _SPAN)]
    common = bodies.where("hot")
    run_spans, run_edges = _settle(common.mapInArrow(_runs(length), _ROWS), length, mode)
    windows = common.join(_per_text(run_edges, "s", "n"), ["d", "h"]).mapInArrow(_windows(length), _ROWS)
    found += [run_spans, _settle(windows, length, mode)[0]]
    marks = found[0]
    for more in found[1:]:
        marks = marks.unionByName(more)
    return marks.groupBy("d", "h").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def whole_characters(body: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs shrunk so that no UTF-8 character is cut."""
    out = []
    for s, e in runs:
        while s < e and body[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(body) and body[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def _cut(digest: bool):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = [c for c in batch.schema.names if c not in ("text", "spans")]
            for lo, hi, body, off in flat.blocks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                spans = part.column("spans").to_pylist()
                rows = []
                for i in range(hi - lo):
                    whole = body[off[i] : off[i + 1]].tobytes()
                    runs = merged(spans[i])
                    if not digest:
                        runs = whole_characters(whole, runs)
                    kept, at = [], 0
                    for s, e in runs:
                        kept.append(whole[at:s])
                        at = e
                    kept.append(whole[at:])
                    left = b"".join(kept)
                    rows.append((len(whole), len(whole) - len(left), len(runs), hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "replace")))
                n = list(zip(*rows)) or [()] * 4
                new = [pa.array(c, k) for c, k in zip(n, (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], names=[*keep, "n_bytes", "n_removed", "n_spans", "out"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    key = doc_key()
    return docs.select(key["d"].alias("d"), key["h"].alias("h"), text_or_empty().alias("text"))


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per input row, every copy removed."""
    texts = _keyed(docs)
    spans = repeated_spans(texts, length, "all")
    out = texts.join(spans, ["d", "h"], "left").select("d", "text", "spans")
    cut = out.mapInArrow(_cut(True), "d bigint, n_bytes bigint, n_removed bigint, n_spans bigint, out string")
    return cut.select(F.nullif("d", F.lit(NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("out").alias("kept_sha256"))


def remove_later_copies(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with later copies of repeated strings cut out of ``text``; the first copy stays.

    Only whole characters are removed; a null text stays null.  Column order is kept.
    """
    spans = repeated_spans(_keyed(docs), length, "later").select(F.struct("d", "h").alias("node"), "spans")
    joined = carried(docs).join(spans, "node", "left").select("row", F.col("row.text").alias("text"), "spans")
    others = [c for c in docs.columns if c != "text"]
    given = joined.select(
        F.struct(*[F.col(f"row.`{c}`").alias(c) for c in others]).alias("row"), F.col("text").isNull().alias("absent"), "text", "spans"
    )
    kind = given.schema["row"].dataType.simpleString()
    cut = given.mapInArrow(_cut(False), f"row {kind}, absent boolean, n_bytes bigint, n_removed bigint, n_spans bigint, out string")
    text = F.when(F.col("absent"), F.lit(None).cast("string")).otherwise(F.col("out")).alias("text")
    return cut.select(*[text if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
