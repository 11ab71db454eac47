"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

A document's set holds its distinct five-word shingles (A-Z lower-cased, words split at
ASCII white space); fewer words make the whole sequence one shingle, no word the empty set.
Two documents are linked when ``100 * |A and B| >= 75 * |A or B|``.

* **Signature.** Element i visits the slots in a random order of its own; at step j it offers
  ``j + r`` to its j-th slot and a slot keeps the smallest offer.  Steps run for all elements
  of a block at once, and a document stops as soon as no slot is above the current step.
* **Copies** (equal word sequence) collapse to one class before anything is compared.
* **Banding.** Rows of equal band are compared with the smallest member of the band only
  (a star, linear in the group); links are confirmed on full sets.
* **Rest.** Bands whose members are still in several groups are compared exactly: within
  those documents, shingles are ordered by frequency and the rarest prefixes are joined.
  The shorter document of a pair uses the prefix that any match must hit, so that a very
  common passage (even three quarters of every text) gives no pairs.
* **Groups** are the connected components of the links.

With 40 bands of 4 slots a pair at the threshold is missed with probability below 3e-7.

Defined cases: null or blank text is linked with nothing; rows repeated whole are copies;
rows sharing a doc_id with different texts are separate documents; a null doc_id sorts before
every other id.  Only the two named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.common import NO_ID, carried, components, doc_key, restored, staged, text_or_empty

BANDS, ROWS = 40, 4
SHINGLE = 5
#: Similarity threshold in hundredths.
THRESHOLD = 75

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def _offers(elements: np.ndarray, step: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The random swap partner and the fraction of each element at one step."""
    with np.errstate(over="ignore"):
        x = flat.mix(elements + np.uint64(step + 1) * _STEP)
    k = step + (((x >> np.uint64(32)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
    return k, ((x & _LOW) | np.uint64(step << 32)).astype(np.int64)


def signatures(elements: np.ndarray, offsets: np.ndarray, slots: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash signature of each row's set; rows of an empty set get the largest value."""
    n = len(offsets) - 1
    h = np.full(n * slots, np.iinfo(np.int64).max, np.int64)
    sizes = np.diff(offsets)
    live = np.flatnonzero(sizes)
    order = swap = None
    for step in range(slots):
        if not len(live):
            break
        row = np.repeat(live, sizes[live])
        at = np.repeat(offsets[live] - np.concatenate(([0], np.cumsum(sizes[live])[:-1])), sizes[live]) + np.arange(len(row))
        e = elements[at]
        k, value = _offers(e, step, slots)
        if step == 0:
            slot = k
        elif step == 1:
            k0 = _offers(e, 0, slots)[0]
            slot = np.where(k == k0, 0, k)
        else:
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.int16), (len(e), 1))
                swap = np.arange(len(e))
                for past in range(2):
                    kp = _offers(e, past, slots)[0]
                    moved = order[swap, past].copy()
                    order[swap, past] = order[swap, kp]
                    order[swap, kp] = moved
            moved = order[swap, step].copy()
            order[swap, step] = order[swap, k]
            order[swap, k] = moved
            slot = order[swap, step].astype(np.int64)
        np.minimum.at(h, row * slots + slot, value)
        still = h.reshape(n, slots)[live].max(1) >= (step + 1) << 32
        if not still.all():
            if order is not None:
                order = order[np.repeat(still, sizes[live])]
                swap = np.arange(len(order))
            live = live[still]
    return h.reshape(n, slots)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    weights = np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7) | np.uint64(1)
    s = flat.mix(sig.astype(np.uint64)).reshape(len(sig), bands, rows)
    return flat.mix((s * weights).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = flat.LOWER[data]
    start, end, row = flat.word_spans(data, offsets)
    return flat.span_hash(flat.prefix_hash(data), start, end), row


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, row = word_hashes(data, offsets)
    return flat.shingle_sets(words, row, len(offsets) - 1, SHINGLE)


def _profile(batches):
    """Per row: two hashes of the word sequence, set size, band keys."""
    import pyarrow as pa

    for batch in batches:
        for a, b, data, off in flat.blocks(batch.column("text"), flat.BLOCK_BYTES // 4):
            words, row = word_hashes(data, off)
            sets, at = flat.shingle_sets(words, row, b - a, SHINGLE)
            keys = band_keys(signatures(sets, at))
            up, down = flat.powers(max(len(words), 1))
            bounds = np.searchsorted(row, np.arange(b - a + 1))
            seq = []
            for salt in (1, 2):
                p = np.zeros(len(words) + 1, np.uint64)
                np.cumsum(flat.mix(words + np.uint64(salt)) * up[: len(words)], out=p[1:])
                h = (p[bounds[1:]] - p[bounds[:-1]]) * down[bounds[:-1]]
                seq.append(flat.mix(h + np.diff(bounds).astype(np.uint64)).view(np.int64))
            n = np.diff(at)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(a, b - a) for c in ("d", "h")),
                    pa.array(seq[0]),
                    pa.array(seq[1]),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel())),
                ],
                names=["d", "h", "s1", "s2", "n", "keys"],
            )


def _verify(batches):
    """Pairs whose full sets meet the threshold.

    Rows come sorted by centre and slice, the centre's own row (no member) before its members,
    so one centre set is held at a time.
    """
    import pyarrow as pa

    centre = np.zeros(0, np.uint64)
    for batch in batches:
        alone = batch.column("bd").is_null().to_numpy(zero_copy_only=False)
        for lo, hi, data, off in flat.blocks(batch.column("text"), flat.BLOCK_BYTES // 2):
            sets, at = _sets(data, off)
            keep = np.zeros(hi - lo, bool)
            for i in range(hi - lo):
                other = sets[at[i] : at[i + 1]]
                if alone[lo + i]:
                    centre = other.copy()
                    continue
                small, large = (centre, other) if len(centre) < len(other) else (other, centre)
                if len(small) and 100 * len(small) >= THRESHOLD * len(large):
                    where = np.searchsorted(large, small)
                    where[where == len(large)] = 0
                    both = int((large[where] == small).sum())
                    keep[i] = 100 * both >= THRESHOLD * (len(small) + len(large) - both)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(keep)) for c in ("ad", "ah", "bd", "bh")], names=["ad", "ah", "bd", "bh"])


def _explode_sets(batches):
    """(d, h, size, shingle) of each distinct shingle."""
    import pyarrow as pa

    for batch in batches:
        for a, b, data, off in flat.blocks(batch.column("text"), flat.BLOCK_BYTES // 4):
            sets, at = _sets(data, off)
            n = np.diff(at)
            pick = pa.array(np.repeat(np.arange(a, b), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").take(pick), batch.column("h").take(pick), pa.array(np.repeat(n, n)), pa.array(sets.view(np.int64))],
                names=["d", "h", "size", "shingle"],
            )


#: 64-bit words of a parity sketch.
SKETCH = 16


def _sketches(batches):
    """Parity sketch of each set: bit b tells whether an odd number of shingles hash to b.

    Two sketches differ in at most as many bits as the sets differ in shingles, so a pair with
    more differing bits than the threshold allows is no link.
    """
    import pyarrow as pa

    bits = np.uint64(64 * SKETCH)
    for batch in batches:
        for a, b, data, off in flat.blocks(batch.column("text")):
            sets, at = _sets(data, off)
            row = np.repeat(np.arange(b - a), np.diff(at))
            odd = np.bincount(row * (64 * SKETCH) + (sets % bits).astype(np.int64), minlength=(b - a) * 64 * SKETCH) & 1
            words = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(b - a, SKETCH)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").slice(a, b - a), batch.column("h").slice(a, b - a), *(pa.array(words[:, i].copy()) for i in range(SKETCH))],
                names=["d", "h", *(f"o{i}" for i in range(SKETCH))],
            )


#: Members of one slice of a star.
FAN = 256


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Confirmed pairs (a, b) among candidate pairs; ``texts`` has node, text.

    The members of a centre are cut into slices of about ``FAN``; each slice gets the centre's
    text once, in the row before its members.
    """
    size = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).cast("int").alias("slices"))
    of = lambda name: texts.select(F.col("node").alias(name), "text")
    member = pairs.join(size, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int").alias("slice"))
    member = member.join(of("b"), "b").select("a", "slice", "b", "text")
    centre = size.join(of("a"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "text")
    rows = member.unionByName(centre, allowMissingColumns=True).select(
        F.col("a.d").alias("ad"), F.col("a.h").alias("ah"), "slice", F.col("b.d").alias("bd"), F.col("b.h").alias("bh"), "text"
    )
    order = ["ad", "ah", "slice", F.col("bd").asc_nulls_first()]
    ready = rows.repartition("ad", "ah", "slice").sortWithinPartitions(*order)
    found = ready.mapInArrow(_verify, "ad bigint, ah bigint, bd bigint, bh bigint")
    return found.select(
        F.struct(F.col("ad").alias("d"), F.col("ah").alias("h")).alias("a"),
        F.struct(F.col("bd").alias("d"), F.col("bh").alias("h")).alias("b"),
    )


def _rare_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Candidate pairs of ``nodes`` (node, root) in different groups: exact prefix join."""
    of = texts.join(nodes.select("node"), "node", "left_semi").select("node.d", "node.h", "text")
    shingles = staged(of.mapInArrow(_explode_sets, "d bigint, h bigint, size bigint, shingle bigint"))
    often = shingles.groupBy("shingle").agg(F.count("*").alias("df"))
    from pyspark.sql import Window

    w = Window.partitionBy("d", "h").orderBy("df", "shingle")
    probe = F.col("size") - F.ceil(F.col("size") * THRESHOLD / 100) + 1
    # 2t/(1+t) of the shorter set must be shared when the other is at least as long
    index = F.col("size") - F.ceil(F.col("size") * (2 * THRESHOLD) / (100 + THRESHOLD) - 1e-9) + 1
    prefix = (
        shingles.join(often, "shingle")
        .withColumn("r", F.row_number().over(w))
        .where((F.col("r") <= probe) & (F.col("df") > 1))
        .select("shingle", "size", (F.col("r") <= index).alias("short"), F.struct("d", "h").alias("node"))
        .join(nodes, "node")
    )
    prefix = staged(prefix)
    mixed = prefix.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("shingle")
    words = [f"o{i}" for i in range(SKETCH)]
    sketches = of.mapInArrow(_sketches, "d bigint, h bigint, " + ", ".join(f"{w} bigint" for w in words))
    sketches = staged(sketches.select(F.struct("d", "h").alias("node"), *words))
    live = staged(prefix.join(mixed, "shingle", "left_semi").join(sketches, "node"))
    x = live.where("short").select("shingle", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("size").alias("sx"), *[F.col(w).alias(f"x{w}") for w in words])
    y = live.select("shingle", F.col("node").alias("y"), F.col("root").alias("ry"), F.col("size").alias("sy"), *[F.col(w).alias(f"y{w}") for w in words])
    differ = " + ".join(f"bit_count(x{w} ^ y{w})" for w in words)
    met = x.join(y, "shingle").where(
        f"rx != ry and (sx < sy or (sx = sy and x < y)) and 100 * sx >= {THRESHOLD} * sy"
        f" and {100 + THRESHOLD} * ({differ}) <= {100 - THRESHOLD} * (sx + sy)"
    )
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: d, h (row key), n_shingles, root (struct d, h of its group)."""
    rows = docs.select(doc_key(id_column, text_column).alias("node"), text_or_empty(text_column).alias("text"))
    base = staged(
        rows.select("node.d", "node.h", "text").mapInArrow(
            _profile, "d bigint, h bigint, s1 bigint, s2 bigint, n bigint, keys array<bigint>"
        )
    )
    classes = base.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("d", "h")).alias("node"))
    classes = staged(classes)
    first = base.select(F.struct("d", "h").alias("node"), "s1", "s2", "keys").join(classes, ["node", "s1", "s2"], "left_semi")
    bands = first.dropDuplicates(["node"]).select("node", F.explode("keys").alias("key"))
    bands = staged(bands)
    groups = bands.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    multi = staged(bands.join(groups, "key"))
    stars = staged(multi.where("node != a").select("a", F.col("node").alias("b")).distinct())
    touched = multi.select("node").distinct()
    texts = staged(rows.join(touched, "node", "left_semi").dropDuplicates(["node"]))
    links = staged(_links(stars, texts))
    labels = components(links)
    rooted = multi.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    rooted = staged(rooted)
    split = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key")
    rest = staged(rooted.join(split, "key", "left_semi").select("node", "root").distinct())
    if not rest.isEmpty():
        pairs = _rare_pairs(rest, texts).join(stars, ["a", "b"], "left_anti")
        more = staged(_links(pairs, texts))
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    named = classes.join(labels, "node", "left").select("s1", "s2", F.coalesce("root", "node").alias("root"))
    return base.select("d", "h", "n", "s1", "s2").join(named, ["s1", "s2"], "left").select(
        "d", "h", F.col("n").alias("n_shingles"), F.coalesce("root", F.struct("d", "h")).alias("root")
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per input row (see the module text)."""
    found = near_duplicates(docs)
    ids = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return found.select(
        ids("d").alias("doc_id"),
        "n_shingles",
        ids("root.d").alias("component_id"),
        F.col("d").eqNullSafe(F.col("root.d")).alias("kept"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without later members of each group; rows repeated whole count once."""
    found = near_duplicates(docs).where((F.struct("d", "h") == F.col("root")))
    stay = found.select(F.struct("d", "h").alias("node")).distinct()
    one = carried(docs).join(stay, "node", "left_semi").dropDuplicates(["node"])
    return restored(one, docs)
