"""Benchmark decontamination by template canonicalisation and slot consistency.

A text becomes template tokens: words (ASCII white space) without edge punctuation, lower-cased;
numbers become <num>, numbers glued to letters <qty>, a unit word after a number <unit>, and a
capitalised word inside a sentence <name>.  Windows of ``WINDOW`` template tokens with at least
``LITERALS`` ordinary words are hash-joined between documents and benchmark items.

For each (document, item) the joined windows are judged in two ways.

* **By value**, all places of the document together: each benchmark value takes the document
  value that most windows give it, windows that say otherwise are dropped (``windows``).
* **By slot**, each place by itself (``place_windows``, the best place): a place is a run of
  windows that go on in document and item alike, apart by at most ``DRIFT`` tokens from one to
  the next.  Each slot of the item takes one value there, two slots that share a benchmark
  value may take two.

A document is contaminated by an item when either way leaves enough of the item's windows
(``NEED`` windows or ``SHARE`` of them).  The match is ``exact`` when every slot value of the
way that leaves more is equal, and ``reparameterised`` when values were exchanged.

Items without a usable window (under ``WINDOW`` tokens, or dense with numbers, units and names)
have one template of all their tokens, hashed at its own length and joined in the same way.
They have no share: the document holds the whole template or not.  Equal slots always count;
exchanged values count when each benchmark value takes one value and the item has an ordinary
word.  Their rows have one window of one.

Document windows first pass a bit table of fixed size made from the benchmark's window hashes
(the only broadcast value: ``TABLE_BITS`` bits however large the benchmark is); what passes is
joined in Spark, so the table never decides.

Lengths of such items reach the driver, one number for each distinct length.

Defined cases: null texts and items have no tokens and match nothing; a text shorter than a
window can hold whole items only; repeated rows give equal results; only the named columns are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.common import NO_ID, carried, doc_key, restored, staged, text_or_empty

WINDOW = 8
LITERALS = 5
NEED = 6
SHARE = 0.6
#: Tokens put in or left out between two windows of one place.
DRIFT = 4
TABLE_BITS = 1 << 23

# Unit words, singular and plural, as they follow a number.
UNITS = (
    "mm cm m km mg g kg t ml l in ft yd mi oz lb lbs inch inches foot feet yard yards mile miles meter meters metre metres "
    "gram grams kilogram kilograms ton tons tonne tonnes liter liters litre litres second seconds minute minutes hour hours "
    "day days week weeks month months year years dollar dollars cent cents euro euros pound pounds percent degrees watt watts "
    "volt volts mph kmh tage stunden minuten jahre jours heures minutos horas años dias días ans euros"
).split()

_PUNCT = np.zeros(256, bool)
_PUNCT[[i for i in range(33, 127) if not chr(i).isalnum()]] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?:"]] = True
_NUM, _QTY, _UNIT, _NAME = (np.uint64(0x1F2E3D4C5B6A7988 + i) for i in range(4))
_KINDS = {1: "num", 2: "qty", 3: "unit", 4: "name"}


def _lowered(data: np.ndarray) -> np.ndarray:
    out = flat.LOWER[data]
    if len(out) > 1:
        two = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][two] += 32
    return out


def _count(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=out[1:], dtype=np.int32)
    return out


_UNIT_HASHES: np.ndarray | None = None


def _unit_hashes() -> np.ndarray:
    global _UNIT_HASHES
    if _UNIT_HASHES is None:
        body = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
        s, e, _ = flat.word_spans(body, np.array([0, len(body)]))
        _UNIT_HASHES = np.unique(flat.span_hash(flat.prefix_hash(body), s, e))
    return _UNIT_HASHES


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Start, end, row, template hash and slot kind (0: ordinary word) of each template token."""
    s, e, row = flat.word_spans(data, offsets)
    n = len(data)
    if not len(s):
        return s, e, row, np.zeros(0, np.uint64), np.zeros(0, np.int8)
    solid = ~_PUNCT[data]
    index = np.arange(n, dtype=np.int32)
    ahead = np.minimum.accumulate(np.where(solid, index, n)[::-1])[::-1]
    back = np.maximum.accumulate(np.where(solid, index, -1))
    a, z = np.minimum(ahead[s], e), np.maximum(back[e - 1] + 1, s)
    ends = _count(_END[data])
    closes = ends[e] > ends[np.minimum(z, e)]
    breaks = _count(data == 10)
    opens = np.ones(len(s), bool)
    opens[1:] = (row[1:] != row[:-1]) | closes[:-1] | (breaks[s[1:]] > breaks[e[:-1]])
    full = a < z
    s, e, row, opens = a[full], z[full], row[full], opens[full]
    digit = _count((data >= 48) & (data <= 57))
    letter = _count(solid & ~((data >= 48) & (data <= 57)))
    big = (data >= 65) & (data <= 90)
    upper_two = np.zeros(n, bool)
    if n > 1:
        upper_two[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    big |= upper_two
    upper = _count(big)
    digits, letters = digit[e] - digit[s], letter[e] - letter[s]
    is_num = (digits > 0) & (letters == 0)
    is_qty = (digits > 0) & (letters > 0) & (data[s] >= 48) & (data[s] <= 57)
    is_name = big[s] & (upper[e] - upper[s] == 1) & (e - s > 1) & ~opens & (digits == 0)
    h = flat.span_hash(flat.prefix_hash(_lowered(data)), s, e)
    after = np.zeros(len(s), bool)
    after[1:] = is_num[:-1] & (row[1:] == row[:-1])
    is_unit = after & np.isin(h, _unit_hashes())
    kind = np.zeros(len(s), np.int8)
    for mask, k, v in ((is_name, 4, _NAME), (is_unit, 3, _UNIT), (is_qty, 2, _QTY), (is_num, 1, _NUM)):
        h[mask], kind[mask] = v, k
    return s, e, row, h, kind


def windows(h: np.ndarray, kind: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and hash of each window with enough ordinary words."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    plain = _count(kind == 0)
    at = np.flatnonzero((row[:n] == row[WINDOW - 1 :]) & (plain[WINDOW:] - plain[:n] >= LITERALS))
    out = np.zeros(len(at), np.uint64)
    for j in range(WINDOW):
        out += h[at + j] * np.uint64(((j + 1) * 0xA0761D6478BD642F | 1) & (2**64 - 1))
    return at, flat.mix(out)


def _slot(data: np.ndarray, s: np.ndarray, e: np.ndarray, kind: np.ndarray, j: int) -> str:
    return _KINDS[int(kind[j])] + ":" + data[s[j] : e[j]].tobytes().decode("utf-8", "replace").lower()


def spans(h: np.ndarray, row: np.ndarray, size: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and hash of each run of ``size`` tokens inside a text; ``p`` is the prefix hash of ``h``."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[:n] == row[size - 1 :])
    return at, flat.span_hash(p, at, at + size)


def _set_bits(table: bytes, w: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(table, np.uint64)
    slot = w % np.uint64(TABLE_BITS)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _item_rows(batches):
    """(d, h, w, size, plain, slots) of each item without a usable window."""
    import pyarrow as pa

    for batch in batches:
        for lo, hi, data, off in flat.blocks(batch.column("text")):
            s, e, row, h, kind = tokens(data, off)
            windowed = np.unique(row[windows(h, kind, row)[0]])
            p = flat.prefix_hash(h)
            whole = [i for i in np.unique(row).tolist() if i not in windowed]
            first, last = np.searchsorted(row, whole), np.searchsorted(row, whole, "right")
            w = flat.span_hash(p, first, last)
            slots = [[_slot(data, s, e, kind, j) for j in range(a, b) if kind[j]] for a, b in zip(first, last)]
            plain = [int((kind[a:b] == 0).sum()) for a, b in zip(first, last)]
            pick = pa.array(np.array(whole, np.int64) + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").take(pick), batch.column("h").take(pick), pa.array(w.view(np.int64)), pa.array(last - first, pa.int64()), pa.array(plain, pa.int64()), pa.array(slots, pa.list_(pa.string()))],
                names=["d", "h", "w", "size", "plain", "slots"],
            )


def _whole_rows(table, sizes: list[int]):
    """(d, h, w, slots) of the runs of tokens whose bit is set, each once a text and block."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo, hi, data, off in flat.blocks(batch.column("text")):
                s, e, row, h, kind = tokens(data, off)
                p = flat.prefix_hash(h)
                found: dict[tuple, None] = {}
                for size in sizes:
                    at, w = spans(h, row, size, p)
                    hit = _set_bits(table.value, w)
                    for i, x in zip(at[hit].tolist(), w[hit].view(np.int64).tolist()):
                        found[int(row[i]) + lo, x, tuple(_slot(data, s, e, kind, j) for j in range(i, i + size) if kind[j])] = None
                pick = pa.array([r for r, _, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d").take(pick), batch.column("h").take(pick), pa.array([w for _, w, _ in found], pa.int64()), pa.array([list(v) for _, _, v in found], pa.list_(pa.string()))],
                    names=["d", "h", "w", "slots"],
                )

    return run


def _window_rows(table=None):
    """(d, h, w, pos, slots, offs) of each window, or of those whose bit is set."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo, hi, data, off in flat.blocks(batch.column("text")):
                s, e, row, h, kind = tokens(data, off)
                at, w = windows(h, kind, row)
                if table is not None:
                    hit = _set_bits(table.value, w)
                    at, w = at[hit], w[hit]
                first = np.searchsorted(row, np.arange(hi - lo))
                slots, offs = [], []
                for i in at.tolist():
                    inside = i + np.flatnonzero(kind[i : i + WINDOW])
                    offs.append((inside - i).tolist())
                    slots.append([_slot(data, s, e, kind, j) for j in inside])
                pick = pa.array(row[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d").take(pick), batch.column("h").take(pick), pa.array(w.view(np.int64)), pa.array((at - first[row[at]]).astype(np.int64)), pa.array(slots, pa.list_(pa.string())), pa.array(offs, pa.list_(pa.int32()))],
                    names=["d", "h", "w", "pos", "slots", "offs"],
                )

    return run


_WINDOW_ROWS = "d bigint, h bigint, w bigint, pos bigint, slots array<string>, offs array<int>"


def consistent(matches: list[dict]) -> tuple[int, int]:
    """Item windows whose slots follow the commonest mapping, and slots whose value changed."""
    votes: dict[str, Counter] = defaultdict(Counter)
    for m in matches:
        for b, d in set(zip(m["b"], m["v"])):
            votes[b][d] += 1
    best = {b: min(c.items(), key=lambda x: (-x[1], x[0] != b, x[0]))[0] for b, c in votes.items()}
    left, changed = set(), set()
    for m in matches:
        if all(best[b] == d for b, d in zip(m["b"], m["v"])):
            left.add(m["i"])
            changed.update(b for b, d in zip(m["b"], m["v"]) if b != d)
    return len(left), len(changed)


def places(matches: list[dict]) -> list[list[dict]]:
    """Runs of windows in document order whose item positions grow with the document's."""
    found: list[list[dict]] = []
    open_: dict[int, list[dict]] = {}  # by alignment, document position minus item position
    near = sorted(range(-DRIFT, DRIFT + 1), key=abs)
    for m in sorted(matches, key=lambda m: (m["p"], m["i"])):
        at = m["p"] - m["i"]
        for step in near:
            run = open_.get(at + step)
            # at the same alignment a gap is only a changed word; elsewhere the windows must be near
            if run and run[-1]["i"] < m["i"] and run[-1]["p"] < m["p"] and (not step or m["p"] - run[-1]["p"] <= 2 * WINDOW + DRIFT):
                del open_[at + step]
                break
        else:
            run = []
            found.append(run)
        run.append(m)
        open_[at] = run
    return found


def placed(matches: list[dict]) -> tuple[int, int]:
    """Item windows of the best place, one value a slot, and benchmark values that changed there."""
    best = (0, 0)
    for run in places(matches):
        votes: dict[int, Counter] = defaultdict(Counter)
        for m in run:
            for o, b, d in zip(m["o"], m["b"], m["v"]):
                votes[m["i"] + o][d, d != b] += 1
        takes = {slot: min(c.items(), key=lambda x: (-x[1], x[0][1], x[0][0]))[0][0] for slot, c in votes.items()}
        left, changed = set(), set()
        for m in run:
            if all(takes[m["i"] + o] == d for o, d in zip(m["o"], m["v"])):
                left.add(m["i"])
                changed.update(b for b, d in zip(m["b"], m["v"]) if b != d)
        best = max(best, (len(left), -len(changed)))
    return best[0], -best[1]


def _judge(batches):
    import pyarrow as pa

    for batch in batches:
        matches = batch.column("matches").to_pylist()
        by_value, by_slot = [consistent(x) for x in matches], [placed(x) for x in matches]
        changed = [s[1] if s[0] >= v[0] else v[1] for v, s in zip(by_value, by_slot)]
        keep = ["d", "h", "item_id", "item_windows"]
        made = [pa.array(x, pa.int64()) for x in ([v[0] for v in by_value], [s[0] for s in by_slot], changed)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], names=[*keep, "windows", "place_windows", "changed_slots"])


def _bit_table(wanted: DataFrame):
    """Broadcast bits of the hashes ``w``: at most TABLE_BITS / 64 rows whatever the benchmark's size."""
    bit = F.expr(f"w & {TABLE_BITS - 1}L")
    rows = (
        wanted.select(bit.alias("bit"))
        .groupBy(F.shiftrightunsigned("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .collect()
    )
    bits = np.zeros(TABLE_BITS // 64, np.uint64)
    for r in rows:
        bits[r["at"]] = np.uint64(r["bits"] & (2**64 - 1))
    return wanted.sparkSession.sparkContext.broadcast(bits.tobytes())


def _whole(items: DataFrame, texts: DataFrame) -> DataFrame:
    """Judged rows of the items without a usable window."""
    wanted = staged(items.mapInArrow(_item_rows, "d bigint, h bigint, w bigint, size bigint, plain bigint, slots array<string>"))
    sizes = sorted(r["size"] for r in wanted.select("size").distinct().collect())
    if sizes:
        hits = texts.mapInArrow(_whole_rows(_bit_table(wanted), sizes), "d bigint, h bigint, w bigint, slots array<string>").distinct()
    else:
        hits = texts.sparkSession.createDataFrame([], "d bigint, h bigint, w bigint, slots array<string>")
    side = wanted.select("w", "plain", F.col("d").alias("item_id"), F.col("slots").alias("b")).distinct()
    met = hits.join(side, "w").where(F.size("b") == F.size("slots"))
    # pairs (benchmark value, document value): as many as benchmark values when each takes one
    pairs = F.array_distinct(F.arrays_zip(F.col("b").alias("b"), F.col("slots").alias("v")))
    met = met.withColumn("one", F.size(pairs) == F.size(F.array_distinct("b")))
    met = met.withColumn("changed", F.size(F.filter(pairs, lambda x: x["b"] != x["v"])))
    fits = met.where((F.col("changed") == 0) | (F.col("one") & (F.col("plain") > 0)))
    one = F.lit(1).cast("bigint").alias
    return fits.groupBy("d", "h", "item_id").agg(F.min("changed").cast("bigint").alias("changed_slots")).select(
        "d", "h", "item_id", one("item_windows"), one("windows"), one("place_windows"), "changed_slots"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(d, h, item_id, windows, place_windows, item_windows, changed_slots, kind) of contaminated texts."""
    key = doc_key()
    items = benchmark.select(F.coalesce("item_id", F.lit(NO_ID)).cast("bigint").alias("d"), F.xxhash64(text_or_empty()).alias("h"), text_or_empty().alias("text")).distinct()
    wanted = staged(items.mapInArrow(_window_rows(), _WINDOW_ROWS))
    table = _bit_table(wanted)
    texts = docs.select(key["d"].alias("d"), key["h"].alias("h"), text_or_empty().alias("text"))
    hits = staged(texts.mapInArrow(_window_rows(table), _WINDOW_ROWS).distinct())
    sizes = wanted.groupBy(F.col("d").alias("item_id")).agg(F.count_distinct("h", "pos").alias("item_windows"))
    side = wanted.select("w", F.col("d").alias("item_id"), F.col("pos").alias("i"), F.col("slots").alias("b")).distinct()
    met = hits.join(side, "w").where(F.size("b") == F.size("slots"))
    pairs = met.groupBy("d", "h", "item_id").agg(F.collect_list(F.struct("i", "b", F.col("slots").alias("v"), F.col("pos").alias("p"), F.col("offs").alias("o"))).alias("matches"))
    judged = pairs.join(sizes, "item_id").select("d", "h", "item_id", "item_windows", "matches").mapInArrow(
        _judge, "d bigint, h bigint, item_id bigint, item_windows bigint, windows bigint, place_windows bigint, changed_slots bigint"
    )
    most = F.greatest("windows", "place_windows")
    enough = (most >= NEED) | (most >= SHARE * F.col("item_windows"))
    judged = judged.where(enough & (most > 0))
    return judged.unionByName(_whole(items, texts)).withColumn(
        "kind", F.when(F.col("changed_slots") == 0, F.lit("exact")).otherwise(F.lit("reparameterised"))
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item; rows of ``docs`` repeated whole count once."""
    found = staged(contaminated(docs, benchmark))
    ids = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias
    return found.select(ids("d")("doc_id"), ids("item_id")("item_id"), "windows", "place_windows", "item_windows", "changed_slots", "kind")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated texts, columns unchanged."""
    found = staged(contaminated(docs, benchmark).select(F.struct("d", "h").alias("node")).distinct())
    return restored(carried(docs).join(found, "node", "left_anti"), docs)
