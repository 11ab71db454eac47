"""Binary id files by an adaptive context-mixing range coder.

Ids are cut into blocks of at most ``BLOCK_IDS``.  Every block starts from the same state, carries
its own checksum and can be read alone.  For each id an order-2 and an order-1 context name the
id that last followed them.  The chance that the order-2 guess is right is mixed from three
adaptive estimates (order-2 confidence, order-1 confidence, order-0 hit rate) by learned
weights in the logistic domain.  The guess, then the order-1 guess, then the order-0 guess (the
id seen most in the block so far) are range coded as hits or misses, and last the id itself:
its high eight bits under adaptive frequencies, the next four under adaptive frequencies kept
by the lower half of the high bits, what is left as plain bits.  All arithmetic is on
integers, so any machine reads what another wrote.

Many blocks are coded side by side: each numpy step moves every block of a group by one id.

A file is the range of ascending ids that one partition holds: rows of (file, block, body).  Files
are written and read by Spark, so any store that Spark knows will do.

Defined cases: a null or empty text has the end id alone; a null doc_id comes first; rows that
repeat a doc_id stand one after the other by the hash of their text, each with its own start;
a text longer than a block goes on in the next ones; an empty table writes no block and reads as
no row.  Only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.chunked import public_path, tokenizer
from barledger.llm.common import NO_ID, doc_key, shared_dir, staged, text_or_empty

MAGIC = b"CMR1"
BLOCK_IDS = 4096
#: Blocks coded side by side.
LANES = 2048
END_ID = 0
_SLOTS = 1 << 11
_HEAD = struct.Struct("<4sIIIIB")


def _curves() -> tuple[np.ndarray, np.ndarray]:
    """Integer logistic tables: squash(-2047..2047) to 1..4095 and its inverse, from exact rationals."""
    # e**(x/256) by repeated squaring on 40-bit fixed point keeps the table equal everywhere
    one = 1 << 40
    squash = []
    for x in range(-2048, 2048):
        t = abs(x) * one // 256
        term, total, k = one, one, 1
        while term:
            term = term * t // (k * one)
            total += term
            k += 1
        p = 4096 * total // (one + total)  # e^|x| / (1 + e^|x|)
        squash.append(min(4095, max(1, p if x >= 0 else 4096 - p)))
    stretch, at = [], 0
    for p in range(4096):
        while at < 4095 and squash[at] < p:
            at += 1
        stretch.append(min(2047, max(-2047, at - 2048)))
    return np.array(squash, np.int64), np.array(stretch, np.int64)


SQUASH, STRETCH = _curves()


class _Model:
    """State of the predictors of ``n`` blocks; the live ones are always the first ``k``."""

    def __init__(self, n: int, low_bits: int):
        self.low_bits = low_bits
        self.t2 = np.zeros(n * _SLOTS, np.int32)
        self.t1 = np.zeros(n * _SLOTS, np.int32)
        self.slot = np.arange(n, dtype=np.int64) * _SLOTS
        self.row32 = np.arange(n, dtype=np.int64) * 32
        # order-2 and order-1 estimates by confidence and agreement, order-0 hit rate
        self.hit = np.full((2, n * 32), 1024, np.int64)
        self.q = np.full((3, n), 1024, np.int64)
        self.hit_b = np.full(n * 16, 1024, np.int64)
        self.weight = np.full((3, n), 24000, np.int64)
        self.group = np.ones((n, 16), np.int64)
        self.member = np.ones((n * 16, 16), np.int64)
        self.next = np.ones((n * 16, 16), np.int64)
        # order-0 guess: counts by hashed id, the id that leads and its count, its hit rate
        self.seen = np.zeros(n * _SLOTS, np.int16)
        self.top = np.zeros(n, np.int64)
        self.top_seen = np.zeros(n, np.int16)
        self.hit_c = np.full(n, 512, np.int64)
        self.c1 = np.zeros(n, np.int64)
        self.c2 = np.zeros(n, np.int64)

    def guess(self, k: int) -> None:
        """Guesses p2 and p1, their confidence, and the chance ``p`` (of 4096) that p2 is right."""
        h = self.c1[:k] * 40503
        self.i1 = self.slot[:k] + ((h >> 2) & (_SLOTS - 1))
        h += self.c2[:k] * 30011
        self.i2 = self.slot[:k] + ((h >> 3) & (_SLOTS - 1))
        e2, e1 = self.t2.take(self.i2), self.t1.take(self.i1)
        self.p2, self.p1, self.f2, self.f1 = e2 >> 4, e1 >> 4, e2 & 15, e1 & 15
        self.agree = self.p1 == self.p2
        at = self.row32[:k] + self.agree
        self.k2, self.k1 = at + (self.f2 << 1), at + (self.f1 << 1)
        q = self.q[:, :k]
        q[0], q[1] = self.hit[0].take(self.k2), self.hit[1].take(self.k1)
        self.s = STRETCH.take(q)
        dot = (self.weight[:, :k] * self.s).sum(0) >> 16
        self.p = SQUASH.take(np.clip(dot, -2047, 2047) + 2048)

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        k = len(ids)
        bit = hit.astype(np.int64)
        self.weight[:, :k] += (self.s * (((bit << 12) - self.p) * 6)) >> 14
        q = self.q[:, :k]
        q += ((bit * 4095 - q) >> 5) + bit
        np.clip(q, 32, 4064, out=q)
        self.hit[0][self.k2], self.hit[1][self.k1] = q[0], q[1]
        self._table(self.t2, self.i2, self.p2, self.f2, ids, hit)
        self._table(self.t1, self.i1, self.p1, self.f1, ids, ids == self.p1)
        at = self.slot[:k] + ((ids * 40503 >> 4) & (_SLOTS - 1))
        count = self.seen[at] + np.int16(1)
        self.seen[at] = count
        lead = count > self.top_seen[:k]
        self.top[:k][lead], self.top_seen[:k][lead] = ids[lead], count[lead]
        self.c2[:k] = self.c1[:k]
        self.c1[:k] = ids

    @staticmethod
    def _table(table, at, guess, sure, ids, hit) -> None:
        """A right guess gains confidence, a wrong one halves it and falls at the bottom."""
        old = sure > 1
        level = np.where(hit, np.minimum(sure + 1, 15), np.where(old, sure >> 1, 1))
        table[at] = (np.where(hit | old, guess, ids) << 4) | level

    def learn_b(self, at: np.ndarray, bit: np.ndarray) -> None:
        self._rate(self.hit_b, at, bit)

    def learn_c(self, at: np.ndarray, bit: np.ndarray) -> None:
        self._rate(self.hit_c, at, bit)

    @staticmethod
    def _rate(table: np.ndarray, at: np.ndarray, bit: np.ndarray) -> None:
        q = table[at]
        table[at] = np.clip(q + ((bit * 4095 - q) >> 5) + bit, 32, 4064)

    def third(self, lost: np.ndarray) -> np.ndarray:
        """Lost lanes whose order-0 guess has not been refused yet."""
        top = self.top[lost]
        return lost[(top != self.p2[lost]) & (top != self.p1[lost])]


def _counted(table: np.ndarray, at: np.ndarray, rows: np.ndarray, total: np.ndarray, symbol: np.ndarray) -> None:
    """One more for each row's symbol; totals stay below 2**14."""
    rows[np.arange(len(rows)), symbol] += 24
    full = total > 16000
    if full.any():
        rows[full] = (rows[full] + 1) >> 1
    table[at] = rows


class _Writer:
    def __init__(self, n: int, words: int):
        self.low = np.zeros(n, np.int64)
        self.range = np.full(n, (1 << 32) - 1, np.int64)
        self.out = np.zeros((n, words), np.uint16)
        self.at = np.zeros(n, np.int64)

    def put(self, live, start, size, r) -> None:
        """Narrow to [start, start + size) in units of ``r``; ``live`` is a slice or an index."""
        low = self.low[live] + start * r
        r = size * r
        over = np.flatnonzero(low >> 32)
        if len(over):
            low &= 0xFFFFFFFF
            self._carry(over if isinstance(live, slice) else live[over])
        small = np.flatnonzero(r < 1 << 16)
        if len(small):
            who = small if isinstance(live, slice) else live[small]
            at = self.at[who]
            if int(at.max()) + 2 >= self.out.shape[1]:
                self.out = np.hstack((self.out, np.zeros_like(self.out)))
            now = low[small]
            self.out[who, at] = now >> 16
            self.at[who] = at + 1
            low[small] = (now & 0xFFFF) << 16
            r[small] <<= 16
        self.low[live], self.range[live] = low, r

    def _carry(self, who: np.ndarray) -> None:
        place = self.at[who] - 1
        while len(who):
            value = (self.out[who, place].astype(np.int64) + 1) & 0xFFFF
            self.out[who, place] = value
            more = value == 0
            who, place = who[more], place[more] - 1

    def symbol(self, live, table, at, symbol) -> None:
        rows = table[at]
        upto = rows.cumsum(1)
        i = np.arange(len(live))
        size = rows[i, symbol]
        total = upto[:, -1]
        self.put(live, upto[i, symbol] - size, size, self.range[live] // total)
        _counted(table, at, rows, total, symbol)

    def finish(self) -> list[bytes]:
        n = len(self.low)
        if self.at.max(initial=0) + 3 >= self.out.shape[1]:
            self.out = np.hstack((self.out, np.zeros((n, 4), np.uint16)))
        who = np.arange(n)
        for part in (self.low >> 16, self.low & 0xFFFF):
            self.out[who, self.at] = part
            self.at += 1
        return [self.out[i, : self.at[i]].astype("<u2").tobytes() for i in range(n)]


class _Reader:
    def __init__(self, bodies: list[bytes]):
        size = max((len(b) // 2 for b in bodies), default=0) + 4
        self.words = np.zeros((len(bodies), size), np.int64)
        for i, b in enumerate(bodies):
            self.words[i, : len(b) // 2] = np.frombuffer(b, "<u2")
        self.code = (self.words[:, 0] << 16) | self.words[:, 1]
        self.range = np.full(len(bodies), (1 << 32) - 1, np.int64)
        self.at = np.full(len(bodies), 2, np.int64)

    def take(self, live, start, size, r) -> None:
        code = self.code[live] - start * r
        r = size * r
        small = np.flatnonzero(r < 1 << 16)
        if len(small):
            who = small if isinstance(live, slice) else live[small]
            at = self.at[who]
            code[small] = (code[small] << 16) | self.words[who, np.minimum(at, self.words.shape[1] - 1)]
            self.at[who] = at + 1
            r[small] <<= 16
        self.code[live], self.range[live] = code, r

    def bit(self, live, p) -> np.ndarray:
        """True with chance ``p`` of 4096."""
        r = self.range[live] >> 12
        hit = self.code[live] < p * r
        self.take(live, np.where(hit, 0, p), np.where(hit, p, 4096 - p), r)
        return hit

    def symbol(self, live, table, at) -> np.ndarray:
        rows = table[at]
        upto = rows.cumsum(1)
        total = upto[:, -1]
        r = self.range[live] // total
        value = np.minimum(self.code[live] // r, total - 1)
        symbol = (upto <= value[:, None]).sum(1)
        i = np.arange(len(live))
        size = rows[i, symbol]
        self.take(live, upto[i, symbol] - size, size, r)
        _counted(table, at, rows, total, symbol)
        return symbol

    def plain(self, live, bits: int) -> np.ndarray:
        r = self.range[live] >> bits
        value = np.minimum(self.code[live] // r, (1 << bits) - 1)
        self.take(live, value, 1, r)
        return value


def _low_bits(top: int) -> int:
    return max(0, int(top).bit_length() - 8)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Coded bodies (header and words) of blocks of ids below 2**27."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    size = np.array([len(blocks[i]) for i in order], np.int64)
    n = len(order)
    if not n:
        return []
    low_bits = _low_bits(max((int(b.max()) for b in blocks if len(b)), default=0))
    ids = np.zeros((int(size.max()), n), np.int64)
    for lane, i in enumerate(order):
        ids[: size[lane], lane] = blocks[i]
    m, w = _Model(n, low_bits), _Writer(n, int(size.max()) + 8)
    for t in range(len(ids)):
        k = int(np.searchsorted(-size, -t, "left"))
        now = ids[t, :k]
        m.guess(k)
        hit = now == m.p2
        w.put(slice(k), np.where(hit, 0, m.p), np.where(hit, m.p, 4096 - m.p), w.range[:k] >> 12)
        lost = np.flatnonzero(~hit)
        ask = lost[~m.agree[lost]]
        if len(ask):
            at = ask * 16 + m.f1[ask]
            q = m.hit_b[at]
            ok = now[ask] == m.p1[ask]
            w.put(ask, np.where(ok, 0, q), np.where(ok, q, 4096 - q), w.range[ask] >> 12)
            m.learn_b(at, ok.astype(np.int64))
            lost = lost[now[lost] != m.p1[lost]]
        ask = m.third(lost)
        if len(ask):
            q = m.hit_c[ask]
            ok = now[ask] == m.top[ask]
            w.put(ask, np.where(ok, 0, q), np.where(ok, q, 4096 - q), w.range[ask] >> 12)
            m.learn_c(ask, ok.astype(np.int64))
            gone = np.zeros(k, bool)
            gone[ask[ok]] = True
            lost = lost[~gone[lost]]
        if len(lost):
            x = now[lost]
            high = x >> low_bits
            w.symbol(lost, m.group, lost, high >> 4)
            w.symbol(lost, m.member, lost * 16 + (high >> 4), high & 15)
            left = low_bits
            if left >= 4:
                left -= 4
                w.symbol(lost, m.next, lost * 16 + (high & 15), (x >> left) & 15)
            while left > 0:
                step = min(left, 12)
                left -= step
                w.put(lost, (x >> left) & ((1 << step) - 1), 1, w.range[lost] >> step)
        m.learn(now, hit)
    bodies = w.finish()
    out: list[bytes] = [b""] * n
    for lane, i in enumerate(order):
        check = zlib.crc32(np.ascontiguousarray(blocks[i], "<u4").tobytes())
        out[i] = _HEAD.pack(MAGIC, len(blocks[i]), check, zlib.crc32(bodies[lane]), len(bodies[lane]), low_bits) + bodies[lane]
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """Ids of coded bodies; a damaged block raises ValueError."""
    heads, bodies = [], []
    for c in coded:
        magic, n, check, body_check, length, low_bits = _HEAD.unpack_from(c)
        body = c[_HEAD.size : _HEAD.size + length]
        if magic != MAGIC or len(body) != length or zlib.crc32(body) != body_check:
            raise ValueError("A block is damaged.")
        heads.append((n, check, low_bits))
        bodies.append(body)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(coded)
    for bits in sorted({h[2] for h in heads}):
        order = sorted((i for i in range(len(coded)) if heads[i][2] == bits), key=lambda i: -heads[i][0])
        size = np.array([heads[i][0] for i in order], np.int64)
        ids = np.zeros((int(size.max()), len(order)), np.int64)
        m, r = _Model(len(order), bits), _Reader([bodies[i] for i in order])
        for t in range(len(ids)):
            k = int(np.searchsorted(-size, -t, "left"))
            m.guess(k)
            hit = r.bit(slice(k), m.p)
            now = m.p2.astype(np.int64)
            lost = np.flatnonzero(~hit)
            ask = lost[~m.agree[lost]]
            if len(ask):
                at = ask * 16 + m.f1[ask]
                ok = r.bit(ask, m.hit_b[at])
                m.learn_b(at, ok.astype(np.int64))
                good = ask[ok]
                now[good] = m.p1[good]
                second = np.zeros(k, bool)
                second[good] = True
                lost = lost[~second[lost]]
            ask = m.third(lost)
            if len(ask):
                ok = r.bit(ask, m.hit_c[ask])
                m.learn_c(ask, ok.astype(np.int64))
                good = ask[ok]
                now[good] = m.top[good]
                gone = np.zeros(k, bool)
                gone[good] = True
                lost = lost[~gone[lost]]
            if len(lost):
                a = r.symbol(lost, m.group, lost)
                b = r.symbol(lost, m.member, lost * 16 + a)
                x, left = (a << 4) | b, bits
                if left >= 4:
                    left -= 4
                    x = (x << 4) | r.symbol(lost, m.next, lost * 16 + b)
                while left > 0:
                    step = min(left, 12)
                    left -= step
                    x = (x << step) | r.plain(lost, step)
                now[lost] = x
            ids[t, :k] = now
            m.learn(now, hit)
        for lane, i in enumerate(order):
            out[i] = ids[: size[lane], lane].copy()
            if zlib.crc32(out[i].astype("<u4").tobytes()) != heads[i][1]:
                raise ValueError("A block's ids fail their checksum.")
    return out


# checksums of parts joined ---------------------------------------------------------------

_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, lowest power in the highest bit."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, length: int) -> int:
    """CRC-32 of two byte strings one after the other, the second ``length`` bytes long."""
    shift, base, n = 1 << 31, 1 << 23, length  # x**0 and x**8
    while n:
        if n & 1:
            shift = _times(shift, base)
        base = _times(base, base)
        n >>= 1
    return _times(shift, first) ^ second


# files -----------------------------------------------------------------------------------

_BLOCKS = "file bigint, block bigint, first bigint, n bigint, body binary"


def _write(name: str, end: int):
    """Rows in order of their ids: tokens, blocks, coded bodies with their document table."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        tok = tokenizer(name if "/" in name else public_path(name))
        file = TaskContext.get().partitionId()
        at, number = 0, 0
        held: list[tuple[list, np.ndarray]] = []  # document table, ids
        docs: list[tuple[int, int, int, int]] = []  # row number, id, part, ids
        part_ids: list[np.ndarray] = []
        filled, row_number = 0, 0

        def flush():
            nonlocal at, number, held
            bodies = encode_blocks([ids for _, ids in held])
            rows = []
            for (table, ids), body in zip(held, bodies):
                t = np.array(table, "<i8")
                packed = zlib.compress(t.tobytes())
                rows.append((file, number, at, len(ids), struct.pack("<II", len(table), len(packed)) + packed + body))
                at, number = at + len(ids), number + 1
            held = []
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())], names=["file", "block", "first", "n", "body"])

        def close():
            nonlocal docs, part_ids, filled
            held.append((docs, np.concatenate(part_ids).astype(np.int64)))
            docs, part_ids, filled = [], [], 0

        for batch in batches:
            d = batch.column("d").to_pylist()
            for lo, hi, data, off in flat.blocks(batch.column("text")):
                body = data.tobytes()
                coded = tok.encode([body[off[i] : off[i + 1]].decode("utf-8", "replace") for i in range(hi - lo)])
                for i, ids in enumerate(coded):
                    ids = np.append(np.frombuffer(ids, "<u4"), np.uint32(end))
                    cut, part = 0, 0
                    while cut < len(ids):
                        piece = ids[cut : cut + BLOCK_IDS - filled]
                        docs.append((row_number, d[lo + i], part, len(piece)))
                        part_ids.append(piece)
                        filled, cut, part = filled + len(piece), cut + len(piece), part + 1
                        if filled == BLOCK_IDS:
                            close()
                            if len(held) == LANES:
                                yield flush()
                    row_number += 1
        if docs:
            close()
        if held:
            yield flush()

    return run


def _read(batches):
    """One row per part of a document: file, row, doc, part, start in the file, ids, checksum."""
    import pyarrow as pa

    names = ["file", "row", "d", "part", "first", "n", "crc"]
    for batch in batches:
        for lo in range(0, len(batch), LANES):
            some = batch.slice(lo, LANES)
            bodies, tables = [], []
            for b in some.column("body"):
                b = b.as_py()
                n, size = struct.unpack_from("<II", b)
                tables.append(np.frombuffer(zlib.decompress(b[8 : 8 + size]), "<i8").reshape(n, 4))
                bodies.append(b[8 + size :])
            rows = []
            for file, first, table, ids in zip(some.column("file").to_pylist(), some.column("first").to_pylist(), tables, decode_blocks(bodies)):
                at = 0
                for row, d, part, n in table.tolist():
                    rows.append((file, row, d, part, first + at, n, zlib.crc32(ids[at : at + n].astype("<u4").tobytes())))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def write_ids(docs: DataFrame, path: str, name: str = "byte_bpe_50k.json", end: int = END_ID, files: int | None = None) -> None:
    """Write the ids of all texts, each with ``end`` behind it, in ascending order of doc_id."""
    key = doc_key()
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(key["d"].alias("d"), key["h"].alias("h"), text_or_empty().alias("text"))
    rows = rows.repartitionByRange(n, "d", "h").sortWithinPartitions("d", "h").select("d", "text")
    rows.mapInArrow(_write(name, end), _BLOCKS).write.parquet(path)


def read_documents(spark, path: str) -> DataFrame:
    """d, start, n_tokens, ids_crc32 of each document, from the files alone."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    totals = blocks.groupBy("file").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = totals.select("file", F.coalesce(before, F.lit(0)).alias("before"))  # one row a file
    # written once: what follows reads the parts twice, and decoding is the dear step
    parts = staged(
        blocks.select("file", "first", "body").mapInArrow(
            _read, "file bigint, row bigint, d bigint, part bigint, first bigint, n bigint, crc bigint"
        )
    )
    whole = parts.groupBy("file", "row", "d").agg(
        F.min("first").alias("first"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("part", "n", "crc"))).alias("parts")
    )

    def join(batches):
        import pyarrow as pa

        for batch in batches:
            sums = []
            for parts in batch.column("parts").to_pylist():
                crc = 0
                for p in parts:
                    crc = joined_crc(crc, p["crc"], 4 * p["n"])
                sums.append(crc)
            keep = ["file", "d", "first", "n_tokens"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sums, pa.int64())], names=[*keep, "ids_crc32"])

    one = whole.where(F.size("parts") == 1).select("file", "d", "first", "n_tokens", F.col("parts")[0]["crc"].alias("ids_crc32"))
    many = whole.where(F.size("parts") > 1).select("file", "d", "first", "n_tokens", "parts").mapInArrow(
        join, "file bigint, d bigint, first bigint, n_tokens bigint, ids_crc32 bigint"
    )
    out = one.unionByName(many).join(files, "file")
    return out.select("d", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from newly written files."""
    import uuid

    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/id-files/{uuid.uuid4().hex}"
    write_ids(docs, path)
    return read_documents(spark, path).select(F.nullif("d", F.lit(NO_ID)).alias("doc_id"), "start", "n_tokens", "ids_crc32")
