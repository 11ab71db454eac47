import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from barledger.llm import flat
from barledger.llm import importance as im

SCHEMA = "doc_id long, text string, score string, rank int"


def grams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(ws), ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def brute(docs, target):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, grams(x)[1]))
    for x in target:
        t.update(map(bucket, grams(x)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    rows = []
    for i, (d, x) in enumerate(docs):
        n, g = grams(x)
        weight = sum(gain(bucket(y)) for y in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n, i))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0], r[5]))
    rank = {r[5]: k + 1 for k, r in enumerate(able) if k < 25 * len(able) // 100}
    return sorted(((*r[:4], rank.get(r[5])) for r in rows), key=repr)


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(90)] + ["Straße", "ÉTÉ", "語語", "x" * 300, "y" * 40]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    docs += [(None, " ".join(["again"] * 40)), (500, None), (501, ""), (502, "!!! ---")]
    docs += [(7, docs[3][1])] * 3 + [(9, " ".join(f"w{i % 90}" for i in range(30_000)))]
    return docs, ["w1 w2 w3 w4", "W1 w2", "ÉTÉ Straße", None, ""]


def test_draw_equals_brute_force(spark):
    docs, target = corpus()
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], SCHEMA)
    got = im.report(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, target)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    docs = spark.createDataFrame([(1, "a b", "", 0)], SCHEMA)
    assert im.report(none, none).collect() == []
    assert [tuple(r) for r in im.report(docs, none).select("doc_id", "n_features", "rank").collect()] == [(1, 3, None)]


def test_hash_equals_the_library():
    rng = np.random.default_rng(0)
    data = np.concatenate((rng.integers(0, 256, 5000).astype(np.uint8), np.zeros(8, np.uint8)))
    length = np.concatenate((np.arange(0, 300), [1000, 2500]))
    start = rng.integers(0, 2500, len(length))
    want = [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(start, length)]
    assert im.xxhash64(data, start, length).tolist() == want


@pytest.mark.parametrize("collide", [False, True])
def test_table_tells_equal_keys_apart(monkeypatch, collide):
    if collide:  # every span has one key: only the bytes tell them apart
        monkeypatch.setattr(im, "xxhash64", lambda data, start, length: np.full(len(start), 12, np.uint64))
    words = ["abc", "abd", "abc", "a" * 20 + "b", "a" * 20 + "c", "a" * 20 + "b", "abcdefgh", "abcdefgi", ""]
    body = np.frombuffer("".join(words).encode() + bytes(8), np.uint8).copy()
    size = np.array([len(w) for w in words])
    table = im.Table(body, np.cumsum(size) - size, size)
    assert [[i for i, t in enumerate(table.slot) if t == s] for s in table.slot] == [[i for i, v in enumerate(words) if v == w] for w in words]
    at, size = np.cumsum(size) - size, size
    assert table.crc(body, at, at + size)[table.slot].tolist() == [zlib.crc32(w.encode()) for w in words]
    assert table.count[table.slot].tolist() == [words.count(w) for w in words]


@pytest.mark.parametrize("order", [2, 3])
def test_buckets_of_runs(monkeypatch, order):
    monkeypatch.setattr(im, "ORDER", order)
    text = "a bc a bc def " + "x" * 300 + " a bc ÉTÉ " + "y" * 256 + " " + "z" * 257
    body = np.frombuffer(text.encode(), np.uint8)
    _, rows, tables = im.features(body, np.array([0, len(body)]))
    ws = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in text.split()]
    for n, table in enumerate(tables, 1):
        want = [zlib.crc32(" ".join(ws[i : i + n]).encode()) % 10000 for i in range(len(ws) - n + 1)]
        assert table.bucket[table.slot].tolist() == want


def test_words_do_not_cross_rows():
    texts = ["ab cd", "ef", "", "gh-IJ"]
    body = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *map(len, texts)])
    packed, s, e, row = flat.plain_words(body, off)
    assert [(packed[a:b].tobytes(), int(r)) for a, b, r in zip(s, e, row)] == [(b"ab", 0), (b"cd", 0), (b"ef", 1), (b"gh", 3), (b"ij", 3)]
