import zlib

import numpy as np
import pytest

from barledger.llm import chunked, idcoder
from barledger.llm.common import shared_dir


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 50257, n) for n in (0, 1, 5, 1000)]
    blocks += [np.zeros(3000, int), np.tile([5, 7, 9], 500), rng.zipf(1.3, 2000) % 50000, np.full(10, 50256), rng.integers(0, 2**20, 50)]
    coded = idcoder.encode_blocks(blocks)
    for a, b in zip(blocks, idcoder.decode_blocks(coded)):
        assert np.array_equal(a, b)
    # each block stands alone
    for a, c in zip(blocks, coded):
        assert np.array_equal(idcoder.decode_blocks([c])[0], a)
    assert len(coded[4]) < 60 and len(coded[5]) < 80
    assert idcoder.encode_blocks([]) == [] == idcoder.decode_blocks([])


def test_damage_is_found():
    coded = bytearray(idcoder.encode_blocks([np.arange(500) % 77])[0])
    for at in (0, 5, 9, len(coded) - 3):
        bad = bytearray(coded)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            idcoder.decode_blocks([bytes(bad)])
    with pytest.raises(ValueError):
        idcoder.decode_blocks([bytes(coded[:-2])])


def test_joined_crc():
    for a, b in ((b"", b"x"), (b"abc", b"defgh"), (b"q" * 1000, b"r" * 333), (b"z", b"")):
        assert idcoder.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_files(spark):
    texts = ["hello world", None, "", "word " * 20000, "x <|endoftext|> y", "é" * 50]
    rows = [(10 - i, t, i) for i, t in enumerate(texts)] + [(3, "again", 0), (3, "again", 0), (None, "no id", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, file int")
    got = sorted((tuple(r) for r in idcoder.report(df).collect()), key=lambda r: r[1])
    tok = chunked.Chunked(chunked.public_path("byte_bpe_50k.json"))
    want = []
    for d, t, _ in rows:
        ids = np.append(np.array(tok._library([t or ""])[0], "<u4"), np.uint32(0)).astype("<u4")
        want.append((d, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r[0], r[2], r[3]) for r in got), key=repr) == sorted(want, key=repr)
    at = 0
    for d, start, n, _ in got:
        assert start == at
        at += n
    ids = [r[0] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert idcoder.report(df.limit(0)).collect() == []


def test_rewritten_files_are_equal(spark):
    df = spark.createDataFrame([(i, f"text {i} " * 40) for i in range(50)], "doc_id bigint, text string")
    found = []
    for name in ("a", "b"):
        path = f"{shared_dir(spark)}/ids-{name}"
        idcoder.write_ids(df, path, files=3)
        found.append(sorted((r.file, r.block, bytes(r.body)) for r in spark.read.parquet(path).collect()))
    assert found[0] == found[1]
