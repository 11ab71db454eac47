import pytest

from barledger.llm import fixity


def test_audit_finds_each_kind(spark, monkeypatch):
    monkeypatch.setattr(fixity, "RANGE", 600)
    monkeypatch.setattr(fixity, "FANOUT", 2)
    rows = [(i, f"http://h/{i}", "<p>é" + "x" * (i % 90) + "</p>", "e") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, offset string")
    first = fixity.records(pages, shard_bytes=9000)
    assert first.select("shard").distinct().count() > 3
    cached = sorted(tuple(r) for r in first.collect())
    fate = {5: "changed", 77: "gone", 150: "resized", 299: "changed"}
    second, want = [], []
    for p, s, o, n, r in cached:
        if fate.get(p) == "gone":
            want.append((s, o, n, None, "missing"))
            continue
        if fate.get(p) == "changed":
            r = r[:-6] + "#" + r[-5:]
            want.append((s, o, n, n, "changed"))
        if fate.get(p) == "resized":
            r = r[:50]
            want.append((s, o, n, 50, "resized"))
            n = 50
        second.append((p, s, o, n, r))
    second.append((999, 0, 10**6, 3, "new"))
    want.append((0, 10**6, None, 3, "extra"))
    schema = "page_id bigint, shard bigint, offset bigint, length bigint, record string"
    other = spark.createDataFrame(second, schema)
    got = sorted((tuple(r) for r in fixity.audit(first, other).collect()), key=repr)
    assert got == sorted(want, key=repr)
    assert fixity.audit(first, first).collect() == []
    back = sorted(x[4] for x in (tuple(r) for r in fixity.audit(other, first).collect()))
    assert back == sorted({"missing": "extra", "extra": "missing"}.get(x[4], x[4]) for x in want)


def test_offsets_follow_each_other(spark):
    rows = [(1, None, None), (None, "u", "h"), (2, "u", "h"), (2, "u", "h")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted((r.offset, r.length, len(r.record.encode())) for r in fixity.records(pages).collect())
    at = 0
    for offset, length, size in got:
        assert offset == at and length == size
        at += length


@pytest.mark.parametrize("swap", [False, True])
def test_empty_replica(spark, swap):
    pages = spark.createDataFrame([(1, "u", "h"), (2, "u", "h")], "page_id bigint, url string, html string")
    full = fixity.records(pages)
    pair = (full.limit(0), full) if swap else (full, full.limit(0))
    assert [r.finding for r in fixity.audit(*pair).collect()] == ["extra" if swap else "missing"] * 2
    assert fixity.audit(full.limit(0), full.limit(0)).collect() == []


def test_query_finds_all_damage(spark):
    rows = [(i, f"http://h/{i}", "text " * (i % 30)) for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    import hashlib

    kinds = {"00": "changed", "01": "resized", "02": "missing"}
    want = {i: kinds[f] for i in range(600) if (f := hashlib.md5(str(i).encode()).hexdigest()[8:10]) in kinds}
    assert {r.page_id: r.finding for r in fixity.report(pages).collect()} == want
