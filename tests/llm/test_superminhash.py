import random

import numpy as np
import pytest

from barledger.llm import superminhash as sm


def _slow_signature(elements, slots):
    """The sequential definition, element after element, without early stop."""
    h = [np.iinfo(np.int64).max] * slots
    for e in elements:
        p = list(range(slots))
        for j in range(slots):
            k, v = sm._offers(np.array([e], np.uint64), j, slots)
            p[j], p[int(k[0])] = p[int(k[0])], p[j]
            h[p[j]] = min(h[p[j]], int(v[0]))
    return h


def test_signature_equals_the_sequential_definition():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (3, 0, 1, 200, 17)]
    off = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    got = sm.signatures(np.concatenate(sets), off, 16)
    for s, row in zip(sets, got):
        assert list(row) == _slow_signature(s, 16)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 2**63, 300).astype(np.uint64)
    a = np.concatenate((shared, rng.integers(0, 2**63, 50).astype(np.uint64)))
    b = np.concatenate((shared, rng.integers(0, 2**63, 50).astype(np.uint64)))
    got = sm.signatures(np.concatenate((a, b)), np.array([0, 350, 700]))
    assert abs((got[0] == got[1]).mean() - 300 / 400) < 0.12


def shingles(text):
    if not text:
        return frozenset()
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        ids = [x for x in ids if x is not None] if None not in ids else [None]
        c = min(ids) if ids != [None] else None
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, base = [], text(120)
    hot = text(90)
    for i in range(40):  # a chain of edits: neighbours are linked, ends are not
        base = list(base)
        base[(7 * i) % 120] = f"e{i}"
        rows.append((i, " ".join(base)))
    for i in range(40, 80):  # a common passage, three quarters of each text or less
        rows.append((i, " ".join(hot + text(rng.choice([32, 40, 60])))))
    for i in range(80, 90):
        rows.append((i, " ".join(text(200)).upper()))
    rows += [(90, None), (91, ""), (92, " \t\n"), (93, "two words"), (94, "Two\nWORDS"), (95, "words two")]
    rows += [(3, rows[3][1]), (None, "alone here"), (200, "word " * 30000), (201, "Word " * 29999)]
    return rows


def test_groups_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id bigint, text string, node string")
    got = sorted((tuple(r) for r in sm.report(df).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == brute(rows)


def test_keep_first_keeps_columns_and_one_of_each_group(spark):
    rows = [(1, "a b c d e f g", "p"), (2, "A B C D E F G", "q"), (1, "a b c d e f g", "p"), (3, None, "r"), (4, None, "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, d string")
    got = sm.keep_first(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert sm.report(df).collect() == []
    assert sm.keep_first(df).collect() == []


@pytest.mark.parametrize("slots", [8, 160])
def test_bands_of_equal_sets_are_equal(slots):
    e = np.arange(1, 50, dtype=np.uint64)
    s = sm.signatures(np.concatenate((e, e[::-1])), np.array([0, 49, 98]), slots)
    assert (sm.band_keys(s, slots // 4, 4)[0] == sm.band_keys(s, slots // 4, 4)[1]).all()
