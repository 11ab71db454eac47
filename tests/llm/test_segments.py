import random
import zlib

import numpy as np

from barledger.llm import segments as sg


def brute_segments(x):
    """Maximal scoring segments by the recursive definition: best segment, then both sides."""
    found = []

    def go(lo, hi):
        best, span = 0.0, None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += x[j]
                if total > best + 1e-12:
                    best, span = total, (i, j)
        if span:
            found.append((round(best, 9), *span))
            go(lo, span[0])
            go(span[1] + 1, hi)

    go(0, len(x))
    return sorted(found, key=lambda s: s[1])


def test_maximal_segments_equal_definition():
    rng = random.Random(2)
    for _ in range(300):
        x = [rng.choice([-3.1, -1.3, -0.7, 0.9, 2.3, 4.1]) + rng.random() * 0.01 for _ in range(rng.randrange(0, 25))]
        got = [s for _, s in sg.text_segments(np.array(x), np.zeros(len(x), int), 1)][0]
        assert [(round(s, 9), a, z) for s, a, z in got] == brute_segments(x)


def test_lambda():
    s = np.array([2.0, -1.0])
    lam = sg.solve_lambda(s, np.array([0.2, 0.8]))
    assert abs(0.2 * np.exp(2 * lam) + 0.8 * np.exp(-lam) - 1) < 1e-9


def corpus():
    rng = random.Random(7)
    common = [f"w{i}" for i in range(300)]
    bad = ["vile", "scumbag", "wretch"]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [rng.choice(common) for _ in range(rng.randrange(60, 200))]
        if toxic:
            at = rng.randrange(0, len(words) - 20)
            for k in range(at, at + 20, 2):
                words[k] = rng.choice(bad) + rng.choice(["", ",", "."])
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_passages(spark):
    docs, labels = corpus()
    extra = [(2000, None, None), (2001, "", "x"), (2002, " \n", None), (None, "vile scumbag wretch " * 9, None), (1, docs[1][1], "en")]
    df = spark.createDataFrame(docs + extra, "doc_id bigint, text string, score string").repartition(4)
    lab = spark.createDataFrame(labels + [(5, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = sg.report(df, lab).collect()
    assert len(rows) == len(docs) + len(extra)
    truth = {i: t for i, _, t in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert len(held) > 100
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    text = dict((d, t) for d, t, _ in docs)
    toxic = next(r for r in held if truth[r.doc_id])
    passage = text[toxic.doc_id].encode()[toxic.segments[0].start : toxic.segments[0].end].decode()
    assert sum(w.strip(",.") in ("vile", "scumbag", "wretch") for w in passage.split()) >= 8
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2000].score == by_id[2001].score == by_id[2002].score < 0.5
    assert by_id[None].predicted == 1


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs, labels = corpus()
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = [
        sorted((r.doc_id, r.score) for r in sg.report(df, spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")).collect())
        for x in (labels, flipped)
    ]
    assert got[0] == got[1]


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(r.score < 1e-6 and r.predicted == 0 for r in sg.report(df, none).collect())
    assert sg.report(df.limit(0), none).collect() == []


def test_fit_takes_a_bounded_number_of_texts(spark, monkeypatch):
    monkeypatch.setattr(sg, "FIT_ROWS", 6)
    seen = []

    def recorded(df):
        out = staged(df)
        seen.append(out.count())
        return out

    staged = sg.staged
    monkeypatch.setattr(sg, "staged", recorded)
    rows = [(1, f"text {i} of one id") for i in range(40)] + [(2, "the same row")] * 40 + [(i, f"other {i}") for i in range(3, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(1, 9)], "doc_id bigint, quality int, toxic int")
    sg.fit(docs, labels)
    assert seen and max(seen) <= 6
