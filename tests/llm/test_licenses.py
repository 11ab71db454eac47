import duckdb
import pyarrow as pa

from barledger.llm import licenses as li
from barledger.llm import oracles_drawn

MIT = dict(enumerate(t for _, t in li.TEMPLATES))[9]
SCHEMA = "doc_id long, text string, labels string, t int, h int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in texts], SCHEMA)


def corpus():
    words = MIT.split()
    inserted = words[:40] + ["really"] * 3 + words[40:]
    return [
        (1, "Some text. Released under the MIT License. More text."),
        (2, "Licensed under the Apache License,\nVersion 2.0; and under the MIT-License"),
        (3, "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0."),
        (4, "x " + " ".join(inserted).upper() + " y"),
        (5, " ".join(w if i % 7 else "other" for i, w in enumerate(words))),
        (6, " ".join(words[:50])),
        (7, "This work is licensed under the GNU General Public License, version 2."),
        (8, None),
        (9, ""),
        (10, ", . !"),
        (None, "the mit license the mit license mit license"),
        (1, "the same id, another text under the general public license"),
        (12, dict(enumerate(t for _, t in li.TEMPLATES))[13]),
        (13, ("filler " * 9 + "released under the mit license ") * 2000),
    ] + [(14, "Released under the MIT License.")] * 20


def test_scan_equals_sql(spark):
    texts = corpus()
    got = li.report(rows(spark, texts))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in texts], pa.int64()), "text": pa.array([t for _, t in texts], pa.string())}))
    cur = con.execute(oracles_drawn.OP12)
    names = [d[0] for d in cur.description]
    want = [tuple(r[names.index(c)] for c in got.columns) for r in cur.fetchall()]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_labels(spark):
    found = {(r["doc_id"], r["n_words"]): r for r in li.scan(rows(spark, corpus())).collect()}
    labels = {d: r["labels"] for (d, n), r in found.items() if (d, n) != (1, 10)}
    assert labels[1] == "mit"
    assert labels[2] == "apache,apache-2.0,mit"
    assert labels[3] == "cc-by-4.0,cc-by-nc-4.0"
    assert labels[4] == labels[5] == "mit"
    assert labels[6] == "" and labels[8] == labels[9] == labels[10] == ""
    assert labels[7] == "gpl"  # the version differs: base phrase only
    assert labels[12] == "bsd-3-clause"
    span = next(r for (d, _), r in found.items() if d == 4)["spans"][0]
    assert (span["label"], span["first"], span["share"]) == ("mit", 1, 1.0)
    many = next(r for (d, _), r in found.items() if d == 13)
    assert len(many["spans"]) == 2000 and many["n_base"] == 2000 and many["score"] == 1.0


def test_empty_table(spark):
    assert li.report(rows(spark, [])).collect() == []


def test_votes_are_linear_in_copies(spark):
    texts = rows(spark, [(1, MIT)] * 50)
    keyed = texts.select("doc_id", "text").selectExpr("doc_id as d", "cast(0 as bigint) as h", "text")
    found = li.places(keyed).collect()
    assert len(found) == 1
    place = [p for p in found[0]["wanted"] if p["t"] == 9 and 0 in p["diagonals"]]
    assert place[0]["votes"] <= len(MIT.split()) + 5
