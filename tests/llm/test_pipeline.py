import random

import pytest

import corpus_pipeline
from barledger.llm import divergence, nbest


def _prose(rng, n):
    common = divergence.COMMON_WORDS["en"]
    words = [rng.choice(common) if rng.random() < 0.35 else "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(3, 8))) for _ in range(n)]
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    item = _prose(rng, 40)
    passage = _prose(rng, 60)
    docs = [(i, _prose(rng, 150)) for i in range(30)]
    docs += [(30, docs[0][1]), (31, docs[1][1] + " one more"), (32, docs[2][1].upper())]  # copies; the last fails the rules
    docs += [(33, _prose(rng, 80) + " " + item + " " + _prose(rng, 80))]
    docs += [(34, _prose(rng, 90) + " " + passage + " " + _prose(rng, 90)), (35, _prose(rng, 90) + " " + passage + " " + _prose(rng, 90))]
    docs += [(36, "too short"), (37, None), (38, ""), (39, " ".join(w + "%%%" for w in docs[3][1].split())), (5, docs[5][1])]
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(d, t, "en", "s", len(t or ""), "clash") for d, t in docs]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, node string").write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(folder + "/benchmark.parquet")
    return folder, dict(docs[:-1]), passage


def test_stages(spark, tables):
    folder, text, passage = tables
    docs = spark.read.parquet(folder + "/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, folder))
        assert docs.columns == columns
        kept.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    clean = list(range(30))
    assert kept[0] == sorted([*clean, 5, 30, 31, 33, 34, 35])  # rules: short, empty, capitals and symbols go
    assert kept[1] == [*clean, 33, 34, 35]  # one of each group
    assert kept[2] == kept[1]
    left = {r.doc_id: r.text for r in docs.collect()}
    assert kept[3] == [*clean, 34, 35] == sorted(left)  # the leak goes
    assert all(left[d] == text[d] for d in [*clean, 34])
    assert passage not in left[35] and len(left[35]) < len(text[35]) - 0.9 * len(passage)
    out = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()}
    lat = nbest.lattice(nbest.default_model())
    assert sorted(out) == sorted(left)
    assert all(r.round_trip and lat.decode(list(r.ids)) == left[d] for d, r in out.items())


def test_run_equals_the_stages(spark, tables):
    folder, _, _ = tables
    got = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == [*range(30), 34, 35]


def test_empty_documents(spark, tables, tmp_path):
    folder, _, _ = tables
    spark.read.parquet(folder + "/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(folder + "/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
