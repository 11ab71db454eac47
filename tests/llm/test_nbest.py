import itertools
import random
import zlib

import numpy as np
import pytest

from barledger.llm import nbest

TEXTS = [
    "", "hello world", "  a  b\n c\t", "▁x ▁ y", "ħ梦ං 🙂 z", "wor ds" * 30, "a" * 300, "\n\n\n", " ", "Ünïcode naïve déjà",
    "The quick brown fox jumps over the lazy dog. " * 5, "x▁▁y", "tab\tand\rreturn",
]


@pytest.fixture(scope="module")
def lat():
    return nbest.Lattice(nbest.default_model())


def all_paths(lat, word):
    s = nbest.MARK + word

    def go(at):
        if at == len(s):
            yield 0.0, ()
            return
        for e in range(at + 1, len(s) + 1):
            p = s[at:e]
            if p in lat.pieces and nbest.MARK not in p[1:] and not (at and p[0] == nbest.MARK):
                step = (lat.pieces[p][1], (lat.pieces[p][0],))
            elif e - at == 1:
                step = (lat.below, tuple(lat._single(p, at == 0)))
            else:
                continue
            for v, ids in go(e):
                yield step[0] + v, step[1] + ids

    return sorted(go(0), key=lambda x: -x[0])


def test_words_equal_enumeration(lat):
    for word in ["", "the", "thing", "ħx", "▁a", "Über", "🙂o"]:
        paths = all_paths(lat, word)
        got = lat.search(word, 5)
        assert [s for s, _ in got] == [s for s, _ in paths[:5]]
        assert len({ids for _, ids in got}) == len(got)
        known = {(s, np.array(i, np.int32).tobytes()) for s, i in paths}
        assert all(x in known for x in got)
        lat.learn([word])
        i = lat.index[word]
        assert lat.score[i] == paths[0][0]
        assert (paths[0][0], lat.ids[i]) in known
        assert lat.gap[i] == (paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf)
    lat.forget()


def test_texts_equal_enumeration(lat):
    rng = random.Random(4)
    for _ in range(6):
        words = ["".join(rng.choice("thein") for _ in range(rng.randrange(0, 4))) for _ in range(3)]
        text = " ".join(words)
        if not text:
            continue
        options = [all_paths(lat, w)[:6] for w in words]
        sums = sorted((sum(s for s, _ in c) for c in itertools.product(*options)), reverse=True)[:4]
        got = lat.encode([text], 4)[0]
        assert [s for s, _ in got] == sums
        assert len({i for _, i in got}) == len(got)


def test_round_trip_and_library_decoding(lat):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=nbest.default_model())
    for text, found in zip(TEXTS, lat.encode(TEXTS, 3)):
        for _, ids in found:
            ids = np.frombuffer(ids, np.int32).tolist()
            assert lat.decode(ids) == text
            if nbest.MARK not in text:
                assert sp.decode(ids) == text
        scores = [s for s, _ in found]
        assert scores == sorted(scores, reverse=True)


def test_best_is_not_worse_than_the_library(lat):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=nbest.default_model())
    text = TEXTS[10]
    mine = lat.encode([text], 1)[0][0][0]
    assert mine >= sum(sp.get_score(i) for i in sp.encode(text))


def test_query(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, None, None), (1, TEXTS[1], "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, scores string")
    got = nbest.encoded(df, 3).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert sorted(r.n_pieces for r in got)[0] == 0
    sums = {r.doc_id: r for r in nbest.report(df).collect()}
    mine = nbest.lattice(nbest.default_model()).encode([TEXTS[3]], 4)[0]
    assert sums[3].ids_crc32 == [zlib.crc32(i) for _, i in mine]
    assert nbest.report(df.limit(0)).collect() == []


def test_encoded_carries_the_ids_of_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=nbest.default_model())
    texts = [t for t in TEXTS if t] + ["the die is cast", "a    b  c"]
    df = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in nbest.encoded(df, 3).collect()}
    mine = nbest.lattice(nbest.default_model()).encode(texts, 3)
    for i, t in enumerate(texts):
        assert list(got[i].ids) == sp.encode(t) and got[i].n_pieces == len(got[i].ids)
        assert [list(p) for p in got[i].paths] == [np.frombuffer(p, np.int32).tolist() for _, p in mine[i]]
    assert list(got[None].ids) == [] and [list(p) for p in got[None].paths] == [[]]
    assert any(list(r.ids) != list(r.paths[0]) for r in got.values())
